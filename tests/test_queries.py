"""Every registered query against its SQL equivalent, or for rows and schema where it has none."""

import oracle
import pytest

import __spark_entry__ as entry_point

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(root):
    return oracle.connect(root)


def test_oracle_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["genres", "count", "rank", "cumul_pct", "pct"]
    assert result.count() == 12


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, root, duck, name):
    assert oracle.compare(QUERIES[name](spark, root), duck.sql(SQL[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, root, name):
    assert QUERIES[name](spark, root).count() > 0
