"""Comparison of a Spark result with DuckDB's, column by column and value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value + 0.0:.12g}")
    return value


def _rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return Counter(tuple(map(_plain, row)) for row in zip(*columns))


def compare(frame, relation) -> str:
    """Empty if schema and rows agree, otherwise what differs."""
    ours, theirs = frame.toArrow(), relation.to_arrow_table()
    kinds = [
        {f.name: str(f.type).replace("large_", "") for f in t.schema} for t in (ours, theirs)
    ]
    if kinds[0] != kinds[1]:
        keys = sorted(set(kinds[0]) | set(kinds[1]))
        return "schema: " + "; ".join(
            f"{k}: {kinds[0].get(k)} / {kinds[1].get(k)}" for k in keys
            if kinds[0].get(k) != kinds[1].get(k)
        )
    a, b = _rows(ours), _rows(theirs)
    if a != b:
        return (
            f"rows: {sum(a.values())} / {sum(b.values())}, only ours "
            f"{list((a - b).items())[:2]}, only theirs {list((b - a).items())[:2]}"
        )
    return ""
