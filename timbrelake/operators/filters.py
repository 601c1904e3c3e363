"""Row filters and schema-driven column choices."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import NON_FEATURES

_NUMERIC = ("double", "int", "bigint", "float")


def normalise_genre(df: DataFrame) -> DataFrame:
    """One ``genres`` string per row: renames a single ``genre``, explodes an array of genres."""
    if "genre" in df.columns:
        return df.drop("genres").withColumnRenamed("genre", "genres")
    return df.withColumn("genres", F.explode("genres"))


def with_label(df: DataFrame, column: str, label: str = "label_str") -> DataFrame:
    """Rows whose single label is neither NULL nor empty, with a copy of it."""
    kept = df.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    return kept.withColumn(label, F.col(column))


def with_tags(df: DataFrame, column: str = "genres") -> DataFrame:
    """Rows whose tag array is neither NULL nor empty."""
    return df.filter(F.col(column).isNotNull() & (F.size(column) > 0))


def only_ok(df: DataFrame, flag: str = "ok") -> DataFrame:
    """Rows processed without failure; the flag itself is dropped."""
    return df.filter(F.col(flag) == 1).drop(flag)


def overlapping(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Rows with at least one wanted tag, and the wanted tags they have as ``matched``."""
    wanted_tags = F.array(*[F.lit(tag) for tag in wanted])
    return df.withColumn("matched", F.array_intersect(column, wanted_tags)).filter(
        F.size("matched") > 0
    )


@dataclass(frozen=True)
class Selection:
    """Optional restrictions of a data set; what is left out restricts nothing."""

    genres: Sequence[str] | None = None
    users: Sequence[int] | None = None
    date_from: str | None = None
    date_to: str | None = None
    duration: tuple[float, float] | None = None

    @property
    def active(self) -> list[str]:
        return [f.name for f in fields(self) if getattr(self, f.name)]


def select_rows(df: DataFrame, selection: Selection) -> DataFrame:
    """AND of the active restrictions, as one predicate that reaches the scan.

    Dates are ISO strings and compare as such. A data set without ``duration`` ignores that bound.
    """
    conditions = []
    if selection.genres:
        conditions.append(F.col("genres").isin(list(selection.genres)))
    if selection.users:
        conditions.append(F.col("user_id").isin(list(selection.users)))
    if selection.date_from:
        conditions.append(F.col("uploaded_at") >= str(selection.date_from))
    if selection.date_to:
        conditions.append(F.col("uploaded_at") <= str(selection.date_to))
    if selection.duration and "duration" in df.columns:
        conditions.append(F.col("duration").between(*selection.duration))
    if not conditions:
        return df
    return df.filter(functools.reduce(lambda a, b: a & b, conditions))


def feature_columns(df: DataFrame, excluded: Sequence[str] = NON_FEATURES) -> list[str]:
    """Numeric columns that are no identifiers, in schema order."""
    return [name for name, kind in df.dtypes if kind in _NUMERIC and name not in excluded]


def schema_contract(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected against actual columns: status and number of filled values per column."""
    present = [name for name in expected if name in df.columns]
    extra = [name for name in df.columns if name not in expected]
    missing = [name for name in expected if name not in df.columns]
    filled = df.agg(*[F.count(name).alias(name) for name in present + extra])

    def entry(name: str, status: str, count) -> F.Column:
        return F.struct(
            F.lit(name).alias("column"), F.lit(status).alias("status"), count.alias("filled")
        )

    report = (
        [entry(name, "present", F.col(f"`{name}`")) for name in present]
        + [entry(name, "extra", F.col(f"`{name}`")) for name in extra]
        + [entry(name, "missing", F.lit(0).cast("bigint")) for name in missing]
    )
    return filled.select(F.inline(F.array(*report)))
