"""Array columns: series statistics, top-k entries, named vector positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_stats(values: Column) -> Column:
    """Struct of mean, population std, min and max of a series; all zero if it is empty.

    The mean is bound as a lambda variable so that it is computed once per row and not once
    per element.
    """
    size = F.size(values)
    plus = lambda acc, x: acc + x
    mean = F.try_divide(F.aggregate(values, F.lit(0.0), plus), size)

    def summarise(centre: Column) -> Column:
        spread = F.aggregate(
            values, F.lit(0.0), lambda acc, x: acc + (x - centre) * (x - centre)
        )
        return F.struct(
            centre.alias("mean"),
            F.sqrt(spread / size).alias("std"),
            F.array_min(values).alias("min"),
            F.array_max(values).alias("max"),
        )

    nothing = F.struct(*[F.lit(0.0).alias(name) for name in ("mean", "std", "min", "max")])
    full = F.get(F.transform(F.array(mean), summarise), F.lit(0))
    return F.when(size > 0, full).otherwise(nothing)


def matrix_row_stats(matrix: Column, rows: int) -> Column:
    """Statistics of the first ``rows`` rows of a matrix, flattened row after row."""
    return F.flatten(
        F.transform(
            F.slice(matrix, 1, rows),
            lambda row: F.transform(
                F.array(series_stats(row)),
                lambda s: F.array(s["mean"], s["std"], s["min"], s["max"]),
            )[0],
        )
    )


def reshape(values: Column, width: int) -> Column:
    """A flat array cut into rows of ``width`` elements; a short tail is dropped."""
    rows = F.floor(F.size(values) / F.lit(width)).cast("int")
    starts = F.when(rows > 0, F.sequence(F.lit(0), rows - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.slice(values, i * width + 1, width))


def top_entries(values: Column, k: int) -> Column:
    """The ``k`` largest entries as structs of zero-based position and value, best first.

    Equal values keep the lower position first.
    """
    ranked = F.transform(
        values, lambda x, i: F.struct((-x).alias("key"), i.alias("position"), x.alias("value"))
    )
    return F.transform(
        F.slice(F.array_sort(ranked), 1, k),
        lambda e: F.struct(e["position"].alias("position"), e["value"].alias("value")),
    )


def name_positions(values: Column, names: Sequence[str]) -> Column:
    """Array of (position, name, value) structs; positions the vector lacks count as 0.0."""
    return F.transform(
        F.array(*[F.lit(name) for name in names]),
        lambda name, i: F.struct(
            (i + 1).alias("position"),
            name.alias("name"),
            F.coalesce(F.get(values, i), F.lit(0.0)).alias("value"),
        ),
    )
