"""Clustered tables: rows in the order of a space-filling key, so that ranges of several columns prune row groups."""

from __future__ import annotations

import bisect
import os
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: Cells of a column are 2**BITS parts of about equal numbers of rows.
BITS = 8
#: Bytes of a string behind its common beginning that order it.
PREFIX = 7


def _ordinals(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A number for each column that rises with it; strings count by the bytes behind their common beginning."""
    strings = [c for c in columns if df.schema[c].dataType.simpleString() == "string"]
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(strings) for f in (F.min, F.max)]).first() if strings else None
    out = []
    for c in columns:
        kind = df.schema[c].dataType
        if c in strings:
            i = strings.index(c)
            low, high = ends[f"min_{i}"], ends[f"max_{i}"]
            common = len(os.path.commonprefix([(low or "").encode(), (high or "").encode()]))
            part = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), common + 1, PREFIX)), 2 * PREFIX, "0")
            out.append(F.conv(part, 16, 10).cast("double"))
        elif isinstance(kind, DateType):
            out.append(F.unix_date(c).cast("double"))
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            out.append(F.unix_micros(F.col(c).cast("timestamp")).cast("double"))
        elif isinstance(kind, NumericType):
            out.append(F.col(c).cast("double"))
        else:
            raise TypeError(f"column {c} of type {kind.simpleString()} has no order to cluster by")
    return out


def with_cluster_key(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS) -> DataFrame:
    """Add the Z-order key of some columns: the bits of their cells in turn, the first column's highest first.

    Cell bounds are approximate percentiles of one pass, so a column takes part with as much
    detail as its values have, whatever their distribution; few values spread over all cells. NULL and NaN lie in the last cell.
    """
    numbers = [f"{name}_{i}" for i in range(len(columns))]
    rows = df.withColumns(dict(zip(numbers, _ordinals(df, columns))))
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(F.when(~F.isnan(n), F.col(n)), shares, 20 << bits).alias(n) for n in numbers]).first()
    cells = [f"{n}_cell" for n in numbers]
    splits = [[-float("inf"), *sorted(set(found[n] or [0.0])), float("inf")] for n in numbers]
    rows = Bucketizer(splitsArray=splits, inputCols=numbers, outputCols=cells, handleInvalid="keep").transform(rows)
    key = F.lit(0).cast("long")
    for i, (n, cell) in enumerate(zip(numbers, cells)):
        whole = F.coalesce(F.get(_ranks(found[n] or [0.0]), F.col(cell).cast("int")), F.lit((1 << bits) - 1)).cast("long")
        for b in range(bits):
            place = b * len(cells) + len(cells) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(whole, b).bitwiseAND(1), place))
    return rows.withColumn(name, key).drop(*numbers, *cells)


def _ranks(bounds: Sequence[float]) -> Column:
    """Cell number of each bucket: how many of all bounds, repeated ones included, lie below it."""
    return F.array(F.lit(0), *[F.lit(bisect.bisect_left(bounds, b)) for b in sorted(set(bounds))])


def write_clustered(df: DataFrame, path: str, *columns: str, rows_per_file: int = 4_000_000, row_group_bytes: int = 32 << 20, bits: int = BITS) -> None:
    """Overwrite a Parquet table whose files and row groups cover small boxes of the columns.

    Rows are range-partitioned and sorted by the Z-order key, which is not stored. A filter on any
    of the columns, or on several at once, then skips the row groups whose bounds lie outside.
    """
    name = "_z"
    while any(c == name or c.startswith(f"{name}_") for c in df.columns):
        name += "z"
    keyed = with_cluster_key(df, columns, name, bits)
    files = max(1, -(-df.count() // rows_per_file))
    placed = keyed.repartitionByRange(files, name, *columns).sortWithinPartitions(name, *columns).drop(name)
    placed.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)
