"""Global positions without a single-partition window, and what is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import BATCH_SIZE
from timbrelake.session import shared_dir

# monotonically_increasing_id() keeps the partition number above this many bits.
_LOCAL_BITS = 33


def global_index(
    df: DataFrame, *order: str | Column, name: str = "row_index"
) -> tuple[DataFrame, int]:
    """Zero-based position of every row in the given order, and the number of rows.

    The rows are range-partitioned and sorted in parallel and the result is checkpointed in the
    shared folder. That fixes the partitions, so a lost executor cannot change a position. The
    position is then the row's place in its partition plus the number of rows before that
    partition; only these offsets, one per partition, pass through the driver. ``order`` has to
    identify a row, which also lets the range partitioner split a frequent leading value.
    """
    spark = df.sparkSession
    shared_dir(spark)
    fixed = df.orderBy(*order).checkpoint(eager=True)
    tagged = fixed.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", _LOCAL_BITS)
    )
    sizes = sorted(tagged.groupBy("_part").count().collect())
    offsets, total = [], 0
    for part, rows in sizes:
        offsets.append((part, total))
        total += rows
    # One row per partition of the sort, so the broadcast is bounded by the partition count.
    before = spark.createDataFrame(offsets, "_part BIGINT, _before BIGINT")
    local = F.col("_id").bitwiseAND((1 << _LOCAL_BITS) - 1)
    indexed = (
        tagged.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_id", "_before")
    )
    return indexed, total


def batch_number(position: Column, size: int = BATCH_SIZE, first: int = 0) -> Column:
    """Number of the batch a position falls into; ``first`` continues an earlier numbering."""
    return F.floor(position / F.lit(size)).cast("bigint") + F.lit(first)


def assign_batches(
    df: DataFrame, *order: str | Column, size: int = BATCH_SIZE, first: int = 0
) -> DataFrame:
    """Batches of ``size`` rows each in the given order; only the last one may be smaller."""
    indexed, _ = global_index(df, *order)
    batch = batch_number(F.col("row_index"), size, first)
    return indexed.withColumn("batch_id", batch).drop("row_index")


def shard_index(df: DataFrame, *order: str | Column, shards: int, name: str = "shard") -> DataFrame:
    """Shard of every row: the sorted rows are dealt out in turn, with one sort for all shards."""
    indexed, _ = global_index(df, *order)
    return indexed.withColumn(name, (F.col("row_index") % shards).cast("int")).drop("row_index")


def shard_slice(df: DataFrame, *order: str | Column, shard: int, shards: int) -> DataFrame:
    """Every ``shards``-th row of the sorted rows, starting with row ``shard``."""
    return shard_index(df, *order, shards=shards, name="_shard").filter(F.col("_shard") == shard).drop("_shard")
