"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partitions of the input that have a row of their own in the matrix; more are merged without a shuffle.
MOST_PARTITIONS = 8_192
#: Bits of a row's number within its partition in monotonically_increasing_id.
ROW_BITS = 33


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows of each partition go to each shard in a uniform shuffle.

    Shard sizes are the total divided evenly, the first shards one more. Each partition draws
    its counts without replacement from what the shards have left, so every column sums to its
    shard's size and every row to its partition's.
    """
    total = sum(rows)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    draw = np.random.Generator(np.random.PCG64(seed))
    matrix = np.zeros((len(rows), shards), np.int64)
    for p, n in enumerate(rows):
        over = n
        rest = int(left.sum())
        for s in range(shards):  # one hypergeometric draw for each shard, given those before it
            rest -= int(left[s])
            if over and left[s]:
                took = _draw(draw, int(left[s]), rest, over)
                matrix[p, s] = took
                over -= took
        left -= matrix[p]
    return matrix


def _draw(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without replacement; for 10**9 and more from the normal limit."""
    if not bad:
        return n
    if good + bad < 10**9:
        return int(draw.hypergeometric(good, bad, n))
    total = good + bad
    share = good / total
    deviation = np.sqrt(n * share * (1 - share) * (total - n) / (total - 1))
    return int(np.clip(np.rint(draw.normal(n * share, deviation)), max(0, n - bad), min(n, good)))


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """Rows in random order within their partition, with ``_partition`` and ``_at`` in it."""
    row = F.monotonically_increasing_id()
    mixed = docs.withColumn("_order", F.xxhash64(F.lit(seed), row)).sortWithinPartitions("_order")
    number = mixed.withColumn("_row", F.monotonically_increasing_id())
    return number.withColumn("_partition", F.shiftright("_row", ROW_BITS)).withColumn(
        "_at", F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    )


def _partitions(docs: DataFrame) -> list:
    """Number and rows of each partition that has any."""
    return docs.groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").collect()


def _matrix_table(spark: SparkSession, matrix: np.ndarray, numbers: list[int]) -> DataFrame:
    """``_partition, _upto``: for each partition the running totals of its row of the matrix."""
    totals = np.cumsum(matrix, 1)
    text = ";".join(f"{p}:" + ",".join(map(str, row)) for p, row in zip(numbers, totals.tolist()))
    lines = spark.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("_x"))
    return lines.select(
        F.split_part("_x", F.lit(":"), F.lit(1)).cast("long").alias("_partition"),
        F.split(F.split_part("_x", F.lit(":"), F.lit(2)), ",").cast("array<long>").alias("_upto"),
    )


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot``: a uniform shuffle, shard sizes at most one apart.

    1. Rows are counted by partition; the driver draws the matrix of counts from partitions to
       shards (one number for each pair; partitions beyond MOST_PARTITIONS are merged first).
    2. Each partition permutes its rows locally; the first ones go to shard 0, the next to shard
       1, and so on, as its row of the matrix says.
    3. Rows are exchanged by shard and block, where a row's random key names its block, and are
       permuted again within the block; ``slot`` counts from 0 through the blocks of the shard.

    Every row is placed once, whatever it holds: nulls, equal rows and long texts are rows like
    others, so no group of copies meets in one task; an empty table gives no rows. Columns named
    ``shard`` and ``slot`` are replaced. ``docs`` has to give the same rows in the same
    partitions whenever it is read, as a written table does. The order is fixed by the seed and
    the places of rows in their partitions.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    names = docs.columns
    found = _partitions(docs)
    if len(found) > MOST_PARTITIONS:
        docs = docs.coalesce(MOST_PARTITIONS)
        found = _partitions(docs)
    matrix = communication_matrix([r["count"] for r in found], shards, seed)
    if not len(matrix):
        matrix, numbers = np.zeros((1, shards), np.int64), [0]
    else:
        numbers = [r.p for r in found]
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(frame: DataFrame) -> DataFrame:
        rows = _placed(frame, seed).join(F.broadcast(_matrix_table(spark, matrix, numbers)), "_partition")
        shard = F.size(F.filter("_upto", lambda x: x <= F.col("_at"))).cast("int")
        key = F.xxhash64(F.lit(seed + 1), "_row")
        return rows.withColumn("shard", shard).withColumn("_key", key).withColumn("_block", F.pmod("_key", F.lit(blocks)))

    sizes = dealt(docs.select()).groupBy("shard", "_block").count()
    return _numbered(dealt(docs), sizes, names)


def _numbered(rows: DataFrame, sizes: DataFrame, names: list[str]) -> DataFrame:
    from pyspark.sql import Window

    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_block").orderBy("_key", "_row")
    slots = rows.withColumn("_rank", F.row_number().over(within) - 1).join(F.broadcast(first), ["shard", "_block"])
    return slots.select(*(f"`{n}`" for n in names), "shard", (F.col("_first") + F.col("_rank")).alias("slot"))


def text_size(text: Column) -> Column:
    """Bytes of a text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
