"""Parquet and TSV writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import CATALOGUE_FIELDS
from timbrelake.operators.filters import only_ok
from timbrelake.sources.tables import open_bucketed

# The writer trims values unless told not to.
_UNTRIMMED = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Append below one directory per value. Rows stay where they are: no value, however
    frequent, is gathered into one task."""
    df.write.mode("append").partitionBy(*columns).parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    """Append the rows that were processed without failure."""
    only_ok(df).write.mode("append").parquet(path)


def write_shards(df: DataFrame, root: str, shard: str = "shard") -> None:
    """All shards in one write: a directory ``shard=i`` for each value of the column."""
    df.write.mode("overwrite").partitionBy(shard).parquet(root)


def write_shard(df: DataFrame, root: str, shard: int) -> str:
    """Write one shard to its own directory; all of them are read back as one data set."""
    path = f"{root}/dataset_part{shard}.parquet"
    overwrite(df, path)
    return path


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, sep="\t", **_UNTRIMMED).csv(path)


def write_catalogue(
    df: DataFrame,
    path: str,
    tags: str = "tags",
    fixed: Sequence[str] = CATALOGUE_FIELDS,
    tag_header: str = "TAGS",
) -> None:
    """Ragged catalogue: the header, then the fixed fields and all tags of each row."""
    header = "\t".join([*fixed, tag_header])
    line = F.concat_ws("\t", *[F.col(name).cast("string") for name in fixed], F.col(tags))
    write_lines(df.select(line.alias("line")), path, header)


def write_lines(df: DataFrame, path: str, header: str) -> None:
    """The ``line`` column as it is, below a header line in every file; without rows, the header alone.

    The first row of each partition brings the header with it. A row of its own stands for a
    table without any, and gives a file that holds the header only.
    """
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    both = F.when(first, F.array(F.lit(header), F.col("line"))).otherwise(F.array(F.col("line")))
    rows = df.select(F.explode(both).alias("value"))
    alone = df.sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("value"))
    rows.union(alone).write.mode("overwrite").text(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None, append: bool = False) -> None:
    """Feature store by key: files of ``buckets`` hash buckets of the key, each sorted by it.

    Two stores with the same number of buckets, or a store and any other table, join by the key
    without an exchange of the store (:func:`timbrelake.sources.read_bucketed`). The number of
    buckets is kept beside the data; by default it is that of shuffle partitions, below which
    Spark would rather shuffle both sides. An appended part adds one file to each bucket.
    """
    spark = df.sparkSession
    layout = f"{path}_layout"
    if append:
        known = spark.read.json(layout).first()
        if known["key"] != key:
            raise ValueError(f"the store at {path} is bucketed by {known['key']}")
        buckets = known["buckets"]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"store_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
    if append:
        open_bucketed(spark, path, name)
    writer.mode("append" if append else "overwrite").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the data stay: the table is an external one
    if not append:
        described = spark.range(0, 1, 1, 1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"))
        described.write.mode("overwrite").json(layout)
