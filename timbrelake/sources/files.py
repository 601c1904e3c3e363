"""File listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.constants import SAMPLE_FRACTION, SAMPLE_SEED
from timbrelake.sources.listing import list_folders

#: Hexadecimal digits of a hash that names are counted by.
DIGITS = 4


def list_files(
    spark: SparkSession,
    root: str,
    glob: str = "*.wav",
    recursive: bool = True,
    content: bool = False,
) -> DataFrame:
    """Files below ``root`` matching ``glob``; bytes are read only when ``content`` is asked for.

    Without bytes the executors list the folders where they can (:mod:`timbrelake.sources.listing`);
    otherwise, and with bytes, Spark's binary file source does, whose names the driver holds.
    """
    if not content:
        listed = list_folders(spark, root, glob, recursive)
        if listed is not None:
            return listed.select("path")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
    )
    return files.select("path", "length", "content") if content else files.select("path")


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path and bytes of the named files, read by Spark from whatever store holds them.

    Names are taken literally. A file that cannot be read fails its task, which Spark repeats.
    """
    literal = [re.sub(r"([\\\\*?\[\]{}])", r"\\\1", path) for path in paths]
    return spark.read.format("binaryFile").load(literal).select("path", "content")


def list_by_prefix(names: DataFrame, column: str, prefix: str, suffix: str = "") -> DataFrame:
    """Names starting with ``prefix`` and ending with ``suffix``, sorted."""
    kept = F.col(column).startswith(prefix) & F.col(column).endswith(suffix)
    return names.filter(kept).orderBy(column)


def _draw(name: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), name))


def sample_names(
    names: DataFrame,
    column: str,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Exactly ``max(1, floor(n * fraction))`` names, drawn by a seeded hash order.

    The sample is a filter on the hash. Names are counted by the first digits of their hashes, at
    most ``16 ** DIGITS`` numbers; the one group that the sample ends in is cut at its last name.
    No name is sorted or shuffled but those of that group. Of a name that stands there more than
    once as many rows are taken as are missing.
    """
    drawn = names.select(F.col(column).alias("name"), F.coalesce(_draw(F.col(column), seed), F.lit("")).alias("draw"))
    first = F.substring("draw", 1, DIGITS)
    counts = sorted(tuple(row) for row in drawn.groupBy(first.alias("first")).count().collect())
    total = sum(n for _, n in counts)
    left = max(1, int(total * fraction))
    for digits, n in counts:
        if left <= n:
            break
        left -= n
    else:
        return drawn.select(F.col("name").alias(column))  # no names at all, or all of them
    ends = drawn.filter(first == digits).orderBy("draw", "name").limit(left)
    last = ends.agg(F.max(F.struct("draw", "name"))).first()[0]
    here = F.struct("draw", "name")
    edge = F.lit(last["draw"]), F.lit(last["name"]).cast(drawn.schema["name"].dataType)
    bound = F.struct(edge[0].alias("draw"), edge[1].alias("name"))
    missing = ends.filter(here == bound).count()
    below = drawn.filter(here < bound).union(drawn.filter(here == bound).limit(missing))
    return below.select(F.col("name").alias(column))
