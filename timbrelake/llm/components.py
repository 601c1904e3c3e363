"""Connected components of a link table, as rounds of joins and minima (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.session import shared_dir


def _state(edges: DataFrame) -> tuple:
    """Number of links and 128 bits over all of them."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("u", "m")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of the links ``(a, b)``; root is the least node of its component.

    Nodes are longs. Self links are dropped, repeated links count once, links with a null are
    dropped, no links give no rows. A node with many neighbours is one row for each of them in a
    join, which adaptive execution can split, and a partially aggregated minimum. Every round is
    a reliable checkpoint in the shared folder; only two numbers a round reach the driver.
    """
    shared_dir(edges.sparkSession)
    links = edges.toDF("a", "b").where("a <> b").distinct().checkpoint()
    before = None
    while (now := _state(links)) != before:
        before = now
        links = _small_star(_large_star(links)).checkpoint()
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select("b", "b").distinct())
