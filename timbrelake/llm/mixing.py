"""Mixing sources to target weights: systematic sampling of documents within each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbrelake.session import scratch_path

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated this often at most.
MOST = 3
#: Expected copies count in units of 2**-BITS, so that prefix sums are exact whole numbers.
BITS = 20
#: Bits of a row's number within its partition in monotonically_increasing_id.
ROW_BITS = 33
ADDED = ("size", "source_size", "target", "copies")


def words(text: Column) -> Column:
    """Number of runs of characters other than blanks and line and tab controls; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _sorted(frame: DataFrame, *order: Column | str, label: str) -> DataFrame:
    """The rows sorted in parallel and written, with ``part`` and ``at``, a row's partition and place in it."""
    number = F.monotonically_increasing_id()
    part, at = F.shiftright(number, ROW_BITS).alias("part"), number.bitwiseAND((1 << ROW_BITS) - 1).alias("at")
    return _written(frame.orderBy(*order).select("*", part, at), label)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``(key, source_size, ...)``: shares by weight, at most ``most`` times the size.

    Keys take the weights in their order, the empty key (no source) last. What a share has above
    its bound is dealt out again by weight among the others, until none is above. Each of these
    rounds is one aggregate of the table of sources, of which one row reaches the driver.
    """
    named = _sorted(sources, F.col("key") == "", "key", label="names")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    before = named.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    placed = named.join(before, "part").withColumn("place", F.col("before") + F.col("at")).drop("part", "at", "before")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    bounded = _written(placed.withColumn("weight", weight).withColumn("bound", most * F.col("source_size")), "sources")
    first = bounded.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("free")).first()
    whole, free, taken, level, full = first.size or 0, first.free or 0, 0, 0.0, 0
    while free:
        level = (whole - taken) / free
        above = F.col("bound") <= F.lit(level) * F.col("weight")
        now = bounded.agg(
            F.count_if(above).alias("full"), F.sum(F.when(above, F.col("bound"))).alias("taken"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if now.full == full:
            break
        full, taken, free = now.full, now.taken, now.free or 0
    return bounded.withColumn("target", F.least(F.col("bound").cast("double"), F.lit(float(level)) * F.col("weight"))).drop("weight", "bound", "place")


def copies(
    docs: DataFrame, size: Column, source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
    order: Column | None = None, seed: int = 29,
) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    All documents of a source have the same expected number of copies, its target over its size.
    In falling size their expected copies are added up, one random offset is added to the sums,
    and a document is taken once for every whole number that its sum crosses; so it is taken
    ``floor`` or ``ceil`` of the expected number, and the sizes taken differ from the target by
    less than twice the largest size. ``order`` decides among equal sizes (a hash of all columns
    if not given); rows that it does not tell apart follow their place in the input.

    The prefix sum is a parallel sort of narrow rows by source, size and order, which is written
    to the shared folder with each row's partition and place. Rows before a partition are counted
    by source and partition, so a large source is spread over many tasks like any other, and
    equal rows too. Only the finished numbers meet the documents again.

    A null size counts as zero, a negative one too; rows without a source are a source of their
    own. Sources without any size get no copies, equal rows count each for itself, an empty table
    gives no rows. Columns named like the four new ones are replaced, any others are kept whatever
    their names. ``docs`` has to give the same rows in the same partitions whenever it is read, as
    a written table does. A source may have up to 2**40 rows.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in hashed)) if order is None else order
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))
    uid = F.monotonically_increasing_id().alias("uid")
    narrow = _written(docs.select(uid, key.alias("key"), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"), tie.alias("tie")), "sizes")

    placed = _sorted(narrow, F.col("key") == "", "key", F.desc("size"), "tie", "uid", label="ordered").drop("tie")
    cells = placed.groupBy("key", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("words"), F.min("at").alias("first"))
    cells = _written(cells, "cells")
    sources = targets(cells.groupBy("key").agg(F.sum("words").alias("source_size")), weights, most)

    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("key", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("before"))
    unit = 1 << BITS
    share = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("key")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    steps = before.join(sources, "key").select(
        "key", "part", "before", "source_size", "target", offset.alias("offset"),
        F.least(F.floor(share * unit + 0.5), F.lit(most * unit)).alias("step"),
    )
    rank = F.col("before") + F.col("at")
    crossed = F.shiftright((rank + 1) * F.col("step") + F.col("offset"), BITS) - F.shiftright(rank * F.col("step") + F.col("offset"), BITS)
    drawn = placed.join(steps, ["key", "part"]).select("uid", "size", "source_size", "target", crossed.cast("int").alias("copies"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), *(F.col(f"`{c}`").alias(n) for n, c in zip(names, own)))
    return rows.join(drawn, "uid").select(*(F.col(n).alias(c) for n, c in zip(names, own)), *ADDED)


def mix(docs: DataFrame, size: Column, **settings) -> DataFrame:
    """The mixed table itself: every document as often as :func:`copies` takes it, with ``copy`` from 1.

    A column named ``copy`` is replaced, and so are those named like the new ones of ``copies``.
    """
    taken = copies(docs.drop("copy"), size, **settings).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
