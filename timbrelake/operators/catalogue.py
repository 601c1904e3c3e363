"""Catalogue work: tag counts, per-class caps, run accounting."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import MAX_PER_CLASS, TOP_TAGS, WANTED_GENRES
from timbrelake.functions.keys import first_genre, genre_set, genre_tags
from timbrelake.operators.filters import overlapping
from timbrelake.session import ship_package

# Spread of one class over parallel buffers before its last one.
_SPREAD = 64
# Rows that a buffer takes in before it is cut.
_HELD = 1 << 16


def top_tags(df: DataFrame, tags: str = "tags", n: int = TOP_TAGS) -> DataFrame:
    """Most frequent genre tags; every tag of every row counts."""
    return (
        df.select(F.explode(genre_tags(F.col(tags))).alias("genre"))
        .groupBy("genre")
        .count()
        .orderBy(F.desc("count"), "genre")
        .limit(n)
    )


def wanted_rows(
    df: DataFrame, tags: str = "tags", wanted: Sequence[str] = WANTED_GENRES
) -> DataFrame:
    """Rows that carry a wanted genre anywhere among their tags, with ``matched``."""
    genres = df.withColumn("_genres", genre_set(F.col(tags)))
    return overlapping(genres, "_genres", wanted).drop("_genres")


def wanted_repartition(
    df: DataFrame, tags: str = "tags", wanted: Sequence[str] = WANTED_GENRES
) -> DataFrame:
    """Rows per wanted genre, each counted once per row, and the number of rows kept overall."""
    kept = wanted_rows(df, tags, wanted)
    per_genre = kept.select(F.explode("matched").alias("genre")).groupBy("genre").count()
    return per_genre.withColumn("kept", kept.agg(F.count("*")).scalar())


def cap_per_class(
    df: DataFrame,
    label: str,
    *order: str | Column,
    cap: int = MAX_PER_CLASS,
    spread: int = _SPREAD,
) -> DataFrame:
    """The first ``cap`` rows of every class in the given (ascending) order, NULL first, NaN last.

    A buffer of the first rows of each class is cut like any partial aggregate: in the task that
    reads the rows, again by class and one of ``spread`` hash slices, and at last by class. Any
    cap and any share of the rows in one class work the same way; a task holds two buffers of the
    classes that it has at once, and what leaves it are ``cap`` rows a class. Rows without a
    label are a class; of rows that the order does not tell apart any may be kept.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    own = [f"c{i}" for i in range(len(df.columns))]
    kinds = {f"k{i}": kind for i, (_, kind) in enumerate(df.select(*keys).dtypes)}
    tests = [F.isnan(f"k{i}").alias(f"n{i}") for i, kind in enumerate(kinds.values()) if kind in ("double", "float")]
    places = [n for i, k in enumerate(kinds) for n in ([f"n{i}"] if kinds[k] in ("double", "float") else []) + [k]]
    ship_package(df.sparkSession)
    rows = df.select(
        F.col(f"`{label}`").alias("label"), *(key.alias(k) for key, k in zip(keys, kinds)),
        *(F.col(f"`{c}`").alias(n) for n, c in zip(own, df.columns)),
    ).select("*", *tests)
    schema = rows.schema
    partial, last = _first_rows(places, cap, False), _first_rows(places, cap, True)
    once = rows.mapInArrow(partial, schema)
    twice = once.repartition("label", F.pmod(F.xxhash64(*kinds), F.lit(spread))).mapInArrow(partial, schema)
    final = twice.repartition("label").sortWithinPartitions("label").mapInArrow(last, schema)
    return final.select(*(F.col(n).alias(c) for n, c in zip(own, df.columns)))


def _first_rows(keys: Sequence[str], cap: int, by_label: bool):
    """Function from batches to the first rows of each label; with ``by_label`` they come sorted by it."""
    order = [(k, "ascending") for k in ("label", *keys)]

    def cut(held: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start"))
        code = table.column("label").combine_chunks().dictionary_encode("encode").indices.to_numpy()
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        rank = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
        return table.filter(pa.array(rank < cap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, _HELD
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < limit:
                continue
            table = cut(held)
            if by_label:  # all labels but the last are complete
                code = table.column("label").combine_chunks().dictionary_encode("encode").indices.to_numpy()
                done = int(np.flatnonzero(code == code[-1])[0])
            else:  # many labels, of which little can be cut: later steps do it
                done = table.num_rows if table.num_rows > _HELD // 2 and table.num_rows > size // 2 else 0
            yield from table.slice(0, done).to_batches()
            rest = table.slice(done)
            held, size = rest.to_batches(), rest.num_rows
            limit = max(_HELD, 2 * size)
        if size:
            yield from cut(held).to_batches()

    return run


def cap_first_genre(
    df: DataFrame,
    *order: str | Column,
    tags: str = "tags",
    wanted: Sequence[str] = WANTED_GENRES,
    cap: int = MAX_PER_CLASS,
) -> DataFrame:
    """The cap applied to rows whose first genre is a wanted one."""
    labelled = df.withColumn("genre", first_genre(F.col(tags)))
    return cap_per_class(labelled.filter(F.col("genre").isin(list(wanted))), "genre", *order,
                         cap=cap)


def run_accounting(
    names: DataFrame, done: DataFrame, results: DataFrame, column: str, flag: str = "ok"
) -> DataFrame:
    """Names found, already done, pending, failed and extracted, in one row.

    ``done`` and ``results`` hold a name at most once.
    """
    status = (
        names.select(column)
        .join(done.select(column, F.lit(True).alias("_done")), column, "left")
        .join(results.select(column, F.col(flag).alias("_ok")), column, "left")
    )
    is_done = F.col("_done").isNotNull()
    return status.agg(
        F.count("*").alias("found"),
        F.count_if(is_done).alias("done"),
        F.count_if(~is_done).alias("pending"),
        F.count_if(~is_done & (F.col("_ok") == 0)).alias("failed"),
        F.count_if(~is_done & (F.col("_ok") == 1)).alias("extracted"),
    )
