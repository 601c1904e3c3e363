"""Stored roll-up of a data set: counts and moments that can be added up, kept current batch by batch."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.constants import COMPARED_FEATURES, PROFILE_COLUMNS, TEMPO_BUCKETS
from timbrelake.operators import filters, profile
from timbrelake.operators.filters import Selection
from timbrelake.session import path_exists, shared_dir

#: What a selection can restrict, as far as the data set has it.
DIMENSIONS = ("genres", "user_id", "uploaded_at")


def _measured(columns: list[str]) -> list[str]:
    wanted = dict.fromkeys([source for source, _, _ in PROFILE_COLUMNS] + list(COMPARED_FEATURES) + ["duration"])
    return [name for name in wanted if name in columns]


def cells(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each combination of the dimensions (and ``keys``) that occurs.

    It has the number of rows, those of each tempo band, and of each measured column the number
    of values, their sum, their squared distance from their own mean, and their bounds.
    """
    bucket = profile.tempo_bucket(F.col("tempo"))
    figures = [F.count("*").alias("count")]
    figures += [F.count_if(bucket == label).alias(f"band_{i}") for i, label in enumerate(TEMPO_BUCKETS)]
    for name in _measured(rows.columns):
        figures += [
            F.count(name).alias(f"{name}__n"), F.sum(F.col(name).cast("double")).alias(f"{name}__sum"),
            (F.var_pop(name) * F.count(name)).alias(f"{name}__m2"), F.min(name).alias(f"{name}__min"), F.max(name).alias(f"{name}__max"),
        ]
    present = [name for name in DIMENSIONS if name in rows.columns]
    return rows.groupBy(*keys, *present).agg(*figures)


def refresh(spark: SparkSession, dataset: DataFrame, store: str, batch: str = "batch_id") -> int:
    """Add the cells of the batches that the store does not have yet; how many these are.

    Only those batches are read: their numbers are compared with those of the store, and the
    filter on them prunes the folders of a data set that is partitioned by batch. Each batch's
    cells go to a folder of their own, which is replaced as a whole, so that a refresh that was
    ended half-way is made up for by the next one. Cells are dealt out in ranges of batch and
    dimensions, so that a large batch is written by many tasks, a small one by few.
    """
    known = dataset.select(batch).distinct()
    if path_exists(spark, store):
        known = known.join(spark.read.parquet(store).select(batch).distinct(), batch, "left_anti")
    new = sorted(row[0] for row in known.collect())  # one number a batch
    if new:
        fresh = cells(dataset.filter(F.col(batch).isin(new)), batch)
        dealt = fresh.repartitionByRange(batch, *(name for name in DIMENSIONS if name in fresh.columns))
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(batch).parquet(store)
    return len(new)


def select_cells(stored: DataFrame, selection: Selection) -> DataFrame:
    """The cells of a selection. Durations are no dimension, so a range of them has no cells."""
    if selection.duration:
        raise ValueError("a roll-up does not tell durations apart: select from the rows")
    return filters.select_rows(stored, selection)


def _mean(name: str, places: int) -> Column:
    return profile.rounded(F.try_divide(F.sum(f"{name}__sum"), F.sum(f"{name}__n")), places)


def group_profile(chosen: DataFrame, column: str = "genres") -> DataFrame:
    """:func:`profile.group_profile` of all groups, from cells."""
    figures = [_mean(source, places).alias(name) for source, name, places in PROFILE_COLUMNS]
    figures.append(F.sum("count").alias("count"))
    if "duration__n" in chosen.columns:
        figures.append(_mean("duration", 1).alias("duration_avg"))
    return chosen.groupBy(column).agg(*figures)


def feature_stats(chosen: DataFrame, places: int = 6) -> DataFrame:
    """Mean, sample std, min and max of the compared features, from cells: one row without percentiles.

    Squared distances are taken to the common mean, so that no digits are lost between cells.
    """
    figures = []
    for name in COMPARED_FEATURES:
        total, n = f"{name}__sum", f"{name}__n"
        means = chosen.agg(F.try_divide(F.sum(total), F.sum(n))).scalar()
        shift = F.coalesce(F.try_divide(total, n), F.lit(0.0)) - means
        spread = F.sum(F.coalesce(f"{name}__m2", F.lit(0.0)) + F.col(n) * shift * shift)
        figures += [
            _mean(name, places).alias(f"{name}__mean"),
            profile.rounded(F.sqrt(F.try_divide(spread, F.nullif(F.sum(n) - 1, F.lit(0)))), places).alias(f"{name}__std"),
            F.round(F.min(f"{name}__min"), places).alias(f"{name}__min"), F.round(F.max(f"{name}__max"), places).alias(f"{name}__max"),
        ]
    return chosen.agg(*figures)


def bucket_histogram(chosen: DataFrame) -> DataFrame:
    """:func:`profile.bucket_histogram` from cells."""
    bands = F.array(*[F.struct(F.lit(label).alias("bucket"), F.col(f"band_{i}").alias("n")) for i, label in enumerate(TEMPO_BUCKETS)])
    counts = chosen.select(F.inline(bands)).groupBy("bucket").agg(F.sum("n").alias("count")).filter("count > 0")
    return profile.histogram_of(counts)


def overview(stored: DataFrame, selection: Selection = Selection()) -> dict[str, DataFrame]:
    """The tables of :func:`timbrelake.plans.jobs.overview` from a roll-up; ``feature_stats`` without percentiles."""
    chosen = select_cells(stored, selection)
    shared_dir(stored.sparkSession)
    groups = group_profile(chosen).checkpoint(eager=True)
    largest = profile.top_groups(groups)
    stats = profile.group_zscore(largest)
    key_figures = [F.coalesce(F.sum("count"), F.lit(0)).alias("total"), _mean("tempo", 1).alias("tempo_mean"), F.countDistinct("genres").alias("n_genres")]
    if "duration__n" in chosen.columns:
        key_figures.append(_mean("duration", 1).alias("duration_avg"))
    return {
        "kpi": chosen.agg(*key_figures).na.fill(0),
        "genres": profile.pareto_of(groups.select("genres", "count")),
        "tempo_buckets": bucket_histogram(chosen),
        "stats": stats,
        "zcr_flatness": profile.noise_of(largest),
        "feature_stats": feature_stats(chosen),
        "summary": profile.summary_table(stats),
    }


def merged(*stores: DataFrame) -> DataFrame:
    """Cells of several roll-ups as one; cells of equal dimensions need not be joined, as they add up."""
    return functools.reduce(lambda a, b: a.unionByName(b), stores)
