"""Single items against the data set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import COMPARED_FEATURES, RADAR_COEFFICIENTS, RADAR_GROUPS
from timbrelake.operators.profile import top_groups


def track_vs_dataset(
    tracks: DataFrame,
    stats: DataFrame,
    *keys: str,
    features: Sequence[str] = COMPARED_FEATURES,
) -> DataFrame:
    """One row per track and feature: value, bands of the data set, distance from its mean.

    ``stats`` is the single row of :func:`timbrelake.operators.profile.feature_stats`.
    """

    def known(name: str) -> Column:
        low, high = F.col(f"{name}__min"), F.col(f"{name}__max")
        return F.struct(
            F.lit(name).alias("feature"),
            F.coalesce(f"{name}__mean", F.lit(0.0)).alias("ds_mean"),
            F.coalesce(f"{name}__std", F.lit(0.0)).alias("ds_std"),
            F.coalesce(low, F.lit(0.0)).alias("ds_min"),
            F.coalesce(high, F.lit(1.0)).alias("ds_max"),
            F.coalesce(f"{name}__p10", low, F.lit(0.0)).alias("ds_p10"),
            F.coalesce(f"{name}__p90", high, F.lit(1.0)).alias("ds_p90"),
        )

    def own(name: str) -> Column:
        value = F.col(name) if name in tracks.columns else F.lit(0.0)
        return F.struct(
            F.lit(name).alias("feature"),
            F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
        )

    # One row per compared feature, so the broadcast side has a handful of rows.
    bands = (
        stats.select(F.inline(F.array(*[known(name) for name in features])))
        .withColumn("band_low", F.round(F.col("ds_mean") - F.col("ds_std"), 6))
        .withColumn("band_high", F.round(F.col("ds_mean") + F.col("ds_std"), 6))
    )
    gap = F.try_divide(F.col("value") - F.col("ds_mean"), F.col("ds_mean")) * 100
    size = F.abs("delta_pct")
    return (
        tracks.select(*keys, F.inline(F.array(*[own(name) for name in features])))
        .join(F.broadcast(bands), "feature")
        .withColumn("delta_pct", F.round(F.coalesce(gap, F.lit(0.0)), 4))
        .withColumn(
            "flag", F.when(size > 30, "red").when(size > 10, "yellow").otherwise("green")
        )
    )


def _polygon(values: Sequence[Column]) -> Column:
    """Axis positions, labels and values; the first axis is repeated to close the outline."""
    corners = [*enumerate(values, 1), (1, values[0])]
    return F.array(
        *[
            F.struct(
                F.lit(place).alias("position"),
                F.lit(f"MFCC {axis}").alias("axis"),
                value.cast("double").alias("value"),
            )
            for place, (axis, value) in enumerate(corners, 1)
        ]
    )


def profile_radar(
    profile: DataFrame,
    track: DataFrame,
    column: str = "genres",
    groups: int = RADAR_GROUPS,
    own_name: str = "track",
) -> DataFrame:
    """Outlines of the largest groups and of one track in long form."""
    axes = range(1, RADAR_COEFFICIENTS + 1)
    group_outline = _polygon([F.col(f"mfcc{i}") for i in axes])
    own_outline = _polygon(
        [
            F.coalesce(f"mfcc_{i}_mean", F.lit(0.0)) if f"mfcc_{i}_mean" in track.columns
            else F.lit(0.0)
            for i in axes
        ]
    )
    return (
        top_groups(profile, column, groups)
        .select(F.col(column).alias("series"), F.inline(group_outline))
        .unionByName(track.select(F.lit(own_name).alias("series"), F.inline(own_outline)))
    )
