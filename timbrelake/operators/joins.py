"""Joins. Sizes and skew are settled at run time by adaptive execution.

No side is given a broadcast hint here: adaptive execution broadcasts a side once its measured
size is below the threshold, and otherwise sort-merges and splits partitions that a frequent key
has made too large. To keep that splitting possible both join inputs are plain shuffles, without
an aggregation between shuffle and join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.constants import FILE_KEY_PATTERN, TAG_PATTERN, TRACK_KEY_PATTERN
from timbrelake.functions.keys import numeric_key, tag_values


def keyed_features(
    features: DataFrame, path: str = "path", pattern: str = FILE_KEY_PATTERN
) -> DataFrame:
    """Features with the numeric key found in their path."""
    return features.withColumn("track_num", numeric_key(F.col(path), pattern))


def keyed_metadata(
    metadata: DataFrame,
    track_id: str = "TRACK_ID",
    path: str = "PATH",
    tags: str | Column = "TAGS",
    key_pattern: str = TRACK_KEY_PATTERN,
    tag_pattern: str = TAG_PATTERN,
) -> DataFrame:
    """Metadata as key, original id, path and genre array.

    ``tags`` is a string column searched with ``tag_pattern``, or an array expression.
    """
    genres = tag_values(F.col(tags), tag_pattern) if isinstance(tags, str) else tags
    return metadata.select(
        F.col(track_id).alias("TRACK_ID"),
        F.col(path).alias("meta_path"),
        numeric_key(F.col(track_id), key_pattern).alias("track_num"),
        genres.alias("genres"),
    )


def enrich(features: DataFrame, metadata: DataFrame, key: str = "track_num") -> DataFrame:
    """Features that have metadata, with it. Rows without a key match nothing."""
    return features.join(metadata, key, "inner")


def pending(names: DataFrame, done: DataFrame, column: str) -> DataFrame:
    """Names not among the done ones."""
    return names.join(done.select(column), column, "left_anti")


def listed(names: DataFrame, manifest: DataFrame, column: str) -> DataFrame:
    """Names that the manifest lists."""
    return names.join(manifest.select(column), column, "left_semi")


def checksum_report(
    files: DataFrame, manifest: DataFrame, name: str = "name", content: str = "content"
) -> DataFrame:
    """Digest of every listed file against the manifest's; unlisted files are left out.

    The content is reduced to its digest before anything is shuffled.
    """
    digests = files.select(name, F.sha2(F.col(content), 256).alias("actual"))
    expected = manifest.select(name, F.col("sha256").alias("expected"))
    # Null-safe, so that no "is not null" test is pushed down that would hash the content twice.
    matches = F.col("actual").eqNullSafe(F.col("expected"))
    return digests.join(expected, name, "inner").withColumn("matches", matches)


def checksum_mismatches(
    files: DataFrame, manifest: DataFrame, name: str = "name", content: str = "content"
) -> DataFrame:
    report = checksum_report(files, manifest, name, content)
    return report.filter(~F.col("matches")).drop("matches")


def resolve_labels(predictions: DataFrame, labels: list[str], index: str) -> DataFrame:
    """Label of a predicted index; ``labels`` is the model's own, bounded list."""
    names = F.array(*[F.lit(label) for label in labels])
    return predictions.withColumn("label", F.get(names, F.col(index).cast("int")))
