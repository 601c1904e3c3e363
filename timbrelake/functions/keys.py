"""Keys, tags, paths, dates and stable buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from timbrelake.constants import TAG_PATTERN, TAG_PREFIX, USERS


def numeric_key(column: Column, pattern: str) -> Column:
    """First group of ``pattern`` as an int; anything else becomes NULL instead of an error."""
    return F.regexp_extract(column, pattern, 1).try_cast("int")


def tag_values(column: Column, pattern: str = TAG_PATTERN) -> Column:
    """Every match of a tag pattern in a string."""
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(1))


def genre_tags(tags: Column, prefix: str = TAG_PREFIX) -> Column:
    """Tags with the given prefix, stripped of it, in order and with repetitions."""
    marked = F.filter(tags, lambda tag: tag.startswith(prefix))
    return F.transform(marked, lambda tag: F.substring(tag, len(prefix) + 1, 2**31 - 1))


def genre_set(tags: Column, prefix: str = TAG_PREFIX) -> Column:
    """The same, each value once."""
    return F.array_distinct(genre_tags(tags, prefix))


def first_genre(tags: Column, prefix: str = TAG_PREFIX) -> Column:
    """First such tag, or NULL."""
    return F.get(genre_tags(tags, prefix), F.lit(0))


def first_of(values: Column) -> Column:
    """First element of an array, NULL if there is none."""
    return F.get(values, F.lit(0))


def tag_indicator(values: Column, tag: str) -> Column:
    """1.0 if the array holds ``tag``, else 0.0."""
    return F.array_contains(values, tag).cast("double")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def swap_suffix(path: Column, suffix: str) -> Column:
    """Replace the extension of the last path part; a name without one gets it appended."""
    return F.concat(F.regexp_replace(path, r"([^/])\.[^./]+$", "$1"), F.lit(suffix))


def swap_prefix(path: Column, old: str, new: str) -> Column:
    """Move ``old/rest`` to ``new/rest``; other paths go below ``new`` whole."""
    head = f"{old}/"
    rest = F.when(
        path.startswith(head), F.substring(path, len(head) + 1, 2**31 - 1)
    ).otherwise(path)
    return F.concat(F.lit(f"{new}/"), rest)


def is_digits(column: Column) -> Column:
    return column.rlike("^[0-9]+$")


def strip_scheme(uri: Column) -> Column:
    """Absolute path of a ``scheme:/path`` or ``scheme:///path`` address."""
    return F.regexp_replace(uri, "^[a-z][a-z0-9+.-]*:/+", "/")


def split_uri(uri: Column) -> Column:
    """``scheme://bucket/key`` as a struct of bucket and key."""
    rest = F.regexp_replace(uri, "^[a-z][a-z0-9+.-]*://", "")
    bucket = F.substring_index(rest, "/", 1)
    return F.struct(
        bucket.alias("bucket"),
        F.regexp_replace(rest, "^[^/]*/?", "").alias("key"),
    )


def iso_date(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def coerce_date(value: Column, today: dt.date | None = None) -> Column:
    """Date of a date, timestamp or ISO string; ``today`` (default: the current date) for NULL
    and for what is no date."""
    fallback = F.lit(today) if today else F.current_date()
    return F.coalesce(F.substring(value.cast("string"), 1, 10).try_cast("date"), fallback)


def duration_seconds(samples: Column, rate: Column) -> Column:
    return F.try_divide(samples.cast("double"), rate.cast("double"))


def stable_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 that depends on the key alone, never on partitioning or run."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10)
    return F.pmod(digest.cast("bigint"), F.lit(buckets)).cast("int")


def assign_user(key: Column, users: int = USERS) -> Column:
    """Synthetic user id; a rerun gives every row the same user again."""
    return stable_bucket(key, users)
