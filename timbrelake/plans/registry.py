"""Query registry: a Spark function per name and, where SQL can say it, an equivalent query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def half_up(expression: str, places: int) -> str:
    """SQL twin of :func:`timbrelake.operators.profile.rounded`."""
    exact = f"CAST({expression} AS DECIMAL(38,{places + 5}))"
    return f"CAST(round({exact}, {places}) AS DOUBLE)"


def bucket_sql(key: str, buckets: int) -> str:
    """SQL twin of :func:`timbrelake.functions.keys.stable_bucket`."""
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {buckets} AS INTEGER)"
