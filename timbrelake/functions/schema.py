"""Schemas that follow from a rule: series names times statistics."""

from __future__ import annotations

from pyspark.sql import types as T

from timbrelake.constants import N_CHROMA, N_CONTRAST, N_MFCC, N_TONNETZ, STATISTICS


def _numbered(name: str, n: int) -> list[str]:
    return [f"{name}_{i}" for i in range(1, n + 1)]


#: Feature series in compact order, before and after the scalar tempo.
SERIES_BEFORE_TEMPO = [
    *_numbered("mfcc", N_MFCC), "centroid", "bandwidth", "rolloff", "flatness",
    *_numbered("contrast", N_CONTRAST),
]
SERIES_AFTER_TEMPO = [
    "onset", *_numbered("chroma", N_CHROMA), *_numbered("tonnetz", N_TONNETZ), "rms", "zcr",
]
SERIES = [*SERIES_BEFORE_TEMPO, *SERIES_AFTER_TEMPO]

_LONG = {
    "centroid": "spectral_centroid", "bandwidth": "spectral_bandwidth",
    "rolloff": "spectral_rolloff", "flatness": "spectral_flatness", "onset": "onset_strength",
}


def long_name(series: str) -> str:
    """Name of a series in the array-valued table."""
    if series.startswith("contrast"):
        return f"spectral_{series}"
    return _LONG.get(series, series)


def statistic_names(series: list[str]) -> list[str]:
    return [f"{name}_{stat}" for name in series for stat in STATISTICS]


def compact_names() -> list[str]:
    """The 209 feature columns of the compact table."""
    return [*statistic_names(SERIES_BEFORE_TEMPO), "tempo", *statistic_names(SERIES_AFTER_TEMPO)]


def compact_schema() -> T.StructType:
    fields = [T.StructField(name, T.DoubleType()) for name in compact_names()]
    return T.StructType([*fields, T.StructField("ok", T.IntegerType())])


def series_schema() -> T.StructType:
    """Array-valued feature table: one array per series, tempo as a scalar."""
    series = T.ArrayType(T.DoubleType())
    before = [T.StructField(long_name(name), series) for name in SERIES_BEFORE_TEMPO]
    after = [T.StructField(long_name(name), series) for name in SERIES_AFTER_TEMPO]
    return T.StructType([*before, T.StructField("tempo", T.DoubleType()), *after])


def training_columns() -> list[str]:
    """Columns of the joined training set."""
    return ["track_num", "path", *compact_names(), "batch_id", "TRACK_ID", "meta_path", "genres"]
