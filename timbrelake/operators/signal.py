"""Distributed signal features.

Input is one row per signal: the samples themselves (``samples`` array and ``sr``) or the bytes of
a WAV file (``content``), as Spark's binary file source reads them. Features of a signal are
computed where the signal is read, in Arrow batches bounded by bytes; nothing but the
features leaves the task.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrelake.functions.arrays import series_stats
from timbrelake.functions.dsp import (
    ALL_GROUPS,
    SignalConfig,
    analyse,
    groups_of,
    spectrum_of,
    summaries,
    tables,
)
from timbrelake.functions.keys import basename, duration_seconds, iso_date, stable_bucket
from timbrelake.functions.schema import (
    SERIES,
    SERIES_AFTER_TEMPO,
    SERIES_BEFORE_TEMPO,
    compact_schema,
    long_name,
    series_schema,
)
from timbrelake.session import ship_package

_STATUS = [
    T.StructField("n_samples", T.LongType()),
    T.StructField("sr", T.IntegerType()),
    T.StructField("ok", T.IntegerType()),
    T.StructField("error", T.StringType()),
]
_TEMPO_AT = len(SERIES_BEFORE_TEMPO) * 4
#: What decoding raises for content that is no usable signal; anything else fails the task.
_UNUSABLE = (ValueError, EOFError, wave.Error)


def _map(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


# --- reading signals ----------------------------------------------------------------------


def decode_pcm16(content: bytes) -> tuple[np.ndarray, int]:
    """Samples in [-1, 1) and sample rate of a 16-bit PCM WAV file; channels are averaged.

    A file written to a stream states no true length; it is read to its last whole frame.
    """
    with wave.open(io.BytesIO(content)) as source:
        if source.getsampwidth() != 2:
            raise ValueError(f"{8 * source.getsampwidth()}-bit samples")
        channels = source.getnchannels()
        raw = source.readframes(source.getnframes())
        whole = len(raw) // (2 * channels) * channels
        samples = np.frombuffer(raw, dtype="<i2", count=whole)
        return samples.reshape(-1, channels).mean(axis=1) / 32768.0, source.getframerate()


def _signals(batch: pa.RecordBatch) -> Iterator[Callable[[], tuple[np.ndarray, int]]]:
    """One function per row that returns the row's samples and rate, or raises."""
    names = batch.schema.names
    if "samples" in names:
        arrays, rates = batch.column("samples"), batch.column("sr")
        offsets, values = arrays.offsets.to_numpy(), arrays.values.to_numpy(zero_copy_only=False)
        for i in range(batch.num_rows):

            def stored(i: int = i) -> tuple[np.ndarray, int]:
                if not (arrays[i].is_valid and rates[i].is_valid):
                    raise ValueError("no samples")
                samples = values[offsets[i] : offsets[i + 1]]
                if not np.isfinite(samples).all():  # a NULL is NaN here
                    raise ValueError("samples that are no finite numbers")
                return samples, rates[i].as_py()

            yield stored
    else:
        for content in batch.column("content"):
            yield lambda content=content: decode_pcm16(content.as_py() or b"")


def decode_wav(files: DataFrame) -> DataFrame:
    """WAV files as signals: path, rate, samples; what cannot be decoded has ``ok = 0``."""
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("sr", T.IntegerType()),
            T.StructField("samples", T.ArrayType(T.DoubleType())),
            T.StructField("ok", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, read in zip(batch.column("path"), _signals(batch)):
                try:
                    samples, rate = read()
                    row = [rate, samples, 1]
                except _UNUSABLE:
                    row = [None, None, 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.as_py()], pa.string()),
                        pa.array(row[:1], pa.int32()),
                        pa.array([row[1]], pa.list_(pa.float64())),
                        pa.array(row[2:], pa.int32()),
                    ],
                    names=schema.names,
                )

    return _map(files, run, schema)


def frame_signal(signals: DataFrame, key: str, n: int, hop: int) -> DataFrame:
    """Frames of each signal as rows: key, rate, frame number, samples. No shuffle."""
    count = F.floor((F.size("samples") - n) / F.lit(hop)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count), lambda i: F.slice("samples", i * hop + 1, n)
    )
    return (
        signals.filter(F.size("samples") >= n)
        .select(key, "sr", F.posexplode(cut).alias("frame", "samples"))
    )


def spectrum(frames: DataFrame, n: int) -> DataFrame:
    """Magnitude spectrum of every frame, a batch of frames at a time."""
    kept = [field for field in frames.schema.fields if field.name != "samples"]
    schema = T.StructType([*kept, T.StructField("magnitude", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = tables(SignalConfig(n_fft=n), 1)["window"]
        for batch in batches:
            flat = batch.column("samples").flatten().to_numpy(zero_copy_only=False)
            rows = spectrum_of(flat.reshape(-1, n), window)
            columns = [batch.column(field.name) for field in kept]
            yield pa.RecordBatch.from_arrays([*columns, _lists(list(rows))], names=schema.names)

    return _map(frames, run, schema)


# --- features -----------------------------------------------------------------------------


def _lists(rows: Sequence[np.ndarray | None]) -> pa.Array:
    """A list column from one vector per row, without going through Python objects."""
    if any(row is None for row in rows):
        return pa.array(rows, pa.list_(pa.float64()))
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


class _Chunk:
    """Signals read together, with the status of each; None where reading failed.

    A failure of one signal is recorded in its row and never fails the task.
    """

    def __init__(self) -> None:
        self.signals: list[np.ndarray | None] = []
        self.rates: list[int | None] = []
        self.lengths: list[int | None] = []
        self.errors: list[str | None] = []
        self.samples = 0

    def add(self, read: Callable[[], tuple[np.ndarray, int]], cfg: SignalConfig) -> None:
        x = rate = length = error = None
        try:
            x, rate = read()
            length = len(x)
            if length < cfg.min_samples:
                raise ValueError(f"only {length} samples")
            self.samples += length
        except _UNUSABLE as failure:
            x, error = None, f"{type(failure).__name__}: {failure}"
        self.signals.append(x)
        self.rates.append(rate)
        self.lengths.append(length)
        self.errors.append(error)

    def status(self) -> list[pa.Array]:
        return [
            pa.array(self.lengths, pa.int64()),
            pa.array(self.rates, pa.int32()),
            pa.array([int(x is not None) for x in self.signals], pa.int32()),
            pa.array(self.errors, pa.string()),
        ]

    def analysed(
        self, cfg: SignalConfig, wanted: frozenset[str] = ALL_GROUPS
    ) -> Iterator[tuple[list[int], tuple]]:
        """Features of the good signals, together for all of the same rate, and their rows."""
        good = [i for i, x in enumerate(self.signals) if x is not None]
        for rate in sorted({self.rates[i] for i in good}):
            at = [i for i in good if self.rates[i] == rate]
            yield at, analyse([self.signals[i] for i in at], rate, cfg, wanted)


def _chunks(batch: pa.RecordBatch, cfg: SignalConfig) -> Iterator[tuple[pa.RecordBatch, _Chunk]]:
    """Consecutive rows of a batch, as many as have a bounded number of samples together.

    Decoded samples take more memory than the bytes that Arrow batches are bounded by.
    """
    start, chunk = 0, _Chunk()
    for i, read in enumerate(_signals(batch)):
        chunk.add(read, cfg)
        if chunk.samples >= cfg.chunk_samples:
            yield batch.slice(start, i + 1 - start), chunk
            start, chunk = i + 1, _Chunk()
    if chunk.signals:
        yield batch.slice(start), chunk


def _kept(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[name] for name in keys]


def _input(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the columns the task needs: the keys and one form of the signal."""
    for form in (["samples", "sr"], ["content"]):
        if set(form) <= set(df.columns):
            return df.select(*keys, *[name for name in form if name not in keys])
    raise ValueError("need samples and sr, or content")


def extract_features(
    df: DataFrame, *keys: str, config: SignalConfig = SignalConfig()
) -> DataFrame:
    """Compact features: 209 columns per signal, with zeros and ``ok = 0`` after a failure."""
    kept = _kept(df, keys)
    features = compact_schema().fields[:-1]
    schema = T.StructType([*kept, *features, *_STATUS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, chunk in _chunks(batch, config):
                table = np.zeros((rows.num_rows, len(features)))
                for at, (matrix, counts, tempo) in chunk.analysed(config):
                    stats = summaries(matrix, counts).reshape(len(at), -1)
                    table[at] = np.insert(stats, _TEMPO_AT, tempo, axis=1)
                columns = [rows.column(field.name) for field in kept]
                columns += [pa.array(column) for column in np.ascontiguousarray(table.T)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *chunk.status()], names=schema.names
                )

    return _map(_input(df, keys), run, schema)


def extract_upload(
    df: DataFrame,
    *keys: str,
    path: str = "path",
    users: int = 100,
    uploaded_at: Column | None = None,
    config: SignalConfig = SignalConfig(),
) -> DataFrame:
    """Compact features with file name, duration, user and upload date as native columns.

    Rows of failed files have no name and date, no user but 0, and duration 0.
    """
    extracted = extract_features(df, *keys, config=config)
    return upload_columns(extracted, path, users, uploaded_at)


def upload_columns(
    extracted: DataFrame, path: str = "path", users: int = 100, uploaded_at: Column | None = None
) -> DataFrame:
    """Extracted features in upload form (see :func:`extract_upload`)."""
    date = F.current_timestamp() if uploaded_at is None else uploaded_at
    good = F.col("ok") == 1
    user = stable_bucket(F.col(path), users) + 1
    return extracted.select(
        *[name for name in extracted.columns if name not in ("n_samples", "sr", "ok", "error")],
        F.when(good, basename(F.col(path))).alias("filename"),
        F.when(good, duration_seconds(F.col("n_samples"), F.col("sr")))
        .otherwise(0.0).alias("duration"),
        F.when(good, user).otherwise(0).alias("user_id"),
        F.when(good, iso_date(date)).alias("uploaded_at"),
        "ok",
    )


def extract_series(
    df: DataFrame, *keys: str, config: SignalConfig = SignalConfig()
) -> DataFrame:
    """Array-valued features: one array per series and the tempo; NULLs after a failure."""
    kept = _kept(df, keys)
    schema = T.StructType([*kept, *series_schema().fields, *_STATUS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, chunk in _chunks(batch, config):
                found: list[np.ndarray | None] = [None] * rows.num_rows
                tempi: list[float | None] = [None] * rows.num_rows
                for at, (matrix, counts, tempo) in chunk.analysed(config):
                    parts = np.split(matrix, np.cumsum(counts)[:-1])
                    for i, part, beats in zip(at, parts, tempo):
                        found[i], tempi[i] = part, beats
                lists = [
                    _lists([None if part is None else part[:, j] for part in found])
                    for j in range(len(SERIES))
                ]
                lists.insert(len(SERIES_BEFORE_TEMPO), pa.array(tempi, pa.float64()))
                columns = [rows.column(field.name) for field in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *lists, *chunk.status()], names=schema.names
                )

    return _map(_input(df, keys), run, schema)


def frame_features(
    df: DataFrame,
    *keys: str,
    series: Sequence[str] = tuple(SERIES),
    config: SignalConfig = SignalConfig(),
) -> DataFrame:
    """One row per frame with the chosen series; signals that fail have no frames.

    Only what the chosen series need is computed.
    """
    kept = _kept(df, keys)
    at = [SERIES.index(name) for name in series]
    wanted = groups_of(at)
    numbers = [T.StructField(name, T.DoubleType()) for name in series]
    schema = T.StructType([*kept, T.StructField("frame", T.IntegerType()), *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, chunk in _chunks(batch, config):
                for good, (matrix, counts, _) in chunk.analysed(config, wanted):
                    owner = pa.array(np.repeat(good, counts))
                    first = np.repeat(np.cumsum(counts) - counts, counts)
                    columns = [rows.column(field.name).take(owner) for field in kept]
                    columns.append(pa.array(np.arange(len(matrix)) - first, pa.int32()))
                    columns += [pa.array(np.ascontiguousarray(matrix[:, j])) for j in at]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _map(_input(df, keys), run, schema)


def tempo(df: DataFrame, *keys: str, config: SignalConfig = SignalConfig()) -> DataFrame:
    """Tempo of every good signal, from onset strength alone."""
    kept = _kept(df, keys)
    schema = T.StructType([*kept, T.StructField("tempo", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, chunk in _chunks(batch, config):
                for good, (_, _, beats) in chunk.analysed(config, frozenset(["onset"])):
                    columns = [rows.column(field.name).take(pa.array(good)) for field in kept]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(beats, pa.float64())], names=schema.names
                    )

    return _map(_input(df, keys), run, schema)


def compact_from_series(extracted: DataFrame, *keys: str) -> DataFrame:
    """Compact features from array-valued ones, with Spark's own array functions."""
    stats = extracted.select(
        *keys, "tempo", *[series_stats(F.col(long_name(name))).alias(name) for name in SERIES]
    )

    def named(names: Sequence[str]) -> list[str]:
        return [
            f"{name}.{stat} AS {name}_{stat}"
            for name in names
            for stat in ("mean", "std", "min", "max")
        ]

    return stats.selectExpr(
        *keys, *named(SERIES_BEFORE_TEMPO), "tempo", *named(SERIES_AFTER_TEMPO)
    )
