"""Signal features. Embedding vectors are the signals: 64 samples, frames of 16, hop 8."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.constants import N_CHROMA, N_CONTRAST, N_MFCC, N_TONNETZ, STATISTICS
from timbrelake.functions import arrays
from timbrelake.functions.dsp import SignalConfig
from timbrelake.functions.schema import SERIES, compact_names, long_name
from timbrelake.operators import signal
from timbrelake.plans import views
from timbrelake.plans.registry import bucket_sql, query
from timbrelake.session import scratch_path

N, HOP, MELS = 16, 8, 20
#: Tempo limits are scaled to these short signals so that lags 2 to 6 compete.
CONFIG = SignalConfig(
    n_fft=N, hop=HOP, center=False, n_mels=MELS, min_samples=60,
    slowest_bpm=20_000.0, fastest_bpm=60_000.0,
)

# --- SQL parts --------------------------------------------------------------------------------


def r6(expression: str) -> str:
    """Six decimal places by plain arithmetic, the same in both engines."""
    return f"(floor(({expression}) * 1e6 + 0.5) / 1e6)"


def six(*names: str) -> list[str]:
    """The same for Spark as select expressions, which are parsed in one go."""
    return [f"{r6(name)} AS {name}" for name in names]


FRAMES = f"""frames AS (
  SELECT vec_id, CAST(i AS INTEGER) AS frame,
         CAST(embedding[i * {HOP} + 1 : i * {HOP} + {N}] AS DOUBLE[]) AS s
  FROM (SELECT vec_id, embedding, unnest(range(0, (len(embedding) - {N}) // {HOP} + 1)) AS i
        FROM embeddings WHERE len(embedding) >= {N})),
samples AS (SELECT vec_id, frame, t, s[t + 1] AS x
            FROM frames, (SELECT unnest(range(0, {N})) AS t))"""
SPEC = f"""{FRAMES},
windowed AS (SELECT vec_id, frame, t, x * (0.5 - 0.5 * cos(2 * pi() * t / {N})) AS x FROM samples),
spec AS (
  SELECT vec_id, frame, CAST(k AS INTEGER) AS k, k * 16000.0::DOUBLE / {N} AS f,
         sqrt(sum(x * cos(2 * pi() * k * t / {N})) ** 2
              + sum(x * sin(2 * pi() * k * t / {N})) ** 2) AS s
  FROM windowed, (SELECT unnest(range(0, {N // 2 + 1})) AS k)
  GROUP BY vec_id, frame, k)"""
CENTROID = """f_centroid AS (
  SELECT vec_id, frame, CASE WHEN sum(s) > 0 THEN sum(f * s) / sum(s) ELSE 0 END AS centroid
  FROM spec GROUP BY vec_id, frame)"""
BANDWIDTH = """f_bandwidth AS (
  SELECT vec_id, frame, CASE WHEN sum(s) > 0
         THEN sqrt(sum(s * (f - centroid) * (f - centroid)) / sum(s)) ELSE 0 END AS bandwidth
  FROM spec JOIN f_centroid USING (vec_id, frame) GROUP BY vec_id, frame)"""
ROLLOFF = """cumulated AS (
  SELECT vec_id, frame, f, sum(s) OVER (PARTITION BY vec_id, frame ORDER BY k) AS c,
         sum(s) OVER (PARTITION BY vec_id, frame) AS total FROM spec),
f_rolloff AS (SELECT vec_id, frame, min(f) AS rolloff FROM cumulated
              WHERE c >= 0.85 * total GROUP BY vec_id, frame)"""
FLATNESS = """f_flatness AS (
  SELECT vec_id, frame, exp(avg(ln(greatest(s * s, 1e-10)))) / avg(greatest(s * s, 1e-10))
         AS flatness FROM spec GROUP BY vec_id, frame)"""
RMS = "f_rms AS (SELECT vec_id, frame, sqrt(avg(x * x)) AS rms FROM samples GROUP BY vec_id, frame)"
ZCR = f"""signs AS (
  SELECT vec_id, frame, (x >= 0) <> lag(x >= 0) OVER (PARTITION BY vec_id, frame ORDER BY t) AS c
  FROM samples),
f_zcr AS (SELECT vec_id, frame, count(*) FILTER (c) / CAST({N - 1} AS DOUBLE) AS zcr
          FROM signs GROUP BY vec_id, frame)"""
_TOP_MEL = "(15 + 27 * ln(8) / ln(6.4))"
_MFCC = ", ".join(
    f"sum(db * cos(pi() * {k} * (m + 0.5) / {MELS})) * sqrt({1 if k == 0 else 2} / {MELS}.0)"
    f" AS mfcc_{k + 1}"
    for k in range(N_MFCC)
)
MFCC = f"""edges AS (
  SELECT j, CASE WHEN j * {_TOP_MEL} / {MELS + 1} < 15 THEN j * {_TOP_MEL} / {MELS + 1} * 200 / 3
            ELSE 1000 * exp(ln(6.4) / 27 * (j * {_TOP_MEL} / {MELS + 1} - 15)) END AS hz
  FROM (SELECT unnest(range(0, {MELS + 2})) AS j)),
filters AS (
  SELECT a.j AS m, k, greatest(0, least((k * 1000 - a.hz) / (b.hz - a.hz),
         (c.hz - k * 1000) / (c.hz - b.hz))) * 2 / (c.hz - a.hz) AS w
  FROM edges a JOIN edges b ON b.j = a.j + 1 JOIN edges c ON c.j = a.j + 2,
       (SELECT unnest(range(0, {N // 2 + 1})) AS k)),
mel AS (SELECT vec_id, frame, m, 10 * log10(greatest(sum(s * s * w), 1e-10)) AS db
        FROM spec JOIN filters USING (k) GROUP BY vec_id, frame, m),
clipped AS (SELECT vec_id, frame, m, greatest(db, max(db) OVER (PARTITION BY vec_id) - 80) AS db
            FROM mel),
f_mfcc AS (SELECT vec_id, frame, {_MFCC} FROM clipped GROUP BY vec_id, frame)"""
_CHROMA = ", ".join(
    f"coalesce(max(e) FILTER (tone = {c}), 0) AS chroma_{c + 1}" for c in range(N_CHROMA)
)
CHROMA = f"""toned AS (
  SELECT vec_id, frame, s * s AS p,
         CAST(floor(12 * log2(f / 440) + 0.5) + 9 + 1200 AS INTEGER) % 12 AS tone
  FROM spec WHERE k > 0),
folded AS (SELECT vec_id, frame, tone, sum(p) AS e FROM toned GROUP BY vec_id, frame, tone),
scaled AS (SELECT vec_id, frame, tone,
           CASE WHEN max(e) OVER w > 0 THEN e / max(e) OVER w ELSE 0 END AS e
           FROM folded WINDOW w AS (PARTITION BY vec_id, frame)),
f_chroma AS (SELECT vec_id, frame, {_CHROMA} FROM scaled GROUP BY vec_id, frame)"""
_AXIS = ", ".join(
    f"CASE WHEN sum(e) > 0 THEN sum(e * {radius} * {wave}(tone * pi() * {turn})) / sum(e)"
    f" ELSE 0 END AS tonnetz_{i + 1}"
    for i, (wave, turn, radius) in enumerate([
        ("sin", "7 / 6", "1"), ("cos", "7 / 6", "1"), ("sin", "3 / 2", "1"),
        ("cos", "3 / 2", "1"), ("sin", "2 / 3", "0.5"), ("cos", "2 / 3", "0.5"),
    ])
)
TONNETZ = f"f_tonnetz AS (SELECT vec_id, frame, {_AXIS} FROM scaled GROUP BY vec_id, frame)"
_CONTRAST = ", ".join(
    f"coalesce(max(c) FILTER (band = {b}), 0) AS contrast_{b + 1}" for b in range(N_CONTRAST)
)
CONTRAST = f"""banded AS (
  SELECT vec_id, frame, s, CASE WHEN f < 200 THEN 0
         ELSE least(6, CAST(floor(log2(f / 200)) AS INTEGER) + 1) END AS band FROM spec),
placed AS (SELECT *, row_number() OVER (w ORDER BY s) AS low, row_number() OVER (w ORDER BY s DESC)
           AS high, greatest(1, floor(0.02 * count(*) OVER w + 0.5)) AS m
           FROM banded WINDOW w AS (PARTITION BY vec_id, frame, band)),
spread AS (SELECT vec_id, frame, band,
           10 * (log10(greatest(avg(s) FILTER (high <= m), 1e-10))
                 - log10(greatest(avg(s) FILTER (low <= m), 1e-10))) AS c
           FROM placed GROUP BY vec_id, frame, band),
f_contrast AS (SELECT vec_id, frame, {_CONTRAST} FROM spread GROUP BY vec_id, frame)"""
ONSET = """levels AS (
  SELECT vec_id, frame, k, ln(greatest(s, 1e-5)) AS level,
         lag(ln(greatest(s, 1e-5))) OVER (PARTITION BY vec_id, k ORDER BY frame) AS earlier
  FROM spec),
f_onset AS (SELECT vec_id, frame, avg(greatest(0, level - coalesce(earlier, level))) AS onset
            FROM levels GROUP BY vec_id, frame)"""
TEMPO = """lags AS (
  SELECT a.vec_id, b.frame - a.frame AS lag, round(sum(a.onset * b.onset), 9) AS strength
  FROM f_onset a JOIN f_onset b ON a.vec_id = b.vec_id AND b.frame - a.frame BETWEEN 2 AND 6
  GROUP BY ALL),
best AS (SELECT vec_id, strength, lag, row_number() OVER
         (PARTITION BY vec_id ORDER BY strength DESC, lag) AS place FROM lags),
tempo AS (SELECT vec_id, CAST(lag AS INTEGER) AS lag,
          CASE WHEN strength > 0 THEN 60.0 * 16000 / 8 / lag ELSE 0 END AS tempo
          FROM best WHERE place = 1)"""


def _wide(parts: list[str], name: str, columns: list[str]) -> str:
    values = ", ".join(f"{r6(column)} AS {column}" for column in columns)
    return f"WITH {', '.join(parts)} SELECT vec_id, frame, {values} FROM f_{name}"


def _frames(spark, root, *series):
    found = signal.frame_features(
        views.signals(spark, root), "vec_id", series=series, config=CONFIG
    )
    return found.selectExpr("vec_id", "frame", *six(*series))


def _numbered(name: str, n: int) -> list[str]:
    return [f"{name}_{i}" for i in range(1, n + 1)]


# --- framing and spectrum -----------------------------------------------------------------


@query(f"""WITH {FRAMES}
SELECT vec_id, frame, CAST(t AS INTEGER) AS t, x FROM samples""")
def frame_signal(spark, root):
    frames = signal.frame_signal(views.signals(spark, root), "vec_id", N, HOP)
    return frames.select("vec_id", "frame", F.posexplode("samples").alias("t", "x"))


@query(f"WITH {SPEC} SELECT vec_id, frame, k, {r6('s')} AS magnitude FROM spec")
def spectrum(spark, root):
    frames = signal.frame_signal(views.signals(spark, root), "vec_id", N, HOP)
    return signal.spectrum(frames, N).select(
        "vec_id", "frame", F.posexplode("magnitude").alias("k", "magnitude")
    ).selectExpr("vec_id", "frame", "k", *six("magnitude"))


# --- series per frame -----------------------------------------------------------------------


@query(_wide([SPEC, CENTROID], "centroid", ["centroid"]))
def spectral_centroid(spark, root):
    return _frames(spark, root, "centroid")


@query(_wide([SPEC, CENTROID, BANDWIDTH], "bandwidth", ["bandwidth"]))
def spectral_bandwidth(spark, root):
    return _frames(spark, root, "bandwidth")


@query(_wide([SPEC, ROLLOFF], "rolloff", ["rolloff"]))
def spectral_rolloff(spark, root):
    return _frames(spark, root, "rolloff")


@query(_wide([SPEC, FLATNESS], "flatness", ["flatness"]))
def spectral_flatness(spark, root):
    return _frames(spark, root, "flatness")


@query(_wide([FRAMES, RMS], "rms", ["rms"]))
def frame_rms(spark, root):
    return _frames(spark, root, "rms")


@query(_wide([FRAMES, ZCR], "zcr", ["zcr"]))
def frame_zcr(spark, root):
    return _frames(spark, root, "zcr")


@query(_wide([SPEC, MFCC], "mfcc", _numbered("mfcc", N_MFCC)))
def mfcc(spark, root):
    return _frames(spark, root, *_numbered("mfcc", N_MFCC))


@query(_wide([SPEC, CHROMA], "chroma", _numbered("chroma", N_CHROMA)))
def chroma(spark, root):
    return _frames(spark, root, *_numbered("chroma", N_CHROMA))


@query(_wide([SPEC, CONTRAST], "contrast", _numbered("contrast", N_CONTRAST)))
def spectral_contrast(spark, root):
    return _frames(spark, root, *_numbered("contrast", N_CONTRAST))


@query(_wide([SPEC, CHROMA, TONNETZ], "tonnetz", _numbered("tonnetz", N_TONNETZ)))
def tonnetz(spark, root):
    return _frames(spark, root, *_numbered("tonnetz", N_TONNETZ))


@query(_wide([SPEC, ONSET], "onset", ["onset"]))
def onset_strength(spark, root):
    return _frames(spark, root, "onset")


@query(f"WITH {SPEC}, {ONSET}, {TEMPO} SELECT vec_id, {r6('tempo')} AS tempo FROM tempo")
def tempo_autocorr(spark, root):
    found = signal.tempo(views.signals(spark, root), "vec_id", config=CONFIG)
    return found.selectExpr("vec_id", *six("tempo"))


# --- whole signals ------------------------------------------------------------------------------

_ALL = [
    SPEC, CENTROID, BANDWIDTH, ROLLOFF, FLATNESS, RMS, ZCR, MFCC, CHROMA, TONNETZ, CONTRAST,
    ONSET, TEMPO,
]
_FRAME_TABLES = [
    "f_centroid", "f_bandwidth", "f_rolloff", "f_flatness", "f_rms", "f_zcr", "f_mfcc",
    "f_chroma", "f_tonnetz", "f_contrast", "f_onset",
]
_JOINED = "everything AS (SELECT * FROM " + " JOIN ".join(
    [_FRAME_TABLES[0], *[f"{name} USING (vec_id, frame)" for name in _FRAME_TABLES[1:]]]
) + ")"
_STAT_SQL = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}


def _compact_sql(columns: list[str]) -> str:
    picked = []
    for column in columns:
        if column == "tempo":
            picked.append(f"{r6('any_value(tempo)')} AS tempo")
        else:
            series, stat = column.rsplit("_", 1)
            picked.append(f"{r6(f'{_STAT_SQL[stat]}({series})')} AS {column}")
    return f"""WITH {', '.join(_ALL)}, {_JOINED}
SELECT vec_id, {', '.join(picked)} FROM everything JOIN tempo USING (vec_id) GROUP BY vec_id"""


@query(_compact_sql(compact_names()))
def extract_features(spark, root):
    """All 209 feature columns of every signal."""
    found = signal.extract_features(views.signals(spark, root), "vec_id", config=CONFIG)
    return found.selectExpr("vec_id", *six(*compact_names()))


@query(f"""WITH {', '.join(_ALL)}, {_JOINED}
SELECT vec_id, {r6('any_value(tempo)')} AS tempo, {', '.join(
    f"array_to_string(list({r6(name)} ORDER BY frame), '|') AS {long_name(name)}"
    for name in ('rolloff', 'zcr'))},
  {', '.join(f"{r6(f'sum({name} * (frame + 1))')} AS {long_name(name)}"
             for name in SERIES if name not in ('rolloff', 'zcr'))}
FROM everything JOIN tempo USING (vec_id) GROUP BY vec_id""")
def extract_series(spark, root):
    """All array-valued series; most are reduced to a sum weighted by frame number here."""
    found = signal.extract_series(views.signals(spark, root), "vec_id", config=CONFIG)

    def shown(name):
        values = long_name(name)
        if name in ("rolloff", "zcr"):
            return f"array_join(transform({values}, x -> string({r6('x')})), '|') AS {values}"
        weighted = f"transform({values}, (x, i) -> x * (i + 1))"
        return f"{r6(f'aggregate({weighted}, 0D, (acc, x) -> acc + x)')} AS {values}"

    return found.selectExpr("vec_id", *six("tempo"), *[shown(name) for name in SERIES])


_BROKEN = "label IN (1, 2, 4)"


@query(f"""WITH compact AS ({_compact_sql(compact_names())})
SELECT vec_id, CAST(NOT ({_BROKEN}) AS INTEGER) AS ok,
       {', '.join(f"CASE WHEN {_BROKEN} THEN 0 ELSE {name} END AS {name}" for name in compact_names())}
FROM embeddings JOIN compact USING (vec_id)""")
def safe_extract(spark, root):
    """Missing and too short signals, and those with a NULL in them, give a row of zeros."""
    broken = views.table(spark, root, "embeddings").select(
        "vec_id",
        F.lit(16000).alias("sr"),
        F.when(F.col("label") == 1, None)
        .when(F.col("label") == 2, F.concat(F.slice("embedding", 1, 63), F.array(F.lit(None))))
        .when(F.col("label") == 4, F.slice("embedding", 1, 50))
        .otherwise(F.col("embedding")).cast("array<double>").alias("samples"),
    )
    found = signal.extract_features(broken, "vec_id", config=CONFIG)
    return found.selectExpr("vec_id", "ok", *six(*compact_names()))


# --- statistics of arrays -------------------------------------------------------------------


@query(f"""WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, {r6('avg(x)')} AS mean, {r6('stddev_pop(x)')} AS std, {r6('min(x)')} AS min,
       {r6('max(x)')} AS max FROM v GROUP BY vec_id""")
def series_stats(spark, root):
    stats = views.signals(spark, root).select(
        "vec_id", arrays.series_stats(F.col("samples")).alias("s")
    )
    return stats.select("vec_id", "s.*").selectExpr("vec_id", *six(*STATISTICS))


@query(f"""WITH v AS (
  SELECT vec_id, unnest(range(0, 48)) AS i, embedding FROM embeddings),
rows AS (SELECT vec_id, i // 16 AS r, CAST(embedding[i + 1] AS DOUBLE) AS x FROM v),
stats AS (SELECT vec_id, r, avg(x) AS s0, stddev_pop(x) AS s1, min(x) AS s2, max(x) AS s3
          FROM rows GROUP BY vec_id, r)
{' UNION ALL '.join(f'''SELECT vec_id, CAST(r * 4 + {i} AS INTEGER) AS position,
  {r6(f's{i}')} AS value FROM stats''' for i in range(4))}""")
def matrix_row_stats(spark, root):
    """The first three of the four rows of a 4 x 16 matrix."""
    matrix = arrays.reshape(F.col("samples"), 16)
    stats = arrays.matrix_row_stats(matrix, 3)
    return (
        views.signals(spark, root)
        .select("vec_id", F.posexplode(stats).alias("position", "value"))
        .selectExpr("vec_id", "position", *six("value"))
    )


@query("""WITH v AS (
  SELECT vec_id, unnest(range(0, len(embedding))) AS i, embedding FROM embeddings),
e AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) AS place FROM e)
SELECT vec_id, CAST(place AS INTEGER) AS place, CAST(i AS INTEGER) AS position, x AS value
FROM ranked WHERE place <= 3""")
def row_topk(spark, root):
    best = arrays.top_entries(F.col("samples"), 3)
    return views.signals(spark, root).select("vec_id", F.posexplode(best).alias("p", "e")).select(
        "vec_id", (F.col("p") + 1).alias("place"), "e.position", "e.value"
    )


# --- files ----------------------------------------------------------------------------------

_FILES = f"""files AS (
  SELECT vec_id, 'store/set ' || (vec_id % 7) || '/' || vec_id || '.wav' AS path,
         vec_id || '.wav' AS filename, len(embedding) / {views.WAV_RATE}.0::DOUBLE AS duration
  FROM embeddings)"""
# The features of what PCM16 keeps of the vectors.
_QUANTISED = _compact_sql(compact_names()).replace("FROM embeddings WHERE", "FROM quantised WHERE").replace(
    "WITH ", "WITH quantised AS (SELECT vec_id, [floor(x::DOUBLE * 8192) / 32768.0::DOUBLE for x in embedding]"
    " AS embedding FROM embeddings), ", 1,
)
_UPLOADED = f"""SELECT filename, duration, {bucket_sql('path', 100)} + 1 AS user_id,
  '2024-05-06' AS uploaded_at, 1 AS ok, {', '.join(compact_names())}
  FROM files JOIN ({_QUANTISED}) USING (vec_id)"""


@query(f"""WITH samples AS (
  SELECT vec_id, CAST(floor(unnest(embedding)::DOUBLE * 8192) AS BIGINT) AS q,
         generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT 'store/set ' || (vec_id % 7) || '/' || vec_id || '.wav' AS path, {views.WAV_RATE} AS sr,
       count(*) AS n, CAST(sum(q * i) AS BIGINT) AS weighted FROM samples GROUP BY vec_id""")
def wav_ingest(spark, root):
    """PCM16 files decoded into samples, compared by number and a weighted sum."""
    decoded = signal.decode_wav(views.wav_files(spark, root).select("path", "content"))
    whole = "transform(samples, (x, i) -> bigint(round(x * 32768)) * (i + 1))"
    return decoded.filter("ok = 1").selectExpr(
        "path", "sr", "bigint(size(samples)) AS n", f"aggregate({whole}, 0L, (s, x) -> s + x) AS weighted"
    )


def _uploads(spark, root):
    stamp = F.lit("2024-05-06 07:08:09").cast("timestamp")
    files = views.wav_files(spark, root)
    return signal.extract_upload(files, "path", uploaded_at=stamp, config=CONFIG)


@query(f"WITH {_FILES} {_UPLOADED}")
def extract_upload(spark, root):
    """The upload form: file name, duration, user and date beside the features."""
    return _uploads(spark, root).selectExpr("filename", "duration", "user_id", "uploaded_at", "ok", *six(*compact_names()))


@query(f"WITH {_FILES} {_UPLOADED}")
def analyse_and_store(spark, root):
    """Files analysed once, appended to a history without the failed ones, and read back."""
    path = scratch_path(spark, "analysed")
    sinks.append_history(_uploads(spark, root), path)
    stored = sources.read_dataset(spark, path)
    return stored.selectExpr("filename", "duration", "user_id", "uploaded_at", "1 AS ok", *six(*compact_names()))
