import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F
from wavs import tone, write_wav

from timbrelake import sources
from timbrelake.functions import dsp
from timbrelake.functions.dsp import SignalConfig
from timbrelake.functions.schema import (
    SERIES,
    compact_names,
    compact_schema,
    series_schema,
    training_columns,
)
from timbrelake.operators import signal
from timbrelake.plans import views
from timbrelake.plans.signal_queries import CONFIG, HOP, N

SIGNAL = "id BIGINT, sr INT, samples ARRAY<DOUBLE>"


def _of(spark, *signals, rate=16000):
    data = [(i, rate, None if x is None else [float(v) for v in x]) for i, x in enumerate(signals)]
    return spark.createDataFrame(data, SIGNAL)


def test_schemas_follow_the_rule():
    names = compact_names()
    assert len(names) == 209 == len(set(names))
    assert names[:4] == ["mfcc_1_mean", "mfcc_1_std", "mfcc_1_min", "mfcc_1_max"]
    assert names[names.index("tempo") - 1] == "contrast_7_max"
    assert names[names.index("tempo") + 1] == "onset_mean"
    assert names[-1] == "zcr_max"
    assert compact_schema().names == [*names, "ok"]
    assert len(series_schema()) == 53 and series_schema()["tempo"].dataType.typeName() == "double"
    assert len(training_columns()) == 215


def test_edge_signals(spark):
    rate = 16000
    impulse = np.zeros(4096)
    impulse[2048] = 1.0
    frame = _of(spark, [], np.zeros(50), np.zeros(4096), tone(1000), impulse, None)
    found = {r["id"]: r for r in signal.extract_features(frame, "id").collect()}
    assert [found[i]["ok"] for i in range(6)] == [0, 0, 1, 1, 1, 0]
    assert found[1]["error"] == "ValueError: only 50 samples"
    for i in (0, 1, 5):
        assert {found[i][name] for name in compact_names()} == {0.0}
    for i in (2, 3, 4):
        assert all(np.isfinite(found[i][name]) for name in compact_names())
    silence = found[2]
    for name in ("centroid_mean", "bandwidth_max", "rms_max", "onset_max", "tempo", "chroma_1_max"):
        assert silence[name] == 0.0
    assert silence["flatness_mean"] == pytest.approx(1.0)
    pure = found[3]
    assert pure["rolloff_mean"] == pytest.approx(1000, abs=60)
    assert pure["zcr_mean"] == pytest.approx(2 * 1000 / rate, rel=0.15)
    # 1000 Hz is closest to the note B.
    means = [pure[f"chroma_{i}_mean"] for i in range(1, 13)]
    assert int(np.argmax(means)) == 11
    assert pure["n_samples"] == 8000 and pure["sr"] == rate


def test_tempo_of_a_steady_beat(spark):
    rate, period = 16000, 8000
    x = np.zeros(rate * 8)
    for start in range(0, len(x), period):
        x[start : start + 400] = np.hanning(400)
    found = signal.extract_features(_of(spark, x), "id").first()
    assert found["tempo"] == pytest.approx(120, rel=0.05)


def test_spectrum_keeps_the_energy(spark, root):
    frames = signal.frame_signal(views.signals(spark, root), "vec_id", N, HOP)
    windowed = F.transform(
        "samples", lambda x, t: x * (0.5 - 0.5 * F.cos(2 * np.pi * t / F.lit(N)))
    )
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    times = {
        (r["vec_id"], r["frame"]): r["e"]
        for r in frames.select("vec_id", "frame", total(windowed).alias("e")).collect()
    }
    weighted = F.transform(
        "magnitude", lambda s, k: s * F.when((k == 0) | (k == N // 2), 1.0).otherwise(2**0.5)
    )
    spectra = signal.spectrum(frames, N).select("vec_id", "frame", total(weighted).alias("e"))
    for row in spectra.collect():
        assert row["e"] / N == pytest.approx(times[row["vec_id"], row["frame"]], abs=1e-9)


def test_relational_form_gives_the_same_series(spark, root):
    """Centroid, bandwidth, roll-off and flatness by explode, window and group."""
    signals = views.signals(spark, root)
    frames = signal.frame_signal(signals, "vec_id", N, HOP)
    bins = signal.spectrum(frames, N).select(
        "vec_id", "frame", "sr", F.posexplode("magnitude").alias("k", "s")
    ).withColumn("f", F.col("k") * F.col("sr") / N)
    key = ["vec_id", "frame"]
    power = F.greatest(F.col("s") * F.col("s"), F.lit(1e-10))
    centroid = bins.groupBy(*key).agg((F.sum(F.col("f") * F.col("s")) / F.sum("s")).alias("c"))
    joined = bins.join(centroid, key)
    from pyspark.sql import Window as W

    reached = F.sum("s").over(W.partitionBy(*key).orderBy("k")) >= 0.85 * F.sum("s").over(
        W.partitionBy(*key)
    )
    relational = joined.withColumn("reached", reached).groupBy(*key).agg(
        F.first("c").alias("centroid"),
        F.sqrt(F.sum(F.col("s") * (F.col("f") - F.col("c")) ** 2) / F.sum("s")).alias("bandwidth"),
        F.min(F.when(F.col("reached"), F.col("f"))).alias("rolloff"),
        (F.exp(F.avg(F.log(power))) / F.avg(power)).alias("flatness"),
    )
    names = ["centroid", "bandwidth", "rolloff", "flatness"]
    found = signal.frame_features(signals, "vec_id", series=names, config=CONFIG)
    gaps = found.join(relational.withColumnsRenamed({n: f"r_{n}" for n in names}), key).agg(
        F.count("*"), *[F.max(F.abs(F.col(n) - F.col(f"r_{n}"))) for n in names]
    ).first()
    assert gaps[0] == found.count() == relational.count()
    assert max(gaps[1:]) < 1e-6


def test_blocks_of_frames_change_nothing():
    draw = np.random.default_rng(3)
    signals = [draw.normal(size=n) for n in (30000, 1500, 700, 0, 12000)]
    for center in (True, False):
        whole, counts, tempo = dsp.analyse(signals, 16000, SignalConfig(center=center))
        small = SignalConfig(center=center, block_values=5 * 2048)
        parts, same_counts, same_tempo = dsp.analyse(signals, 16000, small)
        assert whole.shape == parts.shape == (counts.sum(), len(SERIES))
        assert np.allclose(whole, parts, atol=1e-9) and list(tempo) == list(same_tempo)
        alone = [dsp.analyse([x], 16000, small) for x in signals]
        assert list(counts) == list(same_counts) == [int(a[1][0]) for a in alone]
        assert np.allclose(whole, np.vstack([a[0] for a in alone]), atol=1e-9)
        assert list(tempo) == [a[2][0] for a in alone]
        stats = dsp.summaries(whole, counts)
        for i, (matrix, _, _) in enumerate(alone):
            if len(matrix):
                own = [matrix.mean(0), matrix.std(0), matrix.min(0), matrix.max(0)]
                assert np.allclose(stats[i], np.stack(own, axis=1), atol=1e-8)
            else:
                assert not stats[i].any()


def test_chunks_and_mixed_rates_change_nothing(spark):
    draw = np.random.default_rng(4)
    data = [(i, [8000, 16000][i % 2], [float(v) for v in draw.normal(size=3000 + 50 * i)])
            for i in range(12)]
    frame = spark.createDataFrame(data, SIGNAL)
    together = signal.extract_features(frame, "id").orderBy("id").toPandas()
    alone = SignalConfig(chunk_samples=1)
    single = signal.extract_features(frame, "id", config=alone).orderBy("id").toPandas()
    assert np.allclose(together[compact_names()], single[compact_names()], atol=1e-8)
    assert list(together["n_samples"]) == [len(x) for _, _, x in data]


def test_series_and_compact_agree(spark, root):
    signals = views.signals(spark, root)
    compact = signal.extract_features(signals, "vec_id", config=CONFIG)
    series = signal.extract_series(signals, "vec_id", config=CONFIG)
    assert series.columns[1:-4] == series_schema().names
    derived = signal.compact_from_series(series, "vec_id")
    assert derived.columns == ["vec_id", *compact_names()]
    a = compact.select("vec_id", *compact_names()).toPandas().set_index("vec_id").sort_index()
    b = derived.toPandas().set_index("vec_id").sort_index()
    assert np.allclose(a.to_numpy(), b.to_numpy(), atol=1e-8)


def test_failed_series_are_null(spark):
    found = signal.extract_series(_of(spark, np.zeros(10), tone(440)), "id").collect()
    by_id = {r["id"]: r for r in found}
    assert by_id[0]["mfcc_1"] is None and by_id[0]["tempo"] is None and by_id[0]["ok"] == 0
    assert len(by_id[1]["mfcc_1"]) == 1 + 8000 // 512


def test_wav_files(spark, tmp_path):
    left = tone(440)
    write_wav(tmp_path / "mono.wav", left)
    write_wav(tmp_path / "sub" / "stereo.wav", np.column_stack([left, left]))
    write_wav(tmp_path / "eight.wav", left, width=1)
    (tmp_path / "corrupt.wav").write_bytes(b"RIFF nonsense")
    files = sources.list_files(spark, str(tmp_path), content=True)
    decoded = signal.decode_wav(files)
    found = {r["path"].rsplit("/", 1)[1]: r for r in decoded.collect()}
    assert {name: r["ok"] for name, r in found.items()} == {
        "mono.wav": 1, "stereo.wav": 1, "eight.wav": 0, "corrupt.wav": 0,
    }
    assert found["mono.wav"]["samples"] == found["stereo.wav"]["samples"]
    assert np.allclose(found["mono.wav"]["samples"], left, atol=1e-4)

    by_content = signal.extract_features(files, "path").orderBy("path").drop("error")
    named = sources.read_files(spark, [r["path"] for r in files.select("path").collect()])
    by_path = signal.extract_features(named, "path").orderBy("path").drop("error")
    good = decoded.filter("ok = 1").select("path", "sr", "samples")
    by_samples = signal.extract_features(good, "path").orderBy("path").drop("error")
    assert by_content.collect() == by_path.collect()
    assert by_content.filter("ok = 1").collect() == by_samples.collect()


def test_wav_written_to_a_stream(tmp_path):
    """Such a file has no true sizes in its header, and may be cut within a sample."""
    write_wav(tmp_path / "a.wav", tone(440))
    content = bytearray((tmp_path / "a.wav").read_bytes())
    whole, rate = signal.decode_pcm16(bytes(content))
    at = content.index(b"data") + 4
    content[4:8] = content[at : at + 4] = b"\xff" * 4
    streamed, same = signal.decode_pcm16(bytes(content) + b"\x01")
    assert rate == same and np.array_equal(whole, streamed)


def test_files_with_odd_names(spark, tmp_path):
    names = ("a b.wav", "é%20#1.wav", "c+d@e.wav", "[x]{y}*.wav")
    for name in names:
        write_wav(tmp_path / name, tone(440, seconds=0.1))
    listed = [r["path"] for r in sources.list_files(spark, str(tmp_path)).collect()]
    found = signal.extract_features(sources.read_files(spark, listed), "path")
    assert [r["ok"] for r in found.select("ok").collect()] == [1] * len(names)


def test_unreadable_files_fail_the_task(spark, tmp_path):
    write_wav(tmp_path / "a.wav", tone(440, seconds=0.1))
    found = signal.extract_features(sources.read_files(spark, [str(tmp_path / "a.wav")]), "path")
    (tmp_path / "a.wav").unlink()
    with pytest.raises(Exception):
        found.collect()


def test_samples_that_are_no_numbers(spark):
    signals = [(1, [0.1] * 4000, 16000), (2, [0.1] * 3999 + [None], 16000), (3, [float("nan")] * 4000, 16000)]
    frame = spark.createDataFrame(signals, "k int, samples array<double>, sr int")
    got = {r["k"]: (r["ok"], r["error"]) for r in signal.extract_features(frame, "k").collect()}
    assert got[1] == (1, None) and got[2][0] == got[3][0] == 0 and "finite" in got[2][1]


def test_upload_columns(spark, tmp_path):
    write_wav(tmp_path / "7.low.wav", tone(440, seconds=0.25))
    (tmp_path / "8.low.wav").write_bytes(b"x")
    paths = sources.list_files(spark, str(tmp_path), content=True)
    stamp = F.lit("2024-05-06 07:08:09").cast("timestamp")
    found = signal.extract_upload(paths, "path", uploaded_at=stamp)
    assert found.columns == [
        "path", *compact_names(), "filename", "duration", "user_id", "uploaded_at", "ok",
    ]
    kept = rows(found.select("filename", "duration", "uploaded_at", "ok"))
    assert kept == [("7.low.wav", 0.25, "2024-05-06", 1), (None, 0.0, None, 0)]
    users = {r["ok"]: r["user_id"] for r in found.collect()}
    assert users[0] == 0 and 1 <= users[1] <= 100


def test_extraction_needs_no_shuffle(spark, root):
    found = signal.extract_features(views.signals(spark, root), "vec_id", config=CONFIG)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_chosen_series_equal_those_of_all():
    rng = np.random.default_rng(4)
    signals = [rng.normal(size=n) for n in (5000, 4096, 9000)]
    cfg = dsp.SignalConfig()
    whole, counts, tempi = dsp.analyse(signals, 16000, cfg)
    for group in sorted(dsp.ALL_GROUPS):
        part, same, beats = dsp.analyse(signals, 16000, cfg, frozenset([group]))
        columns = [i for i in range(whole.shape[1]) if dsp.groups_of([i]) == {group}]
        assert columns and counts.tolist() == same.tolist()
        assert np.allclose(part[:, columns], whole[:, columns], rtol=1e-12)
        assert beats == (tempi if group == "onset" else [0.0] * 3)
