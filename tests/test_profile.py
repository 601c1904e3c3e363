import math
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from timbrelake.operators import compare, filters, profile
from timbrelake.operators.filters import Selection
from timbrelake.plans import views
from timbrelake.plans.jobs import facets, overview

FIELDS = [
    "tempo", "centroid_mean", "rms_mean", "zcr_mean", "flatness_mean", "mfcc_1_mean",
    "mfcc_2_mean", "mfcc_3_mean", "mfcc_4_mean", "mfcc_5_mean",
]


def _features(spark, groups):
    """Rows with every profile column; ``groups`` lists (genre, value) pairs."""
    data = [(genre, *[float(value)] * len(FIELDS)) for genre, value in groups]
    return spark.createDataFrame(data, ["genres", *FIELDS])


def test_tempo_buckets_at_their_edges(spark):
    values = [None, math.nan, 79.9, 80.0, 99.9, 100.0, 110.0, 120.0, 130.0, 140.0, 160.0, 300.0]
    frame = spark.createDataFrame([(v,) for v in values], "tempo DOUBLE")
    found = {r["bucket"]: r["count"] for r in profile.bucket_histogram(frame).collect()}
    assert found == {
        "< 80": 1, "80-100": 2, "100-110": 1, "110-120": 1, "120-130": 1, "130-140": 1,
        "140-160": 1, "160+": 4,
    }
    last = profile.bucket_histogram(frame).collect()[-1]
    assert (last["bucket"], last["cumul"], last["cumul_pct"]) == ("160+", 12, 100.0)
    own = frame.select(profile.tempo_bucket(F.col("tempo"), "unknown").alias("b"))
    assert own.filter("b = 'unknown'").count() == 2


def test_ties_at_the_cut_go_by_name(spark):
    data = [(f"g{i:02d}",) for i in range(20) for _ in range(3 if i < 5 else 2)]
    frame = spark.createDataFrame(data, "genres STRING").repartition(5)
    ranked = profile.genre_ranking(frame).orderBy("rank", "genres").collect()
    assert [r["genres"] for r in ranked] == [f"g{i:02d}" for i in range(12)]
    assert [r["rank"] for r in ranked] == [1] * 5 + [6] * 7


def test_pareto_reaches_100_without_cut(spark):
    data = [(f"g{i}",) for i in range(6) for _ in range(i + 1)]
    pareto = profile.genre_pareto(spark.createDataFrame(data, "genres STRING")).collect()
    assert pareto[-1]["cumul_pct"] == 100.0
    assert [r["count"] for r in pareto] == [6, 5, 4, 3, 2, 1]


@pytest.mark.parametrize("groups", [[("a", 1), ("b", 1)], [("a", 5)]])
def test_zscore_without_spread_is_zero(spark, groups):
    scored = profile.group_zscore(profile.group_profile(_features(spark, groups)))
    assert {(r["z_centroid"], r["z_rms"]) for r in scored.collect()} == {(0.0, 0.0)}


def test_kpi_of_nothing_is_zero(spark):
    empty = _features(spark, [("a", 1)]).filter("false")
    assert rows(profile.kpi_summary(empty)) == [(0, 0.0, 0)]


def test_kpi_with_and_without_duration(spark):
    frame = _features(spark, [("a", 1), ("a", 2), ("b", 3)])
    assert profile.kpi_summary(frame).columns == ["total", "tempo_mean", "n_genres"]
    timed = frame.withColumn("duration", F.lit(None).cast("double"))
    assert rows(profile.kpi_summary(timed)) == [(3, 2.0, 2, 0.0)]


@pytest.mark.parametrize("kind", ["spread", "hot", "null", "two values", "walls", "nan"])
@pytest.mark.parametrize("accuracy", [20, 500])
def test_exact_percentiles(spark, kind, accuracy):
    draw = random.Random(7)
    values = {
        "spread": [draw.gauss(0, 10) for _ in range(6000)],
        "hot": [3.0 if i % 3 else draw.random() * 6 for i in range(6000)],
        "null": [None if i % 2 else float(i) for i in range(6000)],
        "two values": [float(i % 2) for i in range(6000)],
        # Two frequent values with many rare ones between them.
        "walls": [1.0] * 2700 + [1 + draw.random() for _ in range(600)] + [2.0] * 2700,
        "nan": [math.nan if i % 4 == 0 else float(i % 7) for i in range(6000)],
    }[kind]
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(6)
    points = [0.1, 0.5, 0.9, 1.0]
    found, _ = profile.exact_percentiles(frame, ["x"], points, accuracy=accuracy)
    known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    for p in points:
        expected = known[max(1, math.ceil(round(p * len(known), 6))) - 1]
        assert found["x", p] == expected or math.isnan(expected) and math.isnan(found["x", p])


def test_exact_percentiles_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "x DOUBLE")
    assert profile.exact_percentiles(frame, ["x"], [0.5])[0] == {("x", 0.5): None}


def test_sketched_stats_are_close(spark, root):
    frame = views.tracks(spark, root)
    sketched = profile.feature_stats(frame).first().asDict()
    exact = profile.feature_stats(frame, exact=True).first().asDict()
    assert list(sketched) == list(exact)
    for name, value in exact.items():
        assert sketched[name] == pytest.approx(value, rel=0.02, abs=1e-3)


def test_class_balance_skips_one_sided_tags(spark):
    data = [(["a", "b"],)] * 3 + [(["a"],)] * 2
    frame = spark.createDataFrame(data, "genres ARRAY<STRING>")
    assert rows(profile.class_balance(frame, at_least=1)) == [("b", 3, 2)]


def test_selection(spark):
    frame = spark.createDataFrame(
        [("a", 1, "2024-01-01", 10.0), ("b", 2, "2024-02-01", None)],
        "genres STRING, user_id INT, uploaded_at STRING, duration DOUBLE",
    )
    assert filters.select_rows(frame, Selection()) is frame
    chosen = Selection(users=[1, 2], date_to="2024-01-31")
    assert chosen.active == ["users", "date_to"]
    assert [r["genres"] for r in filters.select_rows(frame, chosen).collect()] == ["a"]
    bounded = Selection(duration=(0, 900))
    assert filters.select_rows(frame, bounded).count() == 1
    assert filters.select_rows(frame.drop("duration"), bounded).count() == 2


def test_normalise_genre_drops_empty(spark):
    frame = spark.createDataFrame(
        [(1, None), (2, []), (3, ["a"]), (4, ["a", "a", "b"])], "id INT, genres ARRAY<STRING>"
    )
    found = filters.normalise_genre(frame).collect()
    assert [(r["id"], r["genres"]) for r in found] == [(3, "a"), (4, "a"), (4, "a"), (4, "b")]
    assert filters.with_tags(frame).count() == 2


def test_overview_equals_single_operators(spark, root):
    frame = views.tracks(spark, root)
    chosen = Selection(date_from="1995-01-01", duration=(5, 45))
    tables = overview(frame, chosen)
    kept = filters.select_rows(frame, chosen)
    largest = profile.group_profile(kept)
    expected = {
        "kpi": profile.kpi_summary(kept),
        "genres": profile.genre_pareto(kept),
        "tempo_buckets": profile.bucket_histogram(kept),
        "stats": profile.group_zscore(largest),
        "zcr_flatness": profile.noise_score(kept),
        "feature_stats": profile.feature_stats(kept),
        "summary": profile.summary_table(profile.group_zscore(largest)),
    }
    assert set(tables) == set(expected)
    for name, frame in expected.items():
        assert tables[name].columns == frame.columns, name
        assert rows(tables[name]) == rows(frame), name


def test_facets_of_the_columns_there_are(spark):
    frame = spark.createDataFrame(
        [("b", 2, "2024-02-01"), ("a", None, "2024-01-01"), (None, 2, None)],
        "genres STRING, user_id INT, uploaded_at STRING",
    )
    tables = facets(frame)
    assert [r[0] for r in tables["genres"].collect()] == ["a", "b"]
    assert [r[0] for r in tables["user_id"].collect()] == [2]
    assert rows(tables["uploaded_at"]) == [("2024-01-01", "2024-02-01")]
    assert set(facets(frame.select("genres"))) == {"genres"}


def test_comparison_falls_back_only_for_null(spark):
    stats = spark.createDataFrame(
        [(0.0, None, -1.0, 0.0, None, None)],
        ", ".join(f"tempo__{s} DOUBLE" for s in ("mean", "std", "min", "max", "p10", "p90")),
    )
    track = spark.createDataFrame([(1, 5.0), (2, None)], "id INT, tempo DOUBLE")
    found = compare.track_vs_dataset(track, stats, "id", features=["tempo"]).collect()
    for row in found:
        assert (row["ds_max"], row["ds_p10"], row["ds_p90"]) == (0.0, -1.0, 0.0)
        assert (row["delta_pct"], row["flag"]) == (0.0, "green")
    assert [r["value"] for r in found] == [5.0, 0.0]


def test_comparison_flags(spark):
    names = ("mean", "std", "min", "max", "p10", "p90")
    stats = spark.createDataFrame(
        [(100.0, 1.0, 0.0, 200.0, 5.0, 150.0)], ", ".join(f"tempo__{s} DOUBLE" for s in names)
    )
    tracks = spark.createDataFrame([(v,) for v in (100.0, 110.0, 111.0, 69.0)], "tempo DOUBLE")
    found = compare.track_vs_dataset(tracks, stats, features=["tempo"])
    flags = {r["value"]: r["flag"] for r in found.collect()}
    assert flags == {100.0: "green", 110.0: "green", 111.0: "yellow", 69.0: "red"}


def test_schema_contract(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a INT, b STRING")
    report = rows(filters.schema_contract(frame, ["a", "c"]))
    assert report == [("a", "present", 2), ("b", "extra", 1), ("c", "missing", 0)]
