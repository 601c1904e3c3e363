import datetime as dt
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from timbrelake.functions import keys
from timbrelake.functions.arrays import name_positions, series_stats, top_entries
from timbrelake.operators import catalogue, joins, ordering


def test_numeric_key_gives_null_instead_of_failing(spark):
    frame = spark.createDataFrame(
        [("wav/12.low.wav",), ("track_0000042",), ("x",), ("/a/007.low.wav",), (None,)],
        "path STRING",
    )
    found = frame.select(
        keys.numeric_key(F.col("path"), r"([^/]+)\.low\.wav$"),
        keys.numeric_key(F.col("path"), r"track_0*([0-9]+)$"),
    )
    assert [tuple(r) for r in found.collect()] == [
        (12, None), (None, 42), (None, None), (7, None), (None, None),
    ]


def test_tags(spark):
    frame = spark.createDataFrame(
        [(["mood---x", "genre---b", "genre---a", "genre---b"],), ([],), (None,)],
        "tags ARRAY<STRING>",
    )
    tags = F.col("tags")
    found = frame.select(keys.first_genre(tags), keys.genre_tags(tags), keys.genre_set(tags))
    assert [tuple(r) for r in found.collect()] == [
        ("b", ["b", "a", "b"], ["b", "a"]), (None, [], []), (None, None, None),
    ]


def test_paths(spark):
    frame = spark.createDataFrame(
        [("audio/mp3/a/b.c.mp3",), ("other/x",), ("a.b/.hidden",), ("gs://bucket/dir/k.wav",),
         ("file:///tmp/x.wav",), ("file:/tmp/x.wav",)],
        "p STRING",
    )
    p = F.col("p")
    found = frame.select(
        keys.swap_suffix(p, ".wav"), keys.swap_prefix(p, "audio/mp3", "audio/wav"),
        keys.basename(p), keys.strip_scheme(p), keys.split_uri(p)["bucket"],
        keys.split_uri(p)["key"],
    ).collect()
    assert found[0][:3] == ("audio/mp3/a/b.c.wav", "audio/wav/a/b.c.mp3", "b.c.mp3")
    assert found[1][:2] == ("other/x.wav", "audio/wav/other/x")
    assert found[2][0] == "a.b/.hidden.wav"
    assert found[3][4:] == ("bucket", "dir/k.wav")
    assert found[4][3] == found[5][3] == "/tmp/x.wav"


def test_dates(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES ('2024-03-05T10:00:00'), ('2024-03-05'), (NULL) AS t(v)"
    )
    today = dt.date(2020, 1, 1)
    found = frame.select(keys.coerce_date(F.col("v"), today)).collect()
    assert [r[0] for r in found] == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), today]
    stamps = spark.sql("SELECT timestamp_ntz'2024-03-05 23:59:59' AS v")
    assert stamps.select(keys.coerce_date(F.col("v"))).first()[0] == dt.date(2024, 3, 5)


def test_buckets_do_not_depend_on_partitioning(spark):
    frame = spark.range(2000).withColumn("u", keys.assign_user(F.col("id")))
    assert rows(frame) == rows(spark.range(2000).repartition(9).withColumn(
        "u", keys.assign_user(F.col("id"))))
    assert {r["u"] for r in frame.select("u").distinct().collect()} == set(range(6))


def test_global_index_is_the_sorted_position(spark):
    frame = spark.range(5000).select(
        F.concat(F.lit("p"), F.md5(F.col("id").cast("string"))).alias("path")
    ).repartition(6)
    indexed, total = ordering.global_index(frame, "path")
    expected = sorted(r["path"] for r in frame.collect())
    assert total == 5000
    assert [r["path"] for r in indexed.orderBy("row_index").collect()] == expected
    assert {r["row_index"] for r in indexed.collect()} == set(range(5000))


def test_global_index_splits_a_frequent_leading_value(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(4000).withColumn("k", F.when(F.col("id") % 2 == 0, 0)
                                             .otherwise(F.col("id")))
        indexed, _ = ordering.global_index(frame, "k", "id")
        sizes = Counter(r[0] for r in indexed.select(F.spark_partition_id()).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes.values()) < 2000
    place = {r["id"]: r["row_index"] for r in indexed.collect()}
    assert [i for i, _ in sorted(place.items(), key=lambda e: e[1])][:3] == [0, 2, 4]


def test_global_index_of_nothing(spark):
    indexed, total = ordering.global_index(spark.range(0), "id")
    assert (indexed.count(), total) == (0, 0)


def test_batches_are_full_but_the_last(spark):
    batched = ordering.assign_batches(spark.range(1050), "id", size=200, first=7)
    sizes = {r["batch_id"]: r["count"] for r in batched.groupBy("batch_id").count().collect()}
    assert sizes == {7: 200, 8: 200, 9: 200, 10: 200, 11: 200, 12: 50}


def test_shards_partition_the_input(spark):
    frame = spark.range(103)
    shards = [
        {r["id"] for r in ordering.shard_slice(frame, "id", shard=i, shards=4).collect()}
        for i in range(4)
    ]
    assert shards == [set(range(i, 103, 4)) for i in range(4)]


def test_cap_keeps_the_first_rows_of_a_dominant_class(spark):
    frame = spark.range(6000).withColumn(
        "label", F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5))
    )
    kept = catalogue.cap_per_class(frame, "label", "id", cap=40)
    assert kept.columns == frame.columns
    expected, seen = [], Counter()
    for row in frame.orderBy("id").collect():
        if seen[row["label"]] < 40:
            seen[row["label"]] += 1
            expected.append(tuple(row))
    assert rows(kept) == rows(spark.createDataFrame(expected, frame.schema))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 3 and "Window" not in plan


def test_pending_and_done_make_the_catalogue(spark):
    names = spark.range(100).select(F.col("id").cast("string").alias("name"))
    done = names.filter(F.col("name").cast("int") % 3 == 0)
    left = joins.pending(names, done, "name")
    assert rows(left.union(done)) == rows(names)
    assert rows(joins.listed(names, done, "name")) == rows(done)


def test_enrich_drops_unmatched(spark):
    features = spark.createDataFrame(
        [("d/1.low.wav", 1.0), ("d/2.low.wav", 2.0), ("d/x.wav", 3.0)], "path STRING, f DOUBLE"
    )
    metadata = spark.createDataFrame(
        [("track_0000001", "p1", "genre---rock\tgenre---pop"), ("other", "p2", "genre---x")],
        "TRACK_ID STRING, PATH STRING, TAGS STRING",
    )
    joined = joins.enrich(joins.keyed_features(features), joins.keyed_metadata(metadata))
    assert rows(joined) == [
        (1, "d/1.low.wav", 1.0, "track_0000001", "p1", ["rock", "pop"])
    ]


def test_a_frequent_key_is_split_by_adaptive_execution(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(0, 60000, 1, 6)
        hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).cast("int")
        features = many.select(hot.alias("track_num"), F.md5(F.col("id").cast("string")))
        metadata = spark.range(1000).select(F.col("id").cast("int").alias("track_num"))
        joined = joins.enrich(features, metadata)
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_checksums(spark):
    files = spark.createDataFrame(
        [("a", bytearray(b"1")), ("b", bytearray(b"2")), ("c", bytearray(b"3"))],
        "name STRING, content BINARY",
    )
    good = "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"
    manifest = spark.createDataFrame([("a", good), ("b", good)], "name STRING, sha256 STRING")
    assert rows(joins.checksum_report(files, manifest).select("name", "matches")) == [
        ("a", True), ("b", False),
    ]
    assert rows(joins.checksum_mismatches(files, manifest).select("name")) == [("b",)]


def test_wanted_rows_count_once(spark):
    frame = spark.createDataFrame(
        [(["genre---rock", "genre---rock", "genre---folk"],), (["genre---pop"],)],
        "tags ARRAY<STRING>",
    )
    assert rows(catalogue.wanted_repartition(frame)) == [("folk", 1, 1), ("rock", 1, 1)]
    assert rows(catalogue.top_tags(frame)) == [("folk", 1), ("pop", 1), ("rock", 2)]


def test_array_functions(spark):
    frame = spark.createDataFrame(
        [([1.0, 2.0, 3.0, 4.0],), ([],), (None,), ([5.0],)], "v ARRAY<DOUBLE>"
    )
    found = [tuple(r[0]) for r in frame.select(series_stats(F.col("v"))).collect()]
    assert found[0] == (2.5, 1.25**0.5, 1.0, 4.0)
    assert found[1:] == [(0.0,) * 4, (0.0,) * 4, (5.0, 0.0, 5.0, 5.0)]
    tied = spark.createDataFrame([([0.2, 0.5, 0.5, 0.1],)], "v ARRAY<DOUBLE>")
    best = tied.select(top_entries(F.col("v"), 3)).first()[0]
    assert [tuple(e) for e in best] == [(1, 0.5), (2, 0.5), (0, 0.2)]
    named = frame.select(name_positions(F.col("v"), ["x", "y"])).collect()
    assert [tuple(e) for e in named[3][0]] == [(1, "x", 5.0), (2, "y", 0.0)]


def test_date_range_reaches_the_scan(spark, root):
    from timbrelake.plans import filter_queries  # noqa: F401  (registers the query)
    from timbrelake.plans.registry import QUERIES

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES["filter_date_range"](spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(uploaded_at,1996-03-01)" in plan and "LessThanOrEqual(uploaded_at,1996-05-31)" in plan


@pytest.mark.parametrize("cap, held", [(5000, 1 << 16), (5000, 100), (3, 64), (1, 1 << 16), (10**6, 50)])
def test_cap_of_any_size_with_one_class_of_nine_tenths(spark, monkeypatch, cap, held):
    monkeypatch.setattr(catalogue, "_HELD", held)
    frame = spark.range(0, 20_000, 1, 7).select(
        F.when(F.col("id") % 10 != 0, "big").when(F.col("id") % 20 == 0, None).otherwise((F.col("id") % 37).cast("string")).alias("label"),
        F.md5(F.col("id").cast("string")).alias("k0"), F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, F.col("id") * 1.0).alias("x"), "id",
    )
    place = F.row_number().over(W.partitionBy("label").orderBy("x", "k0"))
    want = rows(frame.withColumn("p", place).filter(F.col("p") <= cap).select("id"))
    got = catalogue.cap_per_class(frame, "label", "x", "k0", cap=cap)
    assert got.columns == frame.columns and rows(got.select("id")) == want


def test_cap_of_many_classes_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "_HELD", 64)
    frame = spark.range(0, 3000, 1, 3).select((F.col("id") % 1500).alias("label"), "id")
    assert rows(catalogue.cap_per_class(frame, "label", "id", cap=1).select("id")) == rows(spark.range(1500))
    assert catalogue.cap_per_class(frame.limit(0), "label", "id", cap=1).count() == 0
