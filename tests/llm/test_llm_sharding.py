import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from timbrelake.llm import sharding


def check(frame, shards):
    out = sharding.shuffle_into_shards(frame, shards)
    rows = out.collect()
    assert out.columns == [c for c in frame.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    places = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r.slot)
    sizes = [len(places.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(p) == list(range(len(p))) for p in places.values())
    key = lambda r: str([r[c] for c in frame.columns if c not in ("shard", "slot")])
    assert sorted(map(key, rows)) == sorted(map(key, frame.collect()))
    return rows


def test_whole_table(docs):
    rows = check(docs, 8)
    ids = np.array([r.doc_id for r in rows])
    place = np.array([r["shard"] * 1000 + r.slot for r in rows])
    assert abs(np.corrcoef(ids, place)[0, 1]) < 0.2


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_edge_cases(spark, shards):
    check(plain.documents(spark).withColumnRenamed("score", "slot"), shards)
    assert sharding.shuffle_into_shards(plain.documents(spark).limit(0), shards).count() == 0


def test_more_partitions_than_the_matrix_takes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MOST_PARTITIONS", 3)
    check(spark.range(0, 100, 1, 9).withColumn("x", F.lit("a")), 7)


def test_matrix_is_hypergeometric():
    rows = [10, 0, 90, 300]
    first = [sharding.communication_matrix(rows, 4, seed)[0, 0] for seed in range(4000)]
    assert np.mean(first) == pytest.approx(2.5, abs=0.1)
    assert np.var(first) == pytest.approx(10 * 0.25 * 0.75 * 390 / 399, rel=0.1)
    m = sharding.communication_matrix(rows, 7, 1)
    assert m.sum(1).tolist() == rows and max(m.sum(0)) - min(m.sum(0)) <= 1
    big = sharding.communication_matrix([3 * 10**9, 2 * 10**9], 8, 1)
    assert big.sum(1).tolist() == [3 * 10**9, 2 * 10**9] and set(big.sum(0).tolist()) == {625_000_000}


def test_size_and_checksum(spark):
    for r in plain.documents(spark).select("text", sharding.text_size(F.col("text")).alias("n"), sharding.text_crc32(F.col("text")).alias("c")).collect():
        data = (r.text or "").encode()
        assert (r.n, r.c) == (len(data) + 1, zlib.crc32(data))
