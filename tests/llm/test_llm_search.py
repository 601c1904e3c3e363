import math

import numpy as np

from timbrelake.llm import topk_search as ts


def brute(rows, every=20, k=20):
    fine = [(i, d, [math.floor(64 * x) for x in v]) for i, (d, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, d, q in fine:
        if d is not None and d % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), e is None, e or 0, e) for j, e, v in fine if j != i)
            out += [(d, r, e, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, _, _, e) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def check(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS uid", "1 AS v")
    assert sorted(map(tuple, ts.top_k(frame, **sizes).collect()), key=str) == brute(rows)


def test_shards_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=8).round(1).tolist()) for i in rng.permutation(700)]
    rows[100:300] = [(d, rows[0][1]) for d, _ in rows[100:300]]  # one vector many times
    check(spark, rows, shard=150, block=9)
    check(spark, rows)


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [0.5, -0.25]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (40, None), (60, [None, 1.0]), (80, [inf, 0.0]), (1, [nan, 0.0]),
        (None, [0.1, 0.1]), (2, [0.0, 0.0]), (-20, [-0.01, 0.01]), (3, [0.1]), (5, []),
    ]
    check(spark, rows)
    check(spark, [(0, [1.0])])
    check(spark, [(20, [1e9, -1e9]), (1, [1e9, 1e9]), (2, [-3e8, 7e8])])
    assert ts.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_fewer_steps_find_the_same():
    rng = np.random.default_rng(8)
    v = np.floor(rng.normal(size=(3000, 16)) * 9)
    ids = rng.permutation(3000)
    best = ts.maxscore(v[:40], ids[:40], v, ids, ids, 7)
    for i in range(40):
        s = v @ v[i]
        want = [j for j in np.lexsort((ids, -s)) if j != i][:7]
        assert best.row[best.query == i].tolist() == want
