import numpy as np
import plain

from timbrelake.llm import near_dedup as nd
from timbrelake.llm.components import connected_components


def check(frame, result):
    rows = frame.select("doc_id", "text").collect()
    prints = [plain.fingerprint(r.text) for r in rows]
    roots = plain.components(prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for r, root in zip(rows, roots):
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", str(least.get(root))) for r, p, root in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in result.collect()) == want
    return len(set(roots))


def test_whole_table(spark, docs):
    groups = check(docs, nd.near_duplicates(docs))
    assert nd.keep_one(docs).count() == groups


def test_edge_cases(spark):
    frame = plain.documents(spark)
    groups = check(frame, nd.near_duplicates(frame))
    kept = nd.keep_one(frame)
    assert kept.columns == frame.columns and kept.count() == groups
    assert nd.near_duplicates(frame.limit(0)).count() == 0 == nd.keep_one(frame.limit(0)).count()


def test_bit_sliced_runs_find_all_components():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64) for _ in range(12)]
    fps = np.unique(np.concatenate([base] + [base ^ a ^ b for a, b in zip(flips, flips[1:])]))
    keys = np.sort(rng.integers(0, 3, len(fps)))
    order = np.lexsort((fps, keys))
    a, b = nd.run_links(keys[order], fps[order])
    roots = plain.components(
        list(zip(keys[order].tolist(), fps[order].tolist())),
        lambda x, y: x[0] == y[0] and bin(x[1] ^ y[1]).count("1") <= 4,
    )
    want = {(int(fps[order][i]), int(fps[order][r])) for i, r in enumerate(roots) if i != r}
    assert set(zip(a.tolist(), b.tolist())) == want and want


def test_slabs_lose_no_link(spark):
    rng = np.random.default_rng(6)
    fps = np.unique((np.uint64(3) << np.uint64(40)) ^ rng.integers(0, 1 << 9, 300, dtype=np.uint64)).astype(np.int64)
    frame = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    whole = {tuple(r) for r in connected_components(nd.links(frame)).collect()}
    slabs = {tuple(r) for r in connected_components(nd.links(frame, slab=16)).collect()}
    assert whole == slabs and len(whole) == len(fps)


def test_components_of_a_chain_and_nulls(spark):
    edges = [(i, i + 1) for i in range(0, 60, 1)] + [(100, 100), (200, 201), (201, 200), (None, 5)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
