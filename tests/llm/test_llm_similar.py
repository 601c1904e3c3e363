import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from timbrelake.llm import near_dedup, similar


def sets(text):
    words = plain.lowered(text).split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def edited(pick, words, share):
    """A copy with some words changed until its similarity falls to about ``share``."""
    out = list(words)
    while True:
        before = list(out)
        out[pick.randrange(len(out))] = f"e{pick.random()}"
        a, b = sets(" ".join(words)), sets(" ".join(out))
        if len(a & b) / len(a | b) < share:
            return " ".join(before)


def test_stage_matches_brute_force_on_edited_copies(spark):
    pick, texts = random.Random(5), []
    for k in range(40):
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.choice([60, 200, 600]))]
        texts.append(" ".join(words))
        texts += [edited(pick, words, share) for share in (0.8, 0.85, 0.9, 0.95, 0.7)]
    sim = [sets(t) for t in texts]
    roots = plain.components(sim, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    got = cp.dedup_documents(spark, plain.documents(spark, texts, list(range(len(texts)))), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(roots)) and len(set(roots)) < 90


def grouped(spark, texts):
    """Doc_ids that the stage keeps, and those that brute force keeps."""
    sim = [sets(t) for t in texts]
    roots = plain.components(sim, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    rows = plain.documents(spark, texts, list(range(len(texts))))
    for c in ("_uid", "uid", "node", "part", "block", "key", "c1"):
        rows = rows.withColumn(c, rows.score)
    got = cp.dedup_documents(spark, rows, "")
    assert got.columns == rows.columns and {r["_uid"] for r in got.collect()} == {"old"}
    return sorted(r.doc_id for r in got.collect()), sorted(set(roots))


@pytest.mark.parametrize("nodes, rare", [(1_024, 8), (40, 2)])
def test_many_texts_just_below_the_similarity(spark, monkeypatch, nodes, rare):
    """Copies whose pairs lie at 0.6 to 0.8, so that they share bands and few are linked."""
    monkeypatch.setattr(similar, "SLAB_NODES", nodes)
    monkeypatch.setattr(similar, "RARE", rare)
    pick = random.Random(9)
    words = [f"w{pick.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(words)] + [edited(pick, words, pick.choice([0.76, 0.8, 0.84, 0.9])) for _ in range(160)]
    got, want = grouped(spark, texts[1:])
    assert got == want and 10 < len(want) < 160


def test_pairs_of_sets_are_those_of_plain_sets(monkeypatch):
    pick = np.random.default_rng(2)
    made = [np.unique(pick.integers(0, pick.choice([12, 60, 4000]), pick.integers(1, 300))).astype(np.uint64) for _ in range(60)]
    for rare, columns in ((8, 2048), (0, 7), (100, 5)):
        monkeypatch.setattr(similar, "RARE", rare)
        monkeypatch.setattr(similar, "COLUMNS", columns)
        a, b = similar.similar_pairs(made, 0.5)
        found = {(i, j) for i, x in enumerate(made) for j, y in enumerate(made) if i < j and len(set(x) & set(y)) >= 0.5 * len(set(x) | set(y))}
        assert set(zip(a.tolist(), b.tolist())) == found and found


def test_fingerprints_propose_beside_the_bands(spark):
    """Without any band, copies within operator 5's radius are linked, and only if they are similar."""
    pick, texts = random.Random(3), []
    for k in range(12):
        words = [f"w{pick.randrange(3000)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words[:-1], f"e{k}"]), " ".join(words[:200] + [f"x{k}"] + words[200:])]
    rows = near_dedup.identified(plain.documents(spark, texts, list(range(len(texts)))))
    nodes = similar._nodes(rows)
    name = {r.node: r.least.doc_id for r in nodes.collect()}
    found = similar.links(rows, nodes.withColumn("bands", F.array().cast("array<long>"))).collect()
    got = {frozenset((name[r.a], name[r.b])) for r in found}
    fp = [int(x) for x in near_dedup.slice_fingerprints([t.encode() for t in texts])]
    near = plain.components(fp, lambda x, y: (x ^ y).bit_count() <= near_dedup.RADIUS)
    assert len(got) > 5 and all(near[min(p)] == near[max(p)] for p in got)
    alike = [(sets(texts[min(p)]), sets(texts[max(p)])) for p in got]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in alike)
