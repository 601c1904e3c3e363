import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import plain
import pytest
from pyspark.sql import functions as F

from timbrelake.llm import mixing, queries


def copies(frame, **settings):
    return mixing.copies(frame, mixing.words(F.col("text")), **settings)


def shares(sizes, weights=mixing.WEIGHTS, most=mixing.MOST):
    """Targets in exact numbers, by dealing out again what is above its bound."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, fixed = Fraction(sum(sizes.values())), {}
    while open_ := [s for s in names if s not in fixed]:
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        for s in above:
            fixed[s] = Fraction(most * sizes[s])
            rest -= fixed[s]
    return fixed


def drawn(rows, source, size, target, seed=29):
    """Copies of one source's (row, size) pairs in order."""
    step = min(int(Fraction(target) / size * 2**20 + Fraction(1, 2)), 3 << 20) if size else 0
    key = "" if source is None else "=" + source
    at = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:5], 16)
    out = []
    for _ in rows:
        out.append((at + step >> 20) - (at >> 20))
        at += step
    return out


def check(frame, out):
    docs, got = frame.collect(), out.collect()
    size = {id(d): len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    total = defaultdict(int)
    for d in docs:
        total[d.source] += size[id(d)]
    target = shares(total)
    assert sorted(str(r[: len(docs[0]) if docs else 0]) for r in got) == sorted(str(tuple(d)) for d in docs)
    by = defaultdict(list)
    for r in got:
        assert (r.source_size, r.target) == (total[r.source], pytest.approx(float(target[r.source])))
        by[r.source].append((r.size, r.copies))
    for source, rows in by.items():
        rows.sort(key=lambda r: -r[0])
        taken = sum(n * c for n, c in rows)
        assert abs(taken - target[source]) <= 2 * rows[0][0] + 1 and max(c for _, c in rows) <= 3
        want = drawn(rows, source, total[source], target[source])
        assert sum(want) == sum(c for _, c in rows) and taken == pytest.approx(sum(n * c for (n, _), c in zip(rows, want)), abs=2 * rows[0][0])
    return got


def test_whole_table_and_reruns(spark, docs):
    frame = docs.select("doc_id", "source", "text")
    first = check(frame, copies(frame))
    again = copies(frame.repartition(7, "doc_id")).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_exact_copies_in_order(spark):
    rows = [(i, "a b c " * (1 + i % 9), f"s{i % 3}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    got = {r.doc_id: r.copies for r in check(frame, copies(frame, order=order))}
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    for s, target in shares(sizes).items():
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (-len(r[1]), hashlib.md5(str(r[0]).encode()).hexdigest()))
        assert [got[r[0]] for r in own] == drawn(own, s, sizes[s], target)


def test_edge_cases(spark):
    frame = plain.documents(spark)
    sources = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") > 9, F.lit("")).otherwise(F.concat(F.lit("ä"), F.col("doc_id") % 2))
    frame = frame.withColumn("source", sources)
    for c in ("uid", "key", "part", "at", "tie", "row", "first", "before", "step", "offset", "place", "weight"):
        frame = frame.withColumn(c, F.lit(c))
    check(frame.select("doc_id", "text", "source", *frame.columns[5:]), copies(frame.select("doc_id", "text", "source", *frame.columns[5:])))
    assert copies(frame.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.copies for r in check(blank, copies(blank))] == [0, 0]


def test_new_names_replace_old_ones_and_a_hot_group_is_spread(spark):
    frame = spark.range(0, 3000, 1, 6).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"), F.lit("x").alias("source"), F.lit("old").alias("size"))
    rows = copies(frame).collect()
    assert {(r["size"], r.copies) for r in rows} == {(2, 1)} and len(rows) == 3000


def test_mixed_table_repeats_documents(spark):
    frame = spark.createDataFrame([(i, f"w{i} x", "a" if i < 10 else "b", "old") for i in range(100)], "doc_id long, text string, source string, copy string")
    rows = mixing.mix(frame, mixing.words(F.col("text"))).collect()
    assert sum(r["source"] == "a" for r in rows) == 30 and sum(r["source"] == "b" for r in rows) == 70
    assert all(r.text == f"w{r.doc_id} x" and 1 <= r["copy"] <= r.copies for r in rows)


def test_plan_is_native(spark, root):
    plan = queries.op13_mix(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)
