import random

import plain

from timbrelake.llm import decontamination as dc


def edited(items):
    """Documents that hold items whole, changed in a word or two, cut, and not at all."""
    pick, out = random.Random(4), []
    for text in items:
        words = text.split()
        out.append("Before it. " + text + " After it.")
        for n in (1, 2):
            changed = list(words)
            for _ in range(n):
                changed[pick.choice([0, 1, len(words) // 2, len(words) - 1])] = "other"
            out.append("Some words here " + " ".join(changed) + " and there")
        out.append(" ".join(words[: int(len(words) * 0.95)]))
    return [*out, "Nothing of it.", "", None, items[0].upper()]


def test_matches_plain_version(spark, root):
    items = [r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    texts = edited(items)
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)], "item_id long, text string, doc_id string")
    got = dc.leaks(plain.documents(spark, texts, list(range(len(texts)))), bench)
    want = plain.leaks(texts, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) >= 24
    small = dc.leaks(plain.documents(spark, texts, list(range(len(texts)))), bench, most=500)
    assert sorted(small.collect()) == sorted(got.collect())
    kept = dc.decontaminate(plain.documents(spark, texts, list(range(len(texts)))), bench, most=500)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_whole_tables(spark, root, docs, pdocs):
    bench = spark.read.parquet(f"{root}/benchmark.parquet")
    held = {(int(d), b.item_id) for b in bench.collect() for d, t in zip(pdocs.doc_id, pdocs.text) if b.text in t}
    got = dc.leaks(docs, bench).collect()
    assert held <= {(r.doc_id, r.item_id) for r in got} and all(r.similarity >= 0.8 for r in got)


def test_edge_cases(spark):
    items = ["two three", "", None, "one two three four five six seven eight", "WORD"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    frame = plain.documents(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    pairs = sorted((str(rows[d][0]), k) for d, k in plain.leaks([t for _, t in rows], items))
    assert sorted((str(r.doc_id), r.item_id) for r in dc.leaks(frame, bench).collect()) == pairs
    kept = dc.decontaminate(frame, bench)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 5
    assert dc.leaks(frame.limit(0), bench).count() == 0 == dc.leaks(frame, bench.limit(0)).count()
    assert dc.decontaminate(frame, bench.limit(0)).count() == len(rows)


def test_cut_copies_match_plain_version(spark):
    items = [" ".join(f"item{k}x{i}" for i in range(n)) for k, n in enumerate((59, 45, 36, 30))]
    texts = [" ".join(t.split()[: round(len(t.split()) * share)]) for t in items for share in (0.75, 0.8, 0.83, 0.85, 0.9, 0.95)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = plain.leaks(texts, items)
    got = dc.leaks(plain.documents(spark, texts, list(range(len(texts)))), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) >= 16
