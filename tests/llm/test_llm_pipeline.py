"""The stages on a small corpus with planted cases, and every stage on odd input."""

import plain
import pytest

import corpus_pipeline as cp

PASSAGE = " ".join(f"shared{i}" for i in range(70)) + "."


def text(seed, n=120):
    return ". ".join(" ".join(f"w{(seed * 7919 + i * 104729 + j) % 99991}" for j in range(8)) for i in range(n // 8)) + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    items = [" ".join(f"item{k}x{i}" for i in range(30)) for k in range(4)]
    docs = {d: text(d) for d in range(40)}
    docs |= {100 + d: f"{text(200 + d)}\nyou vile creature {d} vile words" for d in range(60)}
    docs[40] = docs[0]
    docs[41] = text(1).replace("w", "w", 1) + " end"
    docs[50], docs[51] = f"{text(50)}\n{PASSAGE}\n{text(52)}", f"{text(51)}\n{PASSAGE}\n{text(53)}"
    docs[60] = f"{text(60)}\n{items[1]}\n{text(61)}"
    plain.documents(spark, list(docs.values()), list(docs)).write.parquet(f"{root}/documents.parquet")
    labels = [(d, int(d >= 100)) for d in docs if d % 3]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, docs


def test_stages_catch_planted_cases_and_keep_the_rest(spark, corpus):
    root, docs = corpus
    table, kept = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, table, root)
        assert out.columns == table.columns
        out.write.parquet(f"{root}/{name.replace(' ', '_')}")
        table = spark.read.parquet(f"{root}/{name.replace(' ', '_')}")
        kept[name] = {r.doc_id: r.text for r in table.collect()}
    clean = set(range(40)) | {40, 41, 50, 51, 60}
    assert set(kept["toxicity"]) == clean
    assert set(kept["line dedup"]) == clean and PASSAGE in kept["line dedup"][50] and PASSAGE not in kept["line dedup"][51]
    assert kept["line dedup"][40] == "" and all(kept["line dedup"][d] == docs[d] for d in range(2, 40))
    assert set(kept["near dedup"]) >= set(range(40)) | {50, 51, 60}
    assert set(kept["decontamination"]) == set(kept["near dedup"]) - {60}
    pieces = cp.STAGES[-1][1](spark, table, root).collect()
    assert {r.doc_id for r in pieces} == set(kept["decontamination"])


def test_run_is_the_stages(spark, corpus):
    rows = cp.run(spark, corpus[0])
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 40


def test_stages_take_odd_tables(spark, corpus):
    for docs in (plain.documents(spark), plain.documents(spark).limit(0), plain.documents(spark).drop("n_chars")):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, corpus[0])
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert len(rows) > 0 or docs.isEmpty()


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    texts = [text(1), text(1), text(2), text(3) + " x", text(3) + " x", text(4)]
    got = cp.dedup_documents(spark, plain.documents(spark, texts, [5, 4, 3, 2, 1, 0]), "").collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 3, 4]
