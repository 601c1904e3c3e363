import numpy as np
import plain
import pytest
import zlib

from timbrelake.llm import toxicity as tx


def test_held_out_rule(spark):
    ids = [0, 1, 2, 3, 17, 123456, -5]
    frame = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in frame.select("doc_id", tx.held_out(frame.doc_id).alias("h")).collect()}
    assert got == {**{i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}, None: False}


def test_accuracy_on_held_out_rows(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    got = tx.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    caught = got[got.toxic == 1].predicted.mean()
    wrong = got[got.toxic == 0].predicted.mean()
    assert len(got) > 900 and caught > 0.85 and wrong < 0.01
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_labels_of_held_out_rows_do_not_matter(spark, root, docs):
    labels = spark.read.parquet(f"{root}/labels.parquet")
    turned = labels.withColumn("toxic", tx.F.when(tx.held_out(tx.F.col("doc_id")), 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    a, b = (sorted(tx.toxicity(docs, x).collect()) for x in (labels, turned))
    assert [r.score for r in a] == pytest.approx([r.score for r in b], abs=1e-9)


def test_edge_cases(spark):
    frame = plain.documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (99, 0), (4, 5)], "doc_id long, toxic int")
    out = tx.toxicity(frame, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(plain.TEXTS)
    assert tx.toxicity(frame.limit(0), labels).count() == 0
    assert tx.toxicity(frame, labels.limit(0)).where("predicted = 1").count() == 0
    kept = tx.without_toxic(frame, labels.limit(0))
    assert kept.columns == frame.columns and kept.count() == len(plain.TEXTS)


def test_label_model_finds_chances_and_discounts_echoes():
    rng = np.random.default_rng(3)
    hidden = rng.random(6000) < 0.2
    chance = np.array([[0.01, 0.6], [0.02, 0.5], [0.01, 0.4]])
    votes = (rng.random((6000, 3)) < np.where(hidden[:, None], chance[:, 1], chance[:, 0])).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # an echo of the first voter
    said = np.where(rng.random(6000) < 0.05, ~hidden, hidden).astype(int)
    model, posterior = tx.LabelModel.fit(votes, said)
    assert model.weight[0] < 0.6 < model.weight[1] and abs(model.fire[1, 1] - 0.5) < 0.1
    assert ((posterior > 0.5) == hidden).mean() > 0.95


def test_learned_words_carry_over(spark):
    bad = [f"some text with grumbly words number {i} in it" for i in range(60)]
    good = [f"some text with other words number {i} in it" for i in range(60)]
    texts, ids = bad + good, list(range(1000, 1120))
    labels = spark.createDataFrame([(d, int(d < 1060)) for d in ids], "doc_id long, toxic int")
    more = ["grumbly", "nothing here", "grumblier"]
    got = tx.toxicity(plain.documents(spark, texts + more, ids + [1, 2, 3]), labels)
    assert {r.doc_id: r.predicted for r in got.collect() if r.doc_id < 4} == {1: 1, 2: 0, 3: 1}
