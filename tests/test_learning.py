import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.sql import functions as F

from timbrelake.constants import LOGISTIC
from timbrelake.operators import learning, tag_models
from timbrelake.plans import views
from timbrelake.session import scratch_path


@pytest.fixture(scope="module")
def blobs(spark):
    """Three well separated classes of unequal size; a few rows have two tags."""
    draw = np.random.default_rng(5)
    data = []
    for i in range(360):
        label = "abc"[0 if i % 6 < 3 else 1 if i % 6 < 5 else 2]
        x, y = draw.normal(size=2) + {"a": (0, 0), "b": (6, 0), "c": (0, 6)}[label]
        tags = [label, "extra"] if i % 9 == 0 else [label]
        data.append((f"k{i}", label, tags, float(x), float(y)))
    return spark.createDataFrame(
        data, "key STRING, label_str STRING, genres ARRAY<STRING>, x DOUBLE, y DOUBLE"
    ).repartition(3).cache()


def test_split_is_the_same_for_any_partitioning(spark):
    frame = spark.range(3000)
    train, test = learning.hash_split(frame, "id")
    again, _ = learning.hash_split(frame.repartition(11), "id")
    assert {r[0] for r in train.collect()} == {r[0] for r in again.collect()}
    assert train.count() + test.count() == 3000
    assert 0.77 < train.count() / 3000 < 0.83


def test_metrics_equal_the_evaluators(spark, root):
    scored = views.scored_documents(spark, root)
    found = learning.classification_metrics(scored).first()
    for metric in ("accuracy", "f1"):
        expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(scored)
        assert found[metric] == pytest.approx(expected, abs=1e-12)


def test_metrics_of_a_class_never_predicted(spark):
    frame = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 0.0), (2.0, 2.0), (0.0, 3.0)], "label DOUBLE, prediction DOUBLE"
    )
    found = learning.classification_metrics(frame).first()
    for metric in ("accuracy", "f1"):
        expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(frame)
        assert found[metric] == pytest.approx(expected, abs=1e-12)


def test_area_under_roc_is_exact(spark):
    draw = np.random.default_rng(1)
    data = [(float(draw.integers(0, 2)), float(np.round(draw.normal(), 2))) for _ in range(3000)]
    frame = spark.createDataFrame(data, "label DOUBLE, score DOUBLE")
    pos = np.array([s for y, s in data if y == 1])
    neg = np.array([s for y, s in data if y == 0])
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    expected = wins / (len(pos) * len(neg))
    assert learning.area_under_roc(frame, "label", "score") == pytest.approx(expected, abs=1e-12)
    coarse = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=20).evaluate(frame)
    assert coarse == pytest.approx(expected, abs=0.05)


@pytest.mark.parametrize("stages", [learning.forest_stages, learning.logistic_stages])
def test_multiclass_models_learn(blobs, stages):
    params = {"numTrees": 10, "maxDepth": 4} if stages is learning.forest_stages else {}
    train, test = learning.hash_split(blobs, "key")
    model = stages(["x", "y"], **params).fit(train)
    metrics = learning.classification_metrics(model.transform(test)).first()
    assert metrics["accuracy"] > 0.9 and metrics["f1"] > 0.9
    assert model.stages[0].labels == ["a", "b", "c"]


@pytest.mark.parametrize("kind, params", [("logistic", {}), ("forest", {"numTrees": 10})])
def test_one_vs_rest(blobs, kind, params):
    scores, models = learning.one_vs_rest(blobs, "key", ["x", "y"], kind, **params)
    found = {r["genre"]: r for r in scores.collect()}
    assert set(found) == {"a", "b", "c", "extra"} == set(models)
    train, _ = learning.hash_split(blobs, "key")
    for genre, row in found.items():
        has = F.array_contains("genres", genre)
        assert row["pos"] == train.filter(has).count()
        assert row["neg"] == train.filter(~has).count()
    assert min(found[g]["auc"] for g in "bc") > 0.95
    few, _ = learning.one_vs_rest(blobs, "key", ["x", "y"], kind, at_least=100, **params)
    assert {r["genre"] for r in few.collect()} == {"a", "b"}


def test_all_tags_at_once_equal_a_fit_for_each(spark, monkeypatch):
    """Weights of every tag against Spark ML's own fit, rare and overlapping tags included."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(900, 5)) * [1, 3, 0.2, 1, 1] + [0, 5, 0, 0, 0]
    x[:, 4] = 2 * x[:, 0] + 0.1 * x[:, 4]
    rare = set(draw.choice(900, 12, replace=False).tolist())
    data = []
    for i, row in enumerate(x.tolist()):
        tags = [t for t, yes in (("a", row[0] + draw.normal() > 0), ("b", row[1] > 6), ("c", i % 3 == 0), ("d", i in rare)) if yes]
        data.append((f"k{i}", tags + tags[:1], *row))
    names = ["v", "w", "x", "y", "z"]
    frame = spark.createDataFrame(data, "key STRING, genres ARRAY<STRING>, " + ", ".join(f"{n} DOUBLE" for n in names)).repartition(5)
    passes = []
    losses = tag_models._losses
    monkeypatch.setattr(tag_models, "_losses", lambda *a: (passes.append(len(a[2])), losses(*a))[1])
    scores, models = learning.one_vs_rest(frame, "key", names, at_least=5)
    few = len(passes)
    assert few < 40 and passes[0] == 4
    areas = {r["genre"]: r["auc"] for r in scores.collect()}
    assembled = learning.assembler(names, "features_raw").transform(frame)
    train, test = learning.hash_split(assembled, "key")
    scaling = learning.scaler().fit(train)
    train, test = scaling.transform(train), scaling.transform(test)
    for tag, model in models.items():
        label = F.array_contains("genres", tag).cast("double")
        fitted = LogisticRegression(**(LOGISTIC | {"tol": 1e-12, "maxIter": 500})).fit(train.withColumn("label", label))
        assert model.coefficients.toArray() == pytest.approx(fitted.coefficients.toArray(), abs=1e-4)
        assert model.intercept == pytest.approx(fitted.intercept, abs=1e-4)
        scored = model.transform(test.withColumn("label", label))
        expected = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
        assert areas[tag] == pytest.approx(expected, abs=1e-9)
    monkeypatch.setattr(tag_models, "WEIGHTS", 12)  # two tags a group
    again = learning.one_vs_rest(frame, "key", names, at_least=5)[1]
    for tag, model in models.items():
        assert again[tag].coefficients.toArray() == pytest.approx(model.coefficients.toArray(), abs=1e-6)
    passes.clear()
    monkeypatch.setattr(tag_models, "WEIGHTS", 1 << 23)
    learning.one_vs_rest(frame, "key", names, at_least=300)
    assert 0 < passes[0] < 4 and len(passes) <= few + 2  # passes do not follow the number of tags


def test_areas_of_groups(spark):
    data = [("a", 1.0, 0.5), ("a", 0.0, 0.5), ("a", 1.0, 0.7), ("a", None, 0.1), ("a", 1.0, None), ("b", 0.0, 1.0), ("c", 1.0, 1.0)]
    frame = spark.createDataFrame(data, "g STRING, label DOUBLE, score DOUBLE")
    assert {tuple(r) for r in tag_models.areas_under_roc(frame, "g").collect()} == {("a", 0.75), ("b", 0.0), ("c", 1.0)}
    assert learning.area_under_roc(frame.limit(0), "label", "score") == 0.0
    plan = tag_models.areas_under_roc(frame, "g")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan


def test_save_load_and_predict(spark, blobs):
    path = scratch_path(spark, "model")
    assert learning.load_model(path) is None
    model = learning.forest_stages(["x", "y"], numTrees=5, maxDepth=4).fit(blobs)
    learning.save_model(model, path)
    learning.save_model(model, path)
    loaded = learning.load_model(path)
    assert loaded.stages[0].labels == ["a", "b", "c"]
    items = spark.createDataFrame([("p", 6.0, 0.0), ("q", 0.1, None)],
                                  "name STRING, x DOUBLE, y DOUBLE")
    found = learning.predict_top(loaded, items, "name", k=2).collect()
    assert [(r["name"], r["rank"]) for r in found] == [("p", 1), ("p", 2), ("q", 1), ("q", 2)]
    best = {r["name"]: r["label"] for r in found if r["rank"] == 1}
    assert best == {"p": "b", "q": "a"}
    assert {r["label"] for r in learning.predict_top(loaded, items.drop("y"), "name").collect()
            if r["name"] == "p" and r["rank"] == 1} == {"b"}


def test_logistic_models_predict_too(spark, blobs):
    model = learning.logistic_stages(["x", "y"]).fit(blobs)
    items = spark.createDataFrame([(0.0, 6.0)], "x DOUBLE, y DOUBLE")
    assert learning.predict_top(model, items, k=1).first()["label"] == "c"


def test_forests_are_plain_fits_and_their_areas_one_pass(spark, blobs, monkeypatch):
    calls = []
    areas = learning.areas_under_roc
    monkeypatch.setattr(learning, "areas_under_roc", lambda *a, **k: (calls.append(a[1:]), areas(*a, **k))[1])
    scores, models = learning.one_vs_rest(blobs, "key", ["x", "y"], "forest", numTrees=10)
    assert calls == [("tag",)] and len(models) == 4
    _, test = learning.hash_split(learning.assembler(["x", "y"]).transform(blobs), "key")
    found = {r["genre"]: r["auc"] for r in scores.collect()}
    _, again = learning.one_vs_rest(blobs, "key", ["x", "y"], "forest", numTrees=10, cacheNodeIds=False)
    for tag, model in models.items():
        scored = model.transform(test.withColumn("label", F.array_contains("genres", tag).cast("double")))
        assert found[tag] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(scored), abs=1e-9)
        assert model.toDebugString.splitlines()[1:] == again[tag].toDebugString.splitlines()[1:]
