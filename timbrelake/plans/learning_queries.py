"""Label indexing, vectors, splits, classifiers, metrics, scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from timbrelake.constants import BINARY_FOREST
from timbrelake.operators import learning
from timbrelake.operators.filters import feature_columns, with_label
from timbrelake.operators.profile import rounded
from timbrelake.plans import views
from timbrelake.plans.registry import bucket_sql, half_up, query
from timbrelake.session import scratch_path

_TRAIN = f"{bucket_sql('p_partkey', 100)} < 80"


@query("""WITH names AS (
  SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS idx
  FROM part GROUP BY p_brand)
SELECT p_partkey, p_brand, CAST(idx AS DOUBLE) AS label FROM part JOIN names USING (p_brand)""")
def label_index(spark, root):
    parts = views.table(spark, root, "part").select("p_partkey", "p_brand")
    return learning.label_indexer("p_brand").fit(parts).transform(parts)


@query("""SELECT event_id, value AS x1, CAST(user_id AS DOUBLE) AS x2 FROM events
WHERE user_id % 10 > 1""")
def assemble_skip(spark, root):
    """Rows with a NULL or NaN feature are left out."""
    value = (
        F.when(F.col("user_id") % 10 == 0, None)
        .when(F.col("user_id") % 10 == 1, float("nan"))
        .otherwise(F.col("value"))
    )
    events = views.table(spark, root, "events").select(
        "event_id", value.alias("value"), "user_id"
    )
    vector = vector_to_array("features")
    return learning.assembler(["value", "user_id"]).transform(events).select(
        "event_id", vector[0].alias("x1"), vector[1].alias("x2")
    )


@query(f"""WITH fitted AS (
  SELECT avg(p_size) AS m1, stddev_samp(p_size) AS d1, avg(p_retailprice) AS m2,
         stddev_samp(p_retailprice) AS d2 FROM part WHERE {_TRAIN})
SELECT p_partkey, {half_up('(p_size - m1) / d1', 6)} AS z1,
       {half_up('(p_retailprice - m2) / d2', 6)} AS z2
FROM part, fitted""")
def standardise(spark, root):
    """Fitted on the training part, applied to all rows."""
    parts = views.table(spark, root, "part")
    rows = learning.assembler(["p_size", "p_retailprice"], "features_raw").transform(parts)
    train, _ = learning.hash_split(rows, "p_partkey")
    vector = vector_to_array("features")
    return learning.scaler().fit(train).transform(rows).select(
        "p_partkey", rounded(vector[0], 6).alias("z1"), rounded(vector[1], 6).alias("z2")
    )


@query(f"""SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey', 100)} < 80 THEN 'train'
       ELSE 'test' END AS part FROM orders""")
def hash_split(spark, root):
    orders = views.table(spark, root, "orders").select("o_orderkey")
    train, test = learning.hash_split(orders, "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


# --- metrics --------------------------------------------------------------------------------


@query(f"""WITH {views.SCORED}
SELECT {half_up('avg(CAST(label = prediction AS INTEGER))', 9)} AS accuracy FROM scored""")
def metric_accuracy(spark, root):
    metrics = learning.classification_metrics(views.scored_documents(spark, root))
    return metrics.select(rounded(F.col("accuracy"), 9).alias("accuracy"))


@query(f"""WITH {views.SCORED},
classes AS (SELECT DISTINCT label AS c FROM scored),
parts AS (SELECT c, count(*) FILTER (label = c) AS actual,
                 count(*) FILTER (prediction = c) AS guessed,
                 count(*) FILTER (label = c AND prediction = c) AS hits
          FROM scored, classes GROUP BY c)
SELECT {half_up('sum(2.0::DOUBLE * hits / (actual + guessed) * actual) / sum(actual)', 9)} AS f1
FROM parts""")
def metric_f1(spark, root):
    metrics = learning.classification_metrics(views.scored_documents(spark, root))
    return metrics.select(rounded(F.col("f1"), 9).alias("f1"))


@query(f"""WITH {views.SCORED},
ranked AS (SELECT label, rank() OVER (ORDER BY score)
                  + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM scored),
sums AS (SELECT sum(r) FILTER (label = 1) AS rs, count(*) FILTER (label = 1) AS pos,
                count(*) FILTER (label = 0) AS neg FROM ranked)
SELECT {half_up('(rs - pos * (pos + 1) / 2.0::DOUBLE) / (CAST(pos AS DOUBLE) * neg)', 9)} AS auc
FROM sums""")
def metric_auc(spark, root):
    area = learning.area_under_roc(views.scored_documents(spark, root), "label", "score")
    return spark.range(1).select(rounded(F.lit(area), 9).alias("auc"))


# --- classifiers --------------------------------------------------------------------------------
# Fits differ in the last digits from run to run. What does not is compared: the rows they were
# fitted on and tested with, that the fit is better than a guess on its own rows (the given labels
# are noise, so no fit is on others), and that metrics are what metrics can be.

_HELD_OUT = f"{bucket_sql('vec_id', 100)} >= 80"
_MULTICLASS = f"""SELECT count(*) FILTER ({_HELD_OUT}) AS tested,
  count(DISTINCT label) FILTER (NOT {_HELD_OUT}) AS classes, TRUE AS better FROM embeddings"""


def _multiclass(spark, root, stages):
    """Held-out rows, classes, and whether the fit beats an even guess and its metrics are sound."""
    rows = with_label(views.vectors(spark, root), "genre")
    train, test = learning.hash_split(rows, "vec_id")
    model = stages(feature_columns(rows, ["vec_id"])).fit(train)
    scored = model.transform(test)
    classes = len(model.stages[0].labels)
    own = learning.classification_metrics(model.transform(train)).first()["accuracy"]
    metrics = learning.classification_metrics(scored)
    sound = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    return metrics.select(
        F.lit(scored.count()).cast("bigint").alias("tested"), F.lit(classes).cast("bigint").alias("classes"),
        (sound & F.lit(own > 1 / classes)).alias("better"),
    )


@query(_MULTICLASS)
def rf_multiclass(spark, root):
    return _multiclass(spark, root, learning.forest_stages)


@query(_MULTICLASS)
def lr_multinomial(spark, root):
    return _multiclass(spark, root, learning.logistic_stages)


# Labels that follow from the features: which of the first three is the largest.
_RULE = f"""SELECT count(*) FILTER ({_HELD_OUT}) AS tested, TRUE AS learned FROM embeddings"""
#: Accuracy and F1 that a fit reaches on held-out rows, of which an even guess gets a third right.
_LEARNED = 0.6


def _rule(spark, root, stages):
    """Held-out rows, and whether accuracy and F1 on them show that the rule was learned."""
    largest = F.greatest("x0", "x1", "x2")
    name = F.when(F.col("x0") == largest, "first").when(F.col("x1") == largest, "second").otherwise("third")
    rows = views.vectors(spark, root).select("vec_id", "x0", "x1", "x2", "x3", name.alias("label_str"))
    train, test = learning.hash_split(rows, "vec_id")
    scored = stages(["x0", "x1", "x2", "x3"]).fit(train).transform(test)
    metrics = learning.classification_metrics(scored)
    learned = (F.col("accuracy") >= _LEARNED) & (F.col("f1") >= _LEARNED)
    return metrics.select(F.lit(scored.count()).cast("bigint").alias("tested"), learned.alias("learned"))


@query(_RULE)
def rf_rule(spark, root):
    return _rule(spark, root, learning.forest_stages)


@query(_RULE)
def lr_rule(spark, root):
    return _rule(spark, root, learning.logistic_stages)


_ONE_VS_REST = f"""WITH counts AS (
  SELECT 'genre' || CAST(label AS VARCHAR) AS genre, count(*) AS total,
         count(*) FILTER (NOT {_HELD_OUT}) AS pos FROM embeddings GROUP BY 1)
SELECT genre, pos, (SELECT sum(pos) FROM counts)::BIGINT - pos AS neg, TRUE AS sound
FROM counts WHERE total >= 20"""


def _one_vs_rest(spark, root, kind, sound):
    """Training rows of each genre and the others, and whether the genre's model passes a test of its fit."""
    rows = views.vectors(spark, root)
    features = feature_columns(rows, ["vec_id"])
    tagged = rows.withColumn("genres", F.array("genre"))
    scores, models = learning.one_vs_rest(tagged, "vec_id", features, kind, held_out=False)
    passed = spark.createDataFrame(sound(tagged, features, models), "genre STRING, fits BOOLEAN")
    return scores.join(passed, "genre").select("genre", "pos", "neg", ((F.col("auc") > 0.5) & F.col("fits")).alias("sound"))


def _calibrated(rows, features, models):
    """Whether the mean probability on the training rows is the share of the genre, as at the optimum only."""
    raw = learning.assembler(features, "features_raw").transform(rows)
    train, _ = learning.hash_split(raw, "vec_id")
    train = learning.scaler().fit(train).transform(train).select("genres", vector_to_array("features").alias("x"))
    gaps = []
    for i, (genre, model) in enumerate(models.items()):
        weights = F.array(*[F.lit(w) for w in model.coefficients.toArray().tolist()])
        margin = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(float(model.intercept)), lambda a, b: a + b)
        has = F.array_contains("genres", genre).cast("double")
        gaps.append(F.avg(1 / (1 + F.exp(-margin)) - has).alias(f"g{i}"))
    found = train.agg(*gaps).first() if gaps else []
    return [(genre, abs(gap) < 1e-6) for genre, gap in zip(models, found)]


def _grown(rows, features, models):
    """Whether the forest has all its trees."""
    return [(genre, model.getNumTrees == BINARY_FOREST["numTrees"]) for genre, model in models.items()]


@query(_ONE_VS_REST)
def ovr_logistic(spark, root):
    return _one_vs_rest(spark, root, "logistic", _calibrated)


@query(_ONE_VS_REST)
def ovr_forest(spark, root):
    return _one_vs_rest(spark, root, "forest", _grown)


def _forest(spark, root):
    """A forest of the training part, and the held-out rows."""
    rows = with_label(views.vectors(spark, root), "genre")
    features = feature_columns(rows, ["vec_id"])
    train, test = learning.hash_split(rows, "vec_id")
    return learning.forest_stages(features).fit(train), test


@query(f"SELECT count(*) AS scored, CAST(0 AS BIGINT) AS changed FROM embeddings WHERE {_HELD_OUT}")
def model_roundtrip(spark, root):
    """Predictions of a saved and reloaded model against those of the original."""
    model, rows = _forest(spark, root)
    path = scratch_path(spark, "model")
    learning.save_model(model, path)
    loaded = learning.load_model(path)
    before = model.transform(rows).select("vec_id", F.col("prediction").alias("a"))
    after = loaded.transform(rows).select("vec_id", F.col("prediction").alias("b"))
    return before.join(after, "vec_id").agg(
        F.count("*").alias("scored"), F.count_if(F.col("a") != F.col("b")).alias("changed")
    )


@query(f"""SELECT vec_id, CAST(3 AS BIGINT) AS places, TRUE AS falling, TRUE AS first_is_prediction
FROM embeddings WHERE {_HELD_OUT}""")
def predict_top3(spark, root):
    """Three places for each held-out vector, in falling probability, the first the prediction."""
    model, rows = _forest(spark, root)
    top = learning.predict_top(model, rows.drop("genre", "label_str"), "vec_id")
    names = F.array(*[F.lit(name) for name in model.stages[0].labels])
    guessed = model.transform(rows).select(
        "vec_id", F.get(names, F.col("prediction").cast("int")).alias("guess")
    )
    entry = F.sort_array(F.collect_list(F.struct("rank", "label", "probability")))
    places = top.groupBy("vec_id").agg(entry.alias("e")).join(guessed, "vec_id")
    falling = F.expr("forall(sequence(1, size(e) - 1), i -> e[i - 1].probability >= e[i].probability)")
    return places.select(
        "vec_id", F.size("e").cast("bigint").alias("places"), falling.alias("falling"),
        (F.col("e")[0]["label"] == F.col("guess")).alias("first_is_prediction"),
    )
