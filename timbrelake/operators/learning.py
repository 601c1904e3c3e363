"""Label indexing, splits, classifiers, metrics and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.constants import BINARY_FOREST, FOREST, LOGISTIC, TRAIN_PERCENT
from timbrelake.functions.arrays import top_entries
from timbrelake.functions.keys import stable_bucket, tag_indicator
from timbrelake.operators.profile import class_balance
from timbrelake.operators.tag_models import areas_under_roc, fit_logistic, tag_matrix, tag_scores
from timbrelake.session import path_exists, scratch_path


def hash_split(
    df: DataFrame, key: str, percent: int = TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run and partitioning."""
    bucket = stable_bucket(F.col(key), 100)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def label_indexer(label: str = "label_str", output: str = "label") -> StringIndexer:
    """Most frequent label = 0; rows with unknown or NULL labels are skipped."""
    return StringIndexer(inputCol=label, outputCol=output, handleInvalid="skip")


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    """Feature vector; rows with NULL or NaN in it are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def forest_stages(features: Sequence[str], label: str = "label_str", **params) -> Pipeline:
    """Index, assemble, multiclass random forest."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", **(FOREST | params)
    )
    return Pipeline(stages=[label_indexer(label), assembler(features), forest])


def logistic_stages(features: Sequence[str], label: str = "label_str", **params) -> Pipeline:
    """Index, assemble, standardise, multinomial logistic regression."""
    model = LogisticRegression(
        featuresCol="features", labelCol="label", family="multinomial", **(LOGISTIC | params)
    )
    raw = assembler(features, "features_raw")
    return Pipeline(stages=[label_indexer(label), raw, scaler(), model])


def classification_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and support-weighted F1 in one row, both from one confusion count.

    The rows are reduced to one count per pair of classes before anything else happens.
    """
    pairs = predictions.groupBy(
        F.col(label).cast("double").alias("truth"), F.col(prediction).cast("double").alias("guess")
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    # Each class as the truth and as the guess of its pairs.
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("truth").alias("class"), F.col("n").alias("actual"),
                         F.lit(0).cast("bigint").alias("guessed"), hit.alias("hits")),
                F.struct(F.col("guess").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                         F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hits")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("guessed").alias("guessed"),
        F.sum("hits").alias("hits"),
    )
    f1 = F.coalesce(
        F.try_divide(2 * F.col("hits"), F.col("actual") + F.col("guessed")), F.lit(0.0)
    )
    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("actual")), F.sum("actual")).alias("f1"),
    )


def area_under_roc(predictions: DataFrame, label: str, score: str) -> float:
    """Exact area under ROC: no binning of scores, see :func:`tag_models.areas_under_roc`; 0 of nothing."""
    return areas_under_roc(predictions, label=label, score=score).first()["auc"] or 0.0


def one_vs_rest(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    kind: str = "logistic",
    tags: str = "genres",
    at_least: int = 20,
    parallelism: int = 4,
    held_out: bool = True,
    **params,
) -> tuple[DataFrame, dict]:
    """A binary classifier per sufficiently frequent tag: table of scores, and the models.

    Vectors are assembled and scaled once and written to the shared folder; balances of all tags
    come from one aggregation. Logistic models are fitted side by side, with one pass over the
    rows for each step of all of them (:func:`tag_models.fit_logistic`, which takes ``regParam``
    and ``maxIter`` of the parameters). Forests share nothing but their rows: they are Spark jobs,
    of which ``parallelism`` run side by side and each writes its scores once. All areas under ROC
    come from one pass. Scores are those of the held-out rows, or of the training rows without
    ``held_out``.
    """
    spark = df.sparkSession
    logistic = kind == "logistic"
    assembled = assembler(features, "features_raw" if logistic else "features").transform(df)
    train, test = hash_split(assembled, key)
    if logistic:
        scaling = scaler().fit(train)
        train, test = scaling.transform(train), scaling.transform(test)
    supported = [
        row["genre"]
        for row in df.select(F.explode(tags).alias("genre")).groupBy("genre").count()
        .filter(F.col("count") >= at_least).select("genre").collect()
    ]
    wanted = F.array(*[F.lit(tag) for tag in supported])
    balance = {
        row["genre"]: (row["pos"], row["neg"])
        for row in class_balance(train, tags, 1)
        .filter(F.array_contains(wanted, F.col("genre"))).collect()
    } if supported else {}
    names = sorted(balance)
    both = train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))
    fit = _logistic_models if logistic else _forest_models
    models, areas = fit(both, tags, names, [balance[n][0] for n in names], held_out, parallelism, params)
    rows = [(tag, *balance[tag], areas.get(tag, 0.0)) for tag in names]
    scores = spark.createDataFrame(rows, "genre STRING, pos BIGINT, neg BIGINT, auc DOUBLE")
    return scores.orderBy(F.desc("pos"), "genre"), models


def _logistic_models(both, tags, names, positives, held_out, parallelism, params) -> tuple[dict, dict]:
    settings = LOGISTIC | params
    matrix = tag_matrix(both, "features", tags, names, "test")
    train = matrix.filter(~F.col("test"))
    theta = fit_logistic(train, positives, settings["regParam"], passes=settings["maxIter"])
    scored = tag_scores(matrix.filter("test") if held_out else train, theta)
    areas = {names[r["tag"]]: r["auc"] for r in areas_under_roc(scored, "tag").collect()}
    return {tag: _logistic_model(row) for tag, row in zip(names, theta)}, areas


def _logistic_model(weights) -> LogisticRegressionModel:
    """A Spark model with these weights, the intercept last."""
    jvm = SparkSession.active()._jvm
    made = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        Identifiable().uid,
        _py2java(SparkSession.active().sparkContext, Vectors.dense(weights[:-1])), float(weights[-1]),
    )
    return LogisticRegressionModel(made)


def _forest_models(both, tags, names, positives, held_out, parallelism, params) -> tuple[dict, dict]:
    spark = both.sparkSession
    path, scores = scratch_path(spark, "tag-vectors"), scratch_path(spark, "tag-scores")
    both.select(F.col(tags).alias("tags"), "features", "test").write.parquet(path)
    rows = spark.read.parquet(path)
    # Rows keep the node they are at in each tree, so that no level walks down from the root again.
    settings = {"cacheNodeIds": True, "checkpointInterval": -1} | BINARY_FOREST | params

    def fit(place: int) -> RandomForestClassificationModel:
        labelled = rows.withColumn("label", tag_indicator(F.col("tags"), names[place]))
        model = RandomForestClassifier(featuresCol="features", labelCol="label", **settings).fit(labelled.filter(~F.col("test")))
        scored = model.transform(labelled.filter(F.col("test") == held_out))
        score = vector_to_array("probability")[1].alias("score")
        scored.select(F.lit(place).alias("tag"), score, "label").write.parquet(f"{scores}/{place}")
        return model

    if not names:
        return {}, {}
    with ThreadPool(max(1, min(parallelism, len(names)))) as pool:
        models = pool.map(fit, range(len(names)), chunksize=1)
    scored = spark.read.parquet(*(f"{scores}/{place}" for place in range(len(names))))
    areas = {names[r["tag"]]: r["auc"] for r in areas_under_roc(scored, "tag").collect()}
    return dict(zip(names, models)), areas


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None if there is none at the path."""
    spark = SparkSession.active()
    return PipelineModel.load(path) if path_exists(spark, path) else None


def predict_top(model: PipelineModel, df: DataFrame, *keys: str, k: int = 3) -> DataFrame:
    """The ``k`` most probable labels of each row: key, rank, label, probability.

    Scores without the label indexer, so rows need no label; absent or NULL features count as 0.
    """
    indexer, assemble, classifier = model.stages[0], model.stages[1], model.stages[-1]
    names = assemble.getInputCols()
    absent = [name for name in names if name not in df.columns]
    filled = df.withColumns({name: F.lit(0.0) for name in absent}).na.fill(0.0, list(names))
    scored = filled
    for stage in (assemble, *model.stages[2:-1], classifier):
        scored = stage.transform(scored)
    labels = F.array(*[F.lit(label) for label in indexer.labels])
    best = top_entries(vector_to_array("probability"), k)
    return scored.select(*keys, F.posexplode(best).alias("place", "entry")).select(
        *keys,
        (F.col("place") + 1).alias("rank"),
        F.get(labels, F.col("entry.position")).alias("label"),
        F.col("entry.value").alias("probability"),
    )
