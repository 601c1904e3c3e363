"""End-to-end jobs: extract, build the training set, train, profile, analyse one item."""

from __future__ import annotations

from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.constants import BATCH_SIZE, MAX_PER_CLASS, USERS, WANTED_GENRES
from timbrelake.functions.dsp import SignalConfig
from timbrelake.functions.keys import assign_user, first_genre, genre_tags
from timbrelake.operators import catalogue, filters, joins, learning, profile, signal
from timbrelake.operators.filters import Selection
from timbrelake.operators.ordering import batch_number, global_index, shard_index
from timbrelake.session import path_exists, remove_path, scratch_path, shared_dir

_STATUS = ("n_samples", "sr", "ok", "error")


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The data set at a path, or None if nothing has been written there yet."""
    if not path_exists(spark, path):
        return None
    try:
        return sources.read_dataset(spark, path)
    except AnalysisException as failure:
        if failure.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any data file
            return None
        raise


# --- catalogue --------------------------------------------------------------------------------


def filter_catalogue(
    spark: SparkSession, source: str, target: str, wanted: list[str] = WANTED_GENRES,
    cap: int | None = MAX_PER_CLASS,
) -> DataFrame:
    """Write the catalogue rows of the wanted genres, unchanged, and count them per genre.

    With a cap, a row counts for its first genre and each genre keeps its first ``cap`` rows in
    file order; without one, rows with any wanted genre are kept.
    """
    rows, header = sources.read_catalogue(spark, source), sources.header_of(spark, source)
    if cap is None:
        sinks.write_lines(catalogue.wanted_rows(rows, wanted=wanted), target, header)
        return catalogue.wanted_repartition(sources.read_catalogue(spark, target), wanted=wanted)
    kept = catalogue.cap_first_genre(rows, "position", wanted=wanted, cap=cap)
    sinks.write_lines(kept, target, header)
    stored = sources.read_catalogue(spark, target)
    counted = stored.withColumn("genre", first_genre(F.col("tags")))
    return profile.group_count(counted, "genre").orderBy(F.desc("count"), "genre")


# --- extraction and training set ----------------------------------------------------------------


def extract(
    spark: SparkSession,
    root: str,
    out: str,
    glob: str = "*.wav",
    batch_size: int = BATCH_SIZE,
    uploaded_at: Column | None = None,
    upload: bool = False,
    round_batches: int = 50,
    config: SignalConfig = SignalConfig(),
) -> dict[str, int]:
    """Features of all files not extracted yet, appended below one directory per batch.

    Names are listed, deduplicated, compared with what is there and numbered. Content is read by
    Spark in rounds of ``round_batches`` batches, analysed where it is read and never shuffled;
    only features meet their batch number. A file that cannot be read fails the job; one that
    cannot be decoded is stored with its error at ``<out>_failures``. Rounds are committed one by
    one, so that a failed job loses one round; a rerun continues the batch numbers and skips what
    has been written. Returns how many files were found, pending, extracted and failed.
    """
    names = sources.list_files(spark, root, glob).dropDuplicates(["path"])
    found, first = names.count(), 0
    earlier = read_if_present(spark, out)
    if earlier is not None:
        names = joins.pending(names, earlier, "path")
        first = (earlier.agg(F.max("batch_id")).first()[0] or 0) + 1
    indexed, total = global_index(names, "path")
    counts = {"found": found, "pending": total, "extracted": 0, "failed": 0}
    if not total:
        return counts
    batches = -(-total // batch_size)
    batched = indexed.select(
        "path", batch_number(F.col("row_index"), batch_size, first).alias("batch_id")
    )
    for start in range(first, first + batches, round_batches):
        size = min(round_batches, first + batches - start)
        part = batched.filter((F.col("batch_id") >= start) & (F.col("batch_id") < start + size))
        chosen = [row["path"] for row in part.select("path").collect()]  # one round of names
        extracted = signal.extract_features(sources.read_files(spark, chosen), "path", config=config)
        done = scratch_path(spark, "round")
        sinks.overwrite(extracted, done)
        rows = sources.read_dataset(spark, done).join(part, "path")
        features = signal.upload_columns(rows, uploaded_at=uploaded_at) if upload else rows
        good = filters.only_ok(features).drop(*_STATUS).repartition("batch_id")
        sinks.append_partitioned(good, out, "batch_id")
        failed = rows.filter("ok = 0").select("path", "batch_id", "error")
        if not failed.isEmpty():
            failed.write.mode("append").parquet(f"{out}_failures")
            counts["failed"] += failed.count()
        remove_path(spark, done)
    return counts | {"extracted": total - counts["failed"]}


def extract_arrays(
    spark: SparkSession, root: str, out: str, glob: str = "*.wav",
    config: SignalConfig = SignalConfig(),
) -> dict[str, int]:
    """Array-valued features of all files, overwritten at ``out``; failures go to ``<out>_failures``.

    Files are analysed where Spark reads them. A rerun starts anew and replaces both.
    """
    files = sources.list_files(spark, root, glob, content=True).select("path", "content")
    done = scratch_path(spark, "arrays")
    sinks.overwrite(signal.extract_series(files, "path", config=config), done)
    rows = sources.read_dataset(spark, done)
    sinks.overwrite(filters.only_ok(rows).drop(*_STATUS), out)
    sinks.overwrite(rows.filter("ok = 0").select("path", "error"), f"{out}_failures")
    failed = rows.filter("ok = 0").count()
    counts = {"found": rows.count(), "extracted": rows.count() - failed, "failed": failed}
    remove_path(spark, done)
    return counts


def build_shards(
    spark: SparkSession, root: str, metadata: str, out: str, shards: int, glob: str = "*.wav",
    ragged: bool = True, round_files: int = 10_000, config: SignalConfig = SignalConfig(),
) -> DataFrame:
    """The training set built shard by shard: every ``shards``-th file by name, extracted, joined.

    One sort of the names gives all shards. Each shard is committed to its own directory, so a
    rerun skips the shards that are there. All of them are read back as one data set.
    """
    names = sources.list_files(spark, root, glob).dropDuplicates(["path"])
    placed = shard_index(names, "path", shards=shards)
    keyed = read_metadata(spark, metadata, ragged)
    paths = []
    for shard in range(shards):
        paths.append(f"{out}/dataset_part{shard}.parquet")
        if path_exists(spark, f"{paths[-1]}/_SUCCESS"):
            continue
        chosen = placed.filter(F.col("shard") == shard).select("path").toLocalIterator()
        done = scratch_path(spark, "shard")
        while some := [row["path"] for row in islice(chosen, round_files)]:  # so many at once
            files = sources.read_files(spark, some)
            found = signal.extract_features(files, "path", config=config)
            filters.only_ok(found).drop(*_STATUS).write.mode("append").parquet(done)
        features = read_if_present(spark, done)
        if features is None:  # a shard without files or with failures only
            empty = signal.extract_features(
                spark.createDataFrame([], "path STRING, content BINARY"), "path", config=config
            )
            features = empty.drop(*_STATUS)
        sinks.write_shard(joins.enrich(joins.keyed_features(features), keyed), out, shard)
        remove_path(spark, done)
    return sources.read_dataset(spark, *paths)


def read_metadata(spark: SparkSession, path: str, ragged: bool = True) -> DataFrame:
    """Keyed metadata from a ragged catalogue, or from a rectangular one with a TAGS column."""
    if ragged:
        rows = sources.read_catalogue(spark, path)
        return joins.keyed_metadata(rows, tags=genre_tags(F.col("tags")))
    return joins.keyed_metadata(sources.read_tsv(spark, path))


def build_dataset(
    spark: SparkSession, features: str, metadata: str, out: str, ragged: bool = True,
    users: int | None = USERS,
) -> DataFrame:
    """Features joined with their metadata, overwritten at ``out``; ``users`` adds user ids."""
    keyed = joins.keyed_features(sources.read_dataset(spark, features))
    joined = joins.enrich(keyed, read_metadata(spark, metadata, ragged))
    if users:
        joined = joined.withColumn("user_id", assign_user(F.col("track_num"), users))
    sinks.overwrite(joined, out)
    return sources.read_dataset(spark, out)


# --- learning -----------------------------------------------------------------------------------


def train(
    dataset: DataFrame,
    key: str,
    model_path: str | None = None,
    kind: str = "forest",
    **params,
) -> tuple[PipelineModel, DataFrame]:
    """Fit a multiclass model on the training part; the model and its held-out metrics.

    A data set with a ``genre`` uses it as the label, one with ``genres`` the first of them.
    """
    if "genre" in dataset.columns:
        rows = filters.with_label(dataset, "genre")
    else:
        rows = filters.with_tags(dataset).withColumn("label_str", F.get("genres", F.lit(0)))
    features = [name for name in filters.feature_columns(rows) if name != key]
    stages = {"forest": learning.forest_stages, "logistic": learning.logistic_stages}[kind]
    fit_rows, held_out = learning.hash_split(rows, key)
    model = stages(features, **params).fit(fit_rows)
    if model_path:
        learning.save_model(model, model_path)
    return model, learning.classification_metrics(model.transform(held_out))


# --- profile ------------------------------------------------------------------------------------


def facets(df: DataFrame) -> dict[str, DataFrame]:
    """What a selection can choose from: genres, users and dates, as far as there are such columns."""
    tables = {
        name: profile.facet_values(df, name) for name in ("genres", "user_id")
        if name in df.columns
    }
    if "uploaded_at" in df.columns:
        tables["uploaded_at"] = profile.date_range(df)
    return tables


def overview(
    df: DataFrame, selection: Selection = Selection(), exact: bool = False
) -> dict[str, DataFrame]:
    """Every table of the profile of a data set, after the selection.

    Three passes over the rows instead of one per table: one grouped by genre, whose small result
    is checkpointed and feeds the key figures, ranking, profile and scores, one for the histogram
    and one for the global statistics.
    """
    rows = filters.select_rows(df, selection)
    shared_dir(df.sparkSession)
    figures = [F.sum("tempo").alias("_tempo"), F.count("tempo").alias("_n_tempo")]
    timed = "duration" in rows.columns
    if timed:
        figures += [F.sum("duration").alias("_time"), F.count("duration").alias("_n_time")]
    groups = profile.group_profile(rows, n=None, extra=figures).checkpoint(eager=True)

    def mean(total: str, n: str) -> Column:
        return profile.rounded(F.try_divide(F.sum(total), F.sum(n)), 1)

    key_figures = [
        F.sum("count").alias("total"),
        mean("_tempo", "_n_tempo").alias("tempo_mean"),
        F.count("genres").alias("n_genres"),
    ]
    if timed:
        key_figures.append(mean("_time", "_n_time").alias("duration_avg"))
    largest = profile.top_groups(groups.drop("_tempo", "_n_tempo", "_time", "_n_time"))
    stats = profile.group_zscore(largest)
    return {
        "kpi": groups.agg(*key_figures).na.fill(0),
        "genres": profile.pareto_of(groups.select("genres", "count")),
        "tempo_buckets": profile.bucket_histogram(rows),
        "stats": stats,
        "zcr_flatness": profile.noise_of(largest),
        "feature_stats": profile.feature_stats(rows, exact=exact),
        "summary": profile.summary_table(stats),
    }


# --- one item -----------------------------------------------------------------------------------


def analyse_file(
    spark: SparkSession, path: str, name: str, history: str,
    config: SignalConfig = SignalConfig(),
) -> DataFrame:
    """Features of one file, appended to the history unless it failed; then an empty table.

    The one row is checkpointed, so the file is read and analysed once.
    """
    shared_dir(spark)
    one = sources.read_files(spark, [path])
    features = (
        signal.extract_upload(one, "path", config=config)
        .withColumn("filename", F.lit(name))
        .drop("path")
        .checkpoint(eager=True)
    )
    sinks.append_history(features, history)
    return filters.only_ok(features)


def history_entry(spark: SparkSession, history: str, name: str) -> DataFrame | None:
    """Stored features of a named file; None if there is no history."""
    stored = read_if_present(spark, history)
    return None if stored is None else stored.filter(F.col("filename") == name)
