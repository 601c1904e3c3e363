"""The extraction job driven by file arrival: only files not seen before are processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timbrelake.functions.dsp import SignalConfig
from timbrelake.operators.filters import only_ok
from timbrelake.operators.joins import pending
from timbrelake.operators.signal import extract_features
from timbrelake.session import path_exists, remove_path
from timbrelake.sinks import overwrite

_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def extract_new_files(
    spark: SparkSession,
    root: str,
    out: str,
    progress: str,
    glob: str = "*.wav",
    files_per_batch: int = 10_000,
    config: SignalConfig = SignalConfig(),
) -> None:
    """Append the features of files that arrived since the last run; failures go to ``<out>_failures``.

    ``progress`` keeps the stream's own record of processed files, which takes the place of the
    comparison with earlier output. Every batch is analysed once into a folder beside the output;
    what is there after a batch that was ended half-way shows its repetition, which then leaves
    out what has been stored already, so that no file is stored twice. A failed file is stored
    with its error and counts as processed; :func:`timbrelake.plans.jobs.extract` on the same
    output takes it up again, as it is not among the features.
    """
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path", "content")
    )

    def store(batch: DataFrame, number: int) -> None:
        folder = f"{out}_staged/batch={number}"
        repeated = path_exists(spark, folder)
        overwrite(batch, folder)
        rows = spark.read.parquet(folder)
        good = only_ok(rows).drop("n_samples", "sr", "error")
        for part, path in ((good, out), (rows.filter("ok = 0").select("path", "error"), f"{out}_failures")):
            if repeated and path_exists(spark, path):
                part = pending(part, spark.read.parquet(path), "path")
            if path == out or not part.isEmpty():
                part.write.mode("append").parquet(path)
        earlier = f"{out}_staged/batch={number - 1}"  # its batch has been recorded as done
        if path_exists(spark, earlier):
            remove_path(spark, earlier)

    run = (
        extract_features(arrived, "path", config=config)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
