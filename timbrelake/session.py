"""Session settings and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

#: Settings that suit the engine; sizes (memory, cores) are left to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "timbrelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword ``a__b`` sets option ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder: ``spark.checkpoint.dir``, or a fresh one for a local master.

    Executors on other machines must be able to read what is written here, so on a cluster a
    missing setting is an error and never a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    fresh = tempfile.mkdtemp(prefix="timbrelake-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of this session once what was read from it has been written."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(location, True)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context.

    Functions run by Python workers import it there, wherever the driver was started. Spark
    itself distributes the archive from the driver.
    """
    context = spark.sparkContext
    if getattr(context, "_timbrelake_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="timbrelake-"), "timbrelake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._timbrelake_shipped = True
