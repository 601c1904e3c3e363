"""Tabular readers."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.constants import CATALOGUE_FIELDS, MIN_CATALOGUE_FIELDS, PATH_FIELD, SOURCE_SUFFIX
from timbrelake.functions.keys import swap_suffix

# A separator that lines hardly ever hold; a line that does is kept whole as a corrupt record.
_RARE_SEPARATOR = "\u0001"
# A field behind its tab; one that begins and ends with a quote may hold tabs.
_FIELD = '\t(?:"[^"]*+(?:""[^"]*+)*+"(?=\t|$)|[^\t]*+)'


def read_dataset(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet data set; several directories are read as one."""
    return spark.read.parquet(*paths)


def open_bucketed(spark: SparkSession, path: str, name: str) -> None:
    """Make a bucketed store known to the session's catalogue under a name."""
    known = spark.read.json(f"{path}_layout").first()
    key, buckets = known["key"], known["buckets"]
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A store of :func:`timbrelake.sinks.write_bucketed`, whose joins and groupings by its key need no exchange."""
    name = "store_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # columns or buckets may have changed
    open_bucketed(spark, path, name)
    return spark.table(name)


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Headered tab-separated file with string columns only, so no inference pass is needed."""
    reader = spark.read.option("header", True).option("sep", "\t")
    if columns:
        reader = reader.schema(", ".join(f"`{name}` STRING" for name in columns))
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of headered text files, without the header line of each file, in file order.

    ``position`` orders lines as the files list them: path, offset of the split, then the
    order within the split.
    """
    return (
        spark.read.schema("line STRING, _whole STRING")
        .options(
            header=True, sep=_RARE_SEPARATOR, quote="", enforceSchema=True, mode="PERMISSIVE",
            columnNameOfCorruptRecord="_whole",
        )
        .csv(path)
        .select(
            F.coalesce("_whole", "line").alias("line"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("offset"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("position"),
        )
    )


def _fields(line: Column) -> Column:
    """Tab-separated fields; a field in quotes loses them and may hold tabs."""
    behind_tab = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(_FIELD), F.lit(0))
    bare = F.transform(
        F.transform(behind_tab, lambda f: F.substring(f, 2, 1 << 30)),
        lambda f: F.when(
            f.rlike('(?s)^".*"$') & (F.length(f) > 1),
            F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )
    return F.when(line.contains('"'), bare).otherwise(F.split(line, "\t"))


def header_of(spark: SparkSession, path: str) -> str:
    """Header line of a file or of the first of several files by name."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.groupBy("file_path").agg(F.min("file_block_start")).agg(F.min("file_path")).first()[0]
    return lines.filter((F.col("file_path") == first) & (F.col("file_block_start") == 0)).first()["value"]


def read_catalogue(
    spark: SparkSession, path: str, min_fields: int = MIN_CATALOGUE_FIELDS
) -> DataFrame:
    """Ragged tag catalogue: five fixed fields, the rest of each line as an array of tags.

    The line itself and its position are there as well; unused columns are never computed.
    """
    fixed = len(CATALOGUE_FIELDS)
    fields = F.col("fields")
    columns = [
        fields[i].try_cast("double").alias(name) if name == "DURATION" else fields[i].alias(name)
        for i, name in enumerate(CATALOGUE_FIELDS)
    ]
    return (
        read_lines(spark, path)
        .withColumn("fields", _fields(F.col("line")))
        .filter(F.size("fields") >= min_fields)
        .select(
            *columns,
            F.slice(fields, fixed + 1, F.size(fields) - fixed).alias("tags"),
            "position",
            "line",
        )
    )


def catalogue_paths(
    spark: SparkSession, path: str, field: int = PATH_FIELD, suffix: str = SOURCE_SUFFIX
) -> DataFrame:
    """Path field of every line long enough to have one, with its suffix exchanged."""
    return (
        read_lines(spark, path)
        .withColumn("fields", _fields(F.col("line")))
        .filter(F.size("fields") >= field)
        .select(swap_suffix(F.col("fields")[field - 1], suffix).alias("path"))
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Checksum manifest: ``sha256<blank>name`` per line; a name may hold blanks.

    A line without both parts is an error, as its file would never be verified; empty lines are not.
    """
    parts = F.regexp_extract_all("value", F.lit("^([^ ]+) (.+)$"), F.lit(0))
    wrong = F.raise_error(F.concat(F.lit("not a line of a manifest: "), "value"))
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.select(
        F.when(F.size(parts) == 0, wrong).otherwise(F.substring_index("value", " ", 1)).alias("sha256"),
        F.expr("substring(value, instr(value, ' ') + 1)").alias("name"),
    )


def rows_of(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of Python values as a table (an ad-hoc path, one scored item)."""
    return spark.createDataFrame(list(rows), schema)
