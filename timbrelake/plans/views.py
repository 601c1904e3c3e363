"""The given tables seen as the data sets the operators work on, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.functions.keys import stable_bucket, swap_prefix, swap_suffix
from timbrelake.plans.registry import bucket_sql


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def tracks(spark: SparkSession, root: str) -> DataFrame:
    """Feature rows with one genre each."""
    lines, parts = table(spark, root, "lineitem"), table(spark, root, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "p_brand AS genres",
        "l_quantity * 4 AS tempo",
        "l_extendedprice AS centroid_mean",
        "l_discount AS rms_mean",
        "l_tax AS zcr_mean",
        "l_discount * l_tax AS flatness_mean",
        "-l_extendedprice / 100 AS mfcc_1_mean",
        "l_quantity * 2.5D AS mfcc_2_mean",
        "l_discount * 100 AS mfcc_3_mean",
        "l_tax * 100 - 4 AS mfcc_4_mean",
        "double(l_linenumber) AS mfcc_5_mean",
        "l_quantity AS duration",
        "l_suppkey AS user_id",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS uploaded_at",
    )


TRACKS = """tracks AS (
  SELECT l_orderkey, l_linenumber, p_brand AS genres, l_quantity * 4 AS tempo,
         l_extendedprice AS centroid_mean, l_discount AS rms_mean, l_tax AS zcr_mean,
         l_discount * l_tax AS flatness_mean, -l_extendedprice / 100 AS mfcc_1_mean,
         l_quantity * 2.5 AS mfcc_2_mean, l_discount * 100 AS mfcc_3_mean,
         l_tax * 100 - 4 AS mfcc_4_mean, CAST(l_linenumber AS DOUBLE) AS mfcc_5_mean,
         l_quantity AS duration, l_suppkey AS user_id,
         strftime(l_shipdate, '%Y-%m-%d') AS uploaded_at
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def measures(spark: SparkSession, root: str) -> DataFrame:
    """Feature rows without their genre: a stored table, so repeated passes stay cheap."""
    return table(spark, root, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_quantity * 4 AS tempo",
        "l_extendedprice AS centroid_mean",
        "l_discount AS rms_mean",
        "l_tax AS zcr_mean",
        "l_discount * l_tax AS flatness_mean",
    )


MEASURES = """measures AS (
  SELECT l_orderkey, l_linenumber, l_quantity * 4 AS tempo, l_extendedprice AS centroid_mean,
         l_discount AS rms_mean, l_tax AS zcr_mean, l_discount * l_tax AS flatness_mean
  FROM lineitem)"""


def tagged(spark: SparkSession, root: str) -> DataFrame:
    """Catalogue rows with several tags, some of them without any."""
    parts = table(spark, root, "part")
    padded = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    genres = F.transform(F.split("p_name", " "), lambda word: F.concat(F.lit("genre---"), word))
    mood = F.array(F.concat(F.lit("mood---"), F.lower("p_type")))
    return parts.select(
        F.concat(F.lit("track_"), padded).alias("TRACK_ID"),
        F.concat(F.lit("artist_"), F.col("p_size").cast("string")).alias("ARTIST_ID"),
        F.concat(F.lit("album_"), F.col("p_brand")).alias("ALBUM_ID"),
        F.concat(
            F.pmod("p_partkey", F.lit(100)).cast("string"), F.lit("/"),
            F.col("p_partkey").cast("string"), F.lit(".mp3"),
        ).alias("PATH"),
        F.col("p_retailprice").alias("DURATION"),
        F.when(F.col("p_partkey") % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.concat(genres, mood)).alias("tags"),
        "p_partkey",
    )


TAGGED = """tagged AS (
  SELECT 'track_' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS TRACK_ID,
         'artist_' || CAST(p_size AS VARCHAR) AS ARTIST_ID, 'album_' || p_brand AS ALBUM_ID,
         CAST(p_partkey % 100 AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) || '.mp3' AS PATH,
         p_retailprice AS DURATION,
         CASE WHEN p_partkey % 5 = 0 THEN CAST([] AS VARCHAR[])
              ELSE list_concat(['genre---' || w FOR w IN string_split(p_name, ' ')],
                               ['mood---' || lower(p_type)]) END AS tags,
         p_partkey
  FROM part)"""


def genre_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows with an array of genres (two words of the part name)."""
    return table(spark, root, "part").select(
        "p_partkey", F.split("p_name", " ").alias("genres"), "p_size", "p_retailprice"
    )


GENRE_ROWS = """genre_rows AS (
  SELECT p_partkey, string_split(p_name, ' ') AS genres, p_size, p_retailprice FROM part)"""


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Catalogued source files: one name per page, plus its target name and a done flag."""
    number = F.lpad(F.col("page_id").cast("string"), 7, "0")
    source = F.concat(F.lit("audio/mp3/"), number, F.lit(".low.mp3"))
    return table(spark, root, "pages").select(
        "page_id",
        source.alias("source"),
        swap_suffix(swap_prefix(source, "audio/mp3", "audio/wav"), ".wav").alias("name"),
        (stable_bucket(F.col("page_id"), 100) < 40).alias("is_done"),
    )


LISTING = f"""listing AS (
  SELECT page_id, 'audio/mp3/' || lpad(CAST(page_id AS VARCHAR), 7, '0') || '.low.mp3' AS source,
         'audio/wav/' || lpad(CAST(page_id AS VARCHAR), 7, '0') || '.low.wav' AS name,
         {bucket_sql('page_id', 100)} < 40 AS is_done
  FROM pages)"""


def files(spark: SparkSession, root: str) -> DataFrame:
    """Documents as files with a name and content."""
    return table(spark, root, "documents").select(
        F.col("doc_id").cast("string").alias("name"), F.col("text").alias("content"), "doc_id"
    )


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Checksums of most files; every 50th is wrong."""
    digest = F.sha2("content", 256)
    return (
        files(spark, root)
        .filter(F.col("doc_id") % 7 != 3)
        .select(
            "name",
            F.when(F.col("doc_id") % 50 == 0, F.reverse(digest)).otherwise(digest).alias("sha256"),
        )
    )


FILES = """files AS (
  SELECT CAST(doc_id AS VARCHAR) AS name, text AS content, doc_id FROM documents),
manifest AS (
  SELECT name, CASE WHEN doc_id % 50 = 0 THEN reverse(sha256(content)) ELSE sha256(content) END
         AS sha256
  FROM files WHERE doc_id % 7 <> 3)"""


def signals(spark: SparkSession, root: str, rate: int = 16000) -> DataFrame:
    """Embedding vectors as short signals."""
    return table(spark, root, "embeddings").select(
        "vec_id",
        F.lit(rate).alias("sr"),
        F.col("embedding").cast("array<double>").alias("samples"),
    )


def vectors(spark: SparkSession, root: str) -> DataFrame:
    """Embedding vectors as a table of 64 numeric features with a single genre."""
    return table(spark, root, "embeddings").selectExpr(
        "vec_id",
        "concat('genre', label) AS genre",
        *[f"double(get(embedding, {i})) AS x{i}" for i in range(64)],
    )


def scored_documents(spark: SparkSession, root: str) -> DataFrame:
    """Labelled documents with a score and a prediction that follow from their length."""
    documents, labels = table(spark, root, "documents"), table(spark, root, "labels")
    score = F.least(F.col("n_chars") / 100, F.lit(50.0)) / 50
    return documents.select("doc_id", "n_chars").join(labels, "doc_id").select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        score.alias("score"),
        (score > 0.2).cast("double").alias("prediction"),
    )


SCORED = """scored AS (
  SELECT doc_id, CAST(quality AS DOUBLE) AS label, least(n_chars / 100.0, 50.0) / 50 AS score,
         CAST(least(n_chars / 100.0, 50.0) / 50 > 0.2 AS INTEGER) AS prediction
  FROM documents JOIN labels USING (doc_id))"""


WAV_RATE = 16_000


def wav_files(spark: SparkSession, root: str) -> DataFrame:
    """Vectors as 16-bit PCM WAV files, built from bytes by Spark: path, content."""

    def little(value, size):
        part = "lpad(hex(shiftright({v}, {s}) & 255), 2, '0')"
        return " || ".join(part.format(v=value, s=8 * i) for i in range(size))

    size = "2 * size(q)"
    header = " || ".join([
        "'52494646'", little(f"(36 + {size})", 4), "'57415645666D7420'", little("16", 4), little("1", 2), little("1", 2),
        little(str(WAV_RATE), 4), little(str(2 * WAV_RATE), 4), little("2", 2), little("16", 2), "'64617461'", little(f"({size})", 4),
    ])
    quantised = table(spark, root, "embeddings").selectExpr(
        "vec_id", "transform(embedding, x -> int(floor(double(x) * 8192))) AS q"
    )
    samples = f"array_join(transform(q, v -> {little('v', 2)}), '')"
    return quantised.selectExpr(
        "vec_id", "'store/set ' || (vec_id % 7) || '/' || vec_id || '.wav' AS path",
        f"unhex({header} || {samples}) AS content",
    )
