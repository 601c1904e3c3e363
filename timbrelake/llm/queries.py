"""Registered queries of the numbered operators, over whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.llm import alignment, decontamination, licenses, line_dedup, mixing, near_dedup, packing, periodic_runs, pii, sharding, topk_search, toxicity, warc
from timbrelake.llm.text import arrow_map, slices
from timbrelake.session import scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its own name."""

    def register(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer)


@query()
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that stand in an earlier place already."""
    kept = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "removed_chunks", "removed_words")


@query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


@query()
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose numbers of rows differ by one at most."""
    placed = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", sharding.text_size(F.col("text")).alias("size"), sharding.text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    s AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest, html FROM p),
    f AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM s)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND top <> page_id THEN top END AS refers_to
    FROM f
    """
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path)


@query(
    """
    WITH raw AS (
        SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS d
        FROM embeddings WHERE embedding IS NOT NULL
    ),
    parts AS (SELECT vec_id, d, CAST(floor(64 * x) AS BIGINT) AS x FROM raw),
    scores AS (
        SELECT q.vec_id AS query_id, p.vec_id, CAST(sum(q.x * p.x) AS BIGINT) AS score
        FROM parts q JOIN parts p ON q.d = p.d AND q.vec_id <> p.vec_id
        WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """
)
def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every twentieth one."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


@query(
    r"""
    WITH d AS (
        SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
    ),
    named AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
        FROM d GROUP BY source
    ),
    weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS bound FROM named),
    shared AS (
        SELECT (sum(source_size) OVER () - coalesce(sum(bound) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM weighed WINDOW w AS (ORDER BY bound::DOUBLE / weight, place)
    ),
    aimed AS (
        SELECT source, source_size, least(bound::DOUBLE, (SELECT max(level) FROM shared) * weight) AS target,
               CAST(concat('0x', substr(md5(concat('29:', coalesce(concat('=', source), ''))), 1, 5)) AS BIGINT) AS start
        FROM weighed
    ),
    steps AS (
        SELECT *, least(CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * 1048576 + 0.5) AS BIGINT), 3145728) AS step
        FROM aimed
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, md5(CAST(doc_id AS VARCHAR))) - 1 AS at FROM d
    )
    SELECT r.doc_id, r.size, s.source_size, s.target,
           r.size * ((((r.at + 1) * s.step + s.start) >> 20) - ((r.at * s.step + s.start) >> 20)) AS taken
    FROM ranked r JOIN steps s ON r.source IS NOT DISTINCT FROM s.source
    """
)
def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources by weight takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("words"))
    drawn = mixing.copies(docs, F.col("words"), order=F.md5(F.col("doc_id").cast("string").cast("binary")))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; the words of every tenth document by hash repeat with a period from some word on."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, texts in slices(batch):
            ids = batch.column("doc_id").slice(start, len(texts))
            made = [periodic(i, t) for i, t in zip(ids.to_pylist(), texts)]
            yield pa.record_batch([ids, pa.array(made, pa.string())], ["doc_id", "text"])

    ship_package(docs.sparkSession)
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of, "doc_id long, text string")


def periodic(doc_id: int | None, text: bytes) -> bytes:
    """The text whose words from a on repeat the first p of them, where the hash of doc_id says so."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return text
    words, g = text.split(), h // 10
    if not words:
        return text
    first = g % len(words)
    rest = len(words) - first
    p = 1 + rest // (3 + g % 8)
    return b" ".join(words[:first] + (words[first : first + p] * (rest // p + 1))[:rest])


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without their repeated parts."""
    rows = periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    longer = lambda best, run: best.isNull() | (run.length * best.period > best.length * run.period)
    best = F.aggregate("runs", none, lambda best, run: F.when(longer(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document."""
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    measured = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), *files)
    return measured.select("doc_id", *alignment.MEASURES, "groups_sha256")
