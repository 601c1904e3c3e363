"""Corpus pipeline: from raw documents to packed training sequences, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.llm import decontamination, line_dedup, packing, similar, toxicity
from timbrelake.session import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not call toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in an earlier place; ``n_chars`` follows the text."""
    kept = line_dedup.deduplicate_lines(docs)
    if "n_chars" in docs.columns:
        size = F.when(F.col("removed_chunks") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with similar five-word shingles."""
    return similar.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


#: (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Hashed word runs, learned weights and tokenizers are beyond SQL; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
