"""WARC archives as a chunked record table: oversized payloads are segments, digests run along."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.session import ship_package

VERSION = "WARC/1.1"
END = "\r\n\r\n"
#: Between records. No block holds the second part, so records can be told apart from any place.
FIRST = f"{VERSION}\r\n"
MARK = END + FIRST
#: Characters of a payload in one record; longer ones are segmented.
CHUNK = 1 << 16
DATE = "2000-01-01T00:00:00Z"
#: Payloads of fewer bytes are never revisits.
LEAST = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decide(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds to ``record, page_id, payload`` its bytes, SHA-1, type and the record it refers to.

    Of equal payloads of ``least`` bytes or more the one with the greatest page_id (then record)
    is the response, the others are revisits. Digest and size stand for a payload; only they are
    grouped, partially aggregated, so a payload that a third of all pages share is one row a task.
    """
    sized = pages.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    large = sized.where(F.col("bytes") >= least).select("sha1", "bytes", "page_id", "record")
    first = large.groupBy("sha1", "bytes").agg(F.max(F.struct("page_id", "record")).alias("first"))
    joined = sized.join(first.where("first is not null"), ["sha1", "bytes"], "left")
    revisit = F.col("first").isNotNull() & (F.col("first.record") != F.col("record"))
    return joined.select(
        "record", "page_id", "url", "payload", "bytes", "sha1", revisit.alias("revisit"),
        F.when(revisit, F.col("first.page_id")).alias("refers_page"), F.when(revisit, F.col("first.record")).alias("refers_record"),
    )


def _id(record: Column, segment: Column | None = None) -> Column:
    """A record's name: a UUID from its number (and segment)."""
    digest = F.md5(F.concat_ws("/", record, *([] if segment is None else [segment])).cast("binary"))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def chunk_table(decided: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each record and chunk number: ``segment`` from 1 to ``segments``, and ``chunk``.

    Chunks are cut between characters after ``chunk`` of them, and within anything that reads
    like the first line of a record. Revisits have one empty chunk.
    """
    body = F.when(F.col("revisit"), "").otherwise(F.col("payload"))
    parts = F.when(body.contains(FIRST), F.split(body, "(?<=W)(?=ARC/1\\.1\r\n)", -1)).otherwise(F.array(body))
    pattern = F.lit("(?s).{1,%d}" % chunk)
    cut = F.flatten(F.transform(parts, lambda p: F.when(F.length(p) <= chunk, F.array(p)).otherwise(F.regexp_extract_all(p, pattern, F.lit(0)))))
    rows = decided.withColumn("chunks", cut).withColumn("segments", F.size("chunks")).drop("payload")
    return rows.select("*", F.posexplode("chunks").alias("at", "chunk")).withColumn("segment", F.col("at") + 1).drop("at", "chunks")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record_text(chunks: DataFrame) -> DataFrame:
    """``value``: each chunk as a WARC record, without the blank lines that end it."""
    first, last, many = F.col("segment") == 1, F.col("segment") == F.col("segments"), F.col("segments") > 1
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END))
    block = F.when(first, F.concat(http, "chunk")).otherwise(F.col("chunk"))
    kind = F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    head = F.concat(
        F.lit(FIRST), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, _id(F.col("record"))).otherwise(_id(F.col("record"), F.col("segment")))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.translate(F.col("url"), "\r\n", "  ")),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "sha1"))),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _id(F.col("refers_record")))),
        _field("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        _field("WARC-Segment-Number", F.when(many, F.col("segment"))),
        _field("WARC-Segment-Origin-ID", F.when(~first, _id(F.col("record")))),
        _field("WARC-Segment-Total-Length", F.when(many & last, F.col("bytes") + F.octet_length(http))),
        _field("X-Page-ID", F.when(first, F.col("page_id"))),
        _field("X-Refers-To-Page-ID", F.col("refers_page")),
        _field("Content-Type", F.when(first, "application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block),
    )
    return chunks.select(F.concat(head, F.lit(END), block).alias("value"))


def write(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write a WARC record for each row of ``page_id, url, html`` as gzipped archives below ``path``.

    A null html is an empty payload, a null url or page_id leaves its field out. Extra columns are
    ignored. Equal rows are records of their own, of which one is the response. ``pages`` has to
    give the same rows in the same partitions whenever it is read, as a written table does.
    """
    named = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).alias("payload"),
    )
    texts = record_text(chunk_table(decide(named), chunk))
    texts.write.option("lineSep", END).option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of archives that :func:`write` made, a row for each record.

    Columns: ``origin`` (record that the chunk belongs to), ``segment``, ``total`` (null but in
    the last of several segments), ``type``, ``page_id``, ``refers_to``, ``bytes`` and ``digest``
    as stated (null in continuations), ``chunk`` (binary). No row is longer than one record.
    """
    raw = spark.read.option("lineSep", MARK).text(path).where("value <> ''")
    text = F.when(F.col("value").startswith(FIRST), F.expr(f"substring(value, {len(FIRST) + 1})")).otherwise(F.col("value"))
    split = raw.select(text.alias("text")).withColumn("head", F.substring_index("text", END, 1))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", f"(?m)^{name}: ([^\\r\\n]*)", 1)
        return F.when(found != "", found)

    rest = F.expr(f"substring(text, length(head) + {len(END) + 1})")
    out = split.withColumn("rest", rest).withColumn("size", field("Content-Length").cast("int"))
    parsed = out.select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("segment"),
        field("WARC-Segment-Number").isNotNull().alias("segmented"),
        field("WARC-Segment-Total-Length").cast("long").alias("total"), field("WARC-Type").alias("type"),
        field("X-Page-ID").cast("long").alias("page_id"), field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"), "rest", "size",
    )
    http = F.when(F.col("type") != "continuation", F.substring_index("rest", END, 1))
    stated = F.regexp_extract(http, "(?m)^Content-Length: ([0-9]+)", 1)
    skip = F.coalesce(F.octet_length(http) + len(END), F.lit(0))
    return parsed.select(
        "origin", "segment", "segmented", "total", "type", "page_id", "refers_to", F.when(stated != "", stated).cast("long").alias("bytes"),
        "digest", F.substring(F.col("rest").cast("binary"), skip + 1, F.col("size") - skip).alias("chunk"),
    )


def running_digests(chunks: DataFrame) -> DataFrame:
    """``origin, segment, upto, digest``: bytes and SHA-1 of each record up to each of its chunks.

    Chunks are sorted by record and number within partitions and pass one by one; what is carried
    from one to the next is the state of the digest, so no record is ever held as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, state, upto = None, None, 0
        for batch in batches:
            rows = []
            for name, segment, chunk in zip(*(batch.column(c) for c in ("origin", "segment", "chunk"))):
                if name.as_py() != origin:
                    origin, state, upto = name.as_py(), hashlib.sha1(), 0
                data = chunk.as_buffer()
                state.update(data)
                upto += data.size
                rows.append((origin, segment.as_py(), upto, state.hexdigest()))
            if rows:
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["origin", "segment", "upto", "digest"])

    ship_package(chunks.sparkSession)
    ordered = chunks.select("origin", "segment", "chunk").repartition("origin").sortWithinPartitions("origin", "segment")
    return ordered.mapInArrow(run, "origin string, segment int, upto long, digest string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record in the archives.

    Responses are measured and digested as they are read, segmented ones from their chunks in
    order; revisits state bytes and digest of the payload that they refer to. A response whose
    payload differs from its stated digest ends the job with an error.
    """
    chunks = read_chunks(spark, path)
    whole = chunks.where("not segmented").select(
        "page_id", "bytes", "digest", "type", "refers_to",
        F.when(F.col("type") == "response", F.octet_length("chunk").cast("long")).alias("seen_bytes"),
        F.when(F.col("type") == "response", F.sha1("chunk")).alias("seen_digest"),
    )
    parts = chunks.where("segmented")
    ends = running_digests(parts).groupBy("origin").agg(F.max_by(F.struct("upto", "digest"), "segment").alias("end"))
    first = parts.where("segment = 1").select("origin", "page_id", "bytes", "digest", "type", "refers_to")
    joined = first.join(ends, "origin").select(
        "page_id", "bytes", "digest", "type", "refers_to", F.col("end.upto").alias("seen_bytes"), F.col("end.digest").alias("seen_digest")
    )
    bad = (F.col("type") == "response") & ((F.col("seen_digest") != F.col("digest")) | (F.col("seen_bytes") != F.col("bytes")))
    digest = F.when(bad, F.raise_error(F.lit("a payload differs from its digest"))).otherwise(F.coalesce("seen_digest", "digest"))
    return whole.union(joined).select(
        "page_id", F.coalesce("seen_bytes", "bytes").alias("payload_bytes"), digest.alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
