"""Sources and sinks: data is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.functions.keys import stable_bucket
from timbrelake.operators.joins import listed
from timbrelake.operators.ordering import shard_index
from timbrelake.plans import views
from timbrelake.plans.registry import bucket_sql, query
from timbrelake.session import scratch_path


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_parquet(spark, root):
    lines = sources.read_dataset(spark, f"{root}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def scan_tsv(spark, root):
    path = scratch_path(spark, "tsv")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    sinks.write_tsv(views.table(spark, root, "customer").select(*columns), path)
    return sources.read_tsv(spark, path, columns)


def _catalogue(spark, root, label):
    path = scratch_path(spark, label)
    sinks.write_catalogue(views.tagged(spark, root), path)
    return path


@query(f"""WITH {views.TAGGED}
SELECT TRACK_ID, ARTIST_ID, ALBUM_ID, PATH, DURATION, CAST(len(tags) AS INTEGER) AS n_tags,
       array_to_string(tags, '|') AS tags
FROM tagged WHERE len(tags) > 0""")
def scan_ragged_tsv(spark, root):
    rows = sources.read_catalogue(spark, _catalogue(spark, root, "ragged"))
    return rows.select(
        "TRACK_ID", "ARTIST_ID", "ALBUM_ID", "PATH", "DURATION",
        F.size("tags").alias("n_tags"), F.concat_ws("|", "tags").alias("tags"),
    )


@query(f"""WITH {views.TAGGED}
SELECT regexp_replace(PATH, '\\.mp3$', '.low.mp3') AS path FROM tagged""")
def catalogue_paths(spark, root):
    return sources.catalogue_paths(spark, _catalogue(spark, root, "paths"))


@query("SELECT source, CAST(count(*) AS BIGINT) AS docs FROM documents GROUP BY source")
def scan_binary_files(spark, root):
    """Lists the files of a partitioned data set, then counts the rows of the listed ones."""
    path = scratch_path(spark, "files")
    documents = views.table(spark, root, "documents").select("doc_id", "source")
    sinks.append_partitioned(documents, path, "source")
    found = sources.list_files(spark, path, "*.parquet").select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"),
        F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source"),
    )
    rows = sources.read_dataset(spark, path).select(
        F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"), "doc_id"
    )
    per_file = rows.groupBy("path").agg(F.count("*").alias("docs"))
    return found.join(per_file, "path").groupBy("source").agg(F.sum("docs").alias("docs"))


@query("""SELECT url FROM pages WHERE starts_with(url, 'http://') AND ends_with(url, '.html')
UNION ALL SELECT url FROM pages WHERE starts_with(url, 'https://') AND ends_with(url, '#top')""")
def list_by_prefix(spark, root):
    pages = views.table(spark, root, "pages").select("url")
    plain = sources.list_by_prefix(pages, "url", "http://", ".html")
    return plain.union(sources.list_by_prefix(pages, "url", "https://", "#top"))


@query("""SELECT sha256(text) AS sha256, 'part ' || CAST(doc_id AS VARCHAR) || ' of  all.tar' AS name
FROM documents""")
def scan_manifest(spark, root):
    """Names with single and double blanks are read back whole."""
    path = scratch_path(spark, "manifest")
    name = F.concat(F.lit("part "), "name", F.lit(" of  all.tar"))
    lines = views.files(spark, root).select(F.concat_ws(" ", F.sha2("content", 256), name))
    lines.write.text(path)
    return sources.read_manifest(spark, path)


@query(f"""WITH {views.LISTING},
drawn AS (SELECT source, row_number() OVER (ORDER BY md5('42' || source), source) AS place,
                 count(*) OVER () AS n FROM listing)
SELECT source FROM drawn WHERE place <= greatest(1, CAST(floor(n * 0.05) AS BIGINT))""")
def sample_files(spark, root):
    return sources.sample_names(views.listing(spark, root), "source")


@query("""SELECT url, page_id FROM pages
WHERE url IN (SELECT min(url) FROM pages UNION ALL SELECT max(url) FROM pages)""")
def single_row_source(spark, root):
    """Ad-hoc rows made from Python values, matched with the stored ones."""
    pages = views.table(spark, root, "pages").select("url", "page_id")
    ends = pages.agg(F.min("url"), F.max("url")).first()
    return listed(pages, sources.rows_of(spark, [(url,) for url in ends], "url STRING"), "url")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def sink_overwrite(spark, root):
    path = scratch_path(spark, "overwrite")
    orders = views.table(spark, root, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    sinks.overwrite(orders, path)
    sinks.overwrite(orders.filter(F.col("o_orderstatus") == "F"), path)
    return sources.read_dataset(spark, path)


@query(f"SELECT page_id, {bucket_sql('page_id', 8)} AS batch_id FROM pages")
def sink_partitioned_append(spark, root):
    """Two appends into one partitioned data set, all of it read back."""
    path = scratch_path(spark, "partitioned")
    pages = views.table(spark, root, "pages").select(
        "page_id", stable_bucket(F.col("page_id"), 8).alias("batch_id")
    )
    for low in (True, False):
        part = pages.filter((F.col("batch_id") < 4) == low)
        sinks.append_partitioned(part, path, "batch_id")
    return sources.read_dataset(spark, path)


@query("""SELECT 'page' || CAST(page_id AS VARCHAR) AS filename, length(html) AS size,
       CAST(count(*) OVER () AS BIGINT) AS tracks
FROM pages WHERE page_id % 4 <> 0""")
def history_append(spark, root):
    """Good rows appended in two steps, failures left out, with the size of the history."""
    path = scratch_path(spark, "history")
    pages = views.table(spark, root, "pages").select(
        F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("filename"),
        F.length("html").cast("bigint").alias("size"),
        (F.col("page_id") % 4 != 0).cast("int").alias("ok"),
        "page_id",
    )
    for odd in (0, 1):
        sinks.append_history(pages.filter(F.col("page_id") % 2 == odd).drop("page_id"), path)
    history = sources.read_dataset(spark, path)
    return history.withColumn("tracks", history.agg(F.count("*")).scalar())


@query("SELECT page_id, url FROM pages")
def sink_shards(spark, root):
    """One sort gives every row its shard; all shards are written at once and read as one."""
    base = scratch_path(spark, "shards")
    pages = views.table(spark, root, "pages").select("page_id", "url")
    sinks.write_shards(shard_index(pages, "url", shards=3), base)
    return sources.read_dataset(spark, base).select("page_id", "url")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier
WHERE s_acctbal > 0""")
def sink_tsv(spark, root):
    path = scratch_path(spark, "kept")
    kept = views.table(spark, root, "supplier").filter(F.col("s_acctbal") > 0)
    sinks.write_tsv(kept.select("s_suppkey", "s_name"), path)
    return sources.read_tsv(spark, path)
