"""Keys, tags, paths, joins and catalogue work."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.constants import FILE_KEY_PATTERN
from timbrelake.functions import keys
from timbrelake.operators import catalogue, joins, ordering
from timbrelake.operators.learning import label_indexer
from timbrelake.plans import views
from timbrelake.plans.registry import bucket_sql, query
from timbrelake.session import scratch_path

# --- scalar functions -----------------------------------------------------------------------


@query("""SELECT c_custkey, TRY_CAST(regexp_extract(c_name, 'Customer#0*([0-9]+)$', 1) AS INTEGER)
  AS num, TRY_CAST(regexp_extract(c_mktsegment, '([0-9]+)$', 1) AS INTEGER) AS none
FROM customer""")
def regex_key(spark, root):
    return views.table(spark, root, "customer").select(
        "c_custkey",
        keys.numeric_key(F.col("c_name"), "Customer#0*([0-9]+)$").alias("num"),
        keys.numeric_key(F.col("c_mktsegment"), "([0-9]+)$").alias("none"),
    )


@query(f"""WITH {views.TAGGED},
joined AS (SELECT p_partkey, array_to_string(tags, chr(9)) AS t FROM tagged)
SELECT p_partkey, array_to_string(regexp_extract_all(t, 'genre---([^\\t]+)', 1), '|') AS genres,
       array_to_string(regexp_extract_all(t, 'genre---([^\\t\\s]+)', 1), '|') AS compact
FROM joined""")
def regex_all(spark, root):
    from timbrelake.constants import TAG_PATTERN_NO_SPACE

    text = F.concat_ws("\t", "tags")
    return views.tagged(spark, root).select(
        "p_partkey",
        F.array_join(keys.tag_values(text), "|").alias("genres"),
        F.array_join(keys.tag_values(text, TAG_PATTERN_NO_SPACE), "|").alias("compact"),
    )


_STRIPPED = "[substr(t, 9) FOR t IN tags IF starts_with(t, 'genre---')]"


@query(f"""WITH {views.TAGGED}
SELECT p_partkey, {_STRIPPED}[1] AS first, array_to_string({_STRIPPED}, '|') AS every,
       array_to_string(list_sort(list_distinct({_STRIPPED})), '|') AS once
FROM tagged""")
def tag_prefix(spark, root):
    tags = F.col("tags")
    return views.tagged(spark, root).select(
        "p_partkey",
        keys.first_genre(tags).alias("first"),
        F.array_join(keys.genre_tags(tags), "|").alias("every"),
        F.array_join(F.sort_array(keys.genre_set(tags)), "|").alias("once"),
    )


@query(f"""WITH {views.TAGGED} SELECT p_partkey, unnest(tags) AS tag FROM tagged""")
def explode_tags(spark, root):
    return views.tagged(spark, root).select("p_partkey", F.explode("tags").alias("tag"))


@query(f"WITH {views.TAGGED} SELECT p_partkey, tags[1] AS tag FROM tagged")
def first_tag(spark, root):
    return views.tagged(spark, root).select("p_partkey", keys.first_of(F.col("tags")).alias("tag"))


@query(f"""WITH {views.GENRE_ROWS}
SELECT p_partkey, CAST(list_contains(genres, 'red') AS DOUBLE) AS red,
       CAST(list_contains(genres, 'ring') AS DOUBLE) AS ring FROM genre_rows""")
def tag_indicator(spark, root):
    genres = F.col("genres")
    return views.genre_rows(spark, root).select(
        "p_partkey",
        keys.tag_indicator(genres, "red").alias("red"),
        keys.tag_indicator(genres, "ring").alias("ring"),
    )


@query("""SELECT event_id, coalesce(CASE WHEN event_type <> 'click' THEN value END, 0) AS value,
       CASE WHEN event_type <> 'view' THEN event_type END AS kind
FROM events""")
def fill_zero(spark, root):
    """Missing numbers become 0, missing strings stay missing."""
    kind = F.col("event_type")
    return views.table(spark, root, "events").select(
        "event_id",
        F.when(kind != "click", F.col("value")).alias("value"),
        F.when(kind != "view", kind).alias("kind"),
    ).na.fill(0)


@query(f"""WITH {views.LISTING}
SELECT source, split_part(source, '/', -1) AS filename,
       'audio/wav/' || regexp_replace(source, '^audio/mp3/', '') AS moved,
       regexp_replace(source, '\\.mp3$', '.wav') AS suffixed,
       replace(split_part(source, '/', -1), '.low.mp3', '') AS stem,
       regexp_matches(replace(split_part(source, '/', -1), '.low.mp3', ''), '^[0-9]+$')
       AS numeric
FROM listing""")
def path_functions(spark, root):
    source = F.col("source")
    stem = F.replace(keys.basename(source), F.lit(".low.mp3"), F.lit(""))
    return views.listing(spark, root).select(
        "source",
        keys.basename(source).alias("filename"),
        keys.swap_prefix(source, "audio/mp3", "audio/wav").alias("moved"),
        keys.swap_suffix(source, ".wav").alias("suffixed"),
        stem.alias("stem"),
        keys.is_digits(stem).alias("numeric"),
    )


@query("""SELECT page_id, split_part(rest, '/', 1) AS bucket,
       regexp_replace(rest, '^[^/]*/?', '') AS key, '/' || rest AS local
FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS rest FROM pages)""")
def uri_split(spark, root):
    url = F.col("url")
    return views.table(spark, root, "pages").select(
        "page_id",
        keys.split_uri(url)["bucket"].alias("bucket"),
        keys.split_uri(url)["key"].alias("key"),
        keys.strip_scheme(url).alias("local"),
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso,
       coalesce(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END,
                DATE '2024-02-29') AS day
FROM orders""")
def date_coerce(spark, root):
    moment = F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate"))
    return views.table(spark, root, "orders").select(
        "o_orderkey",
        keys.iso_date(F.col("o_orderdate")).alias("iso"),
        keys.coerce_date(moment, dt.date(2024, 2, 29)).alias("day"),
    )


@query("""SELECT vec_id, len(embedding) / CAST(16000 AS DOUBLE) AS duration,
       CASE WHEN label > 0 THEN len(embedding) / CAST(label AS DOUBLE) END AS odd
FROM embeddings""")
def signal_duration(spark, root):
    return views.table(spark, root, "embeddings").select(
        "vec_id",
        keys.duration_seconds(F.size("embedding"), F.lit(16000)).alias("duration"),
        keys.duration_seconds(F.size("embedding"), F.col("label")).alias("odd"),
    )


@query(f"SELECT o_orderkey, {bucket_sql('o_orderkey', 6)} AS user_id FROM orders")
def assign_user(spark, root):
    orders = views.table(spark, root, "orders")
    return orders.select("o_orderkey", keys.assign_user(F.col("o_orderkey")).alias("user_id"))


# --- joins ----------------------------------------------------------------------------------


_ENRICHED = """WITH features AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'broken'
         ELSE 'data/' || CAST(o_custkey AS VARCHAR) || '.low.wav' END AS path FROM orders),
keyed AS (SELECT *, TRY_CAST(regexp_extract(path, '([^/]+)\\.low\\.wav$', 1) AS INTEGER)
          AS track_num FROM features),
meta AS (SELECT 'track_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS TRACK_ID,
                c_name AS meta_path, CAST(c_custkey AS INTEGER) AS track_num,
                lower(c_mktsegment) || '|s' || CAST(c_nationkey AS VARCHAR) AS genres
         FROM customer)
SELECT track_num, o_orderkey, path, TRACK_ID, meta_path, genres FROM keyed JOIN meta
USING (track_num)"""


@query(_ENRICHED)
def enrich_join(spark, root):
    features, metadata = _features_and_metadata(spark, root)
    return joins.enrich(features, metadata).withColumn("genres", F.array_join("genres", "|"))


@query(_ENRICHED)
def enrich_bucketed(spark, root):
    """The same join from a feature store bucketed by the key, which is read without an exchange."""
    features, metadata = _features_and_metadata(spark, root)
    path = scratch_path(spark, "store")
    half = F.col("o_orderkey") % 2 == 0
    sinks.write_bucketed(features.filter(half), path, "track_num")
    sinks.write_bucketed(features.filter(~half), path, "track_num", append=True)
    joined = joins.enrich(sources.read_bucketed(spark, path), metadata)
    return joined.withColumn("genres", F.array_join("genres", "|"))


def _features_and_metadata(spark, root):
    path = F.concat(F.lit("data/"), F.col("o_custkey").cast("string"), F.lit(".low.wav"))
    features = views.table(spark, root, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, "broken").otherwise(path).alias("path")
    )
    metadata = views.table(spark, root, "customer").select(
        F.concat(F.lit("track_"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
        .alias("TRACK_ID"),
        F.col("c_name").alias("PATH"),
        F.concat(
            F.lit("genre---"), F.lower("c_mktsegment"),
            F.lit("\tgenre---s"), F.col("c_nationkey").cast("string"),
        ).alias("TAGS"),
    )
    return joins.keyed_features(features, pattern=FILE_KEY_PATTERN), joins.keyed_metadata(metadata)


@query(f"WITH {views.LISTING} SELECT name, source FROM listing WHERE NOT is_done")
def pending_antijoin(spark, root):
    names = views.listing(spark, root)
    mapped = names.select(
        keys.swap_suffix(
            keys.swap_prefix(F.col("source"), "audio/mp3", "audio/wav"), ".wav"
        ).alias("name"),
        "source",
    )
    return joins.pending(mapped, names.filter("is_done"), "name")


@query(f"""WITH {views.FILES}
SELECT name, sha256(content) AS actual, sha256 AS expected
FROM files JOIN manifest USING (name) WHERE sha256(content) <> sha256""")
def checksum_verify(spark, root):
    return joins.checksum_mismatches(views.files(spark, root), views.manifest(spark, root))


@query(f"""WITH {views.FILES}
SELECT name, doc_id, length(content) AS size FROM files
WHERE name IN (SELECT name FROM manifest)""")
def manifest_semijoin(spark, root):
    files = views.files(spark, root).select(
        "name", "doc_id", F.length("content").cast("bigint").alias("size")
    )
    return joins.listed(files, views.manifest(spark, root), "name")


@query("""WITH names AS (
  SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx
  FROM documents GROUP BY lang)
SELECT doc_id, CAST(doc_id % 5 AS INTEGER) AS prediction, names.lang AS label
FROM documents LEFT JOIN names ON doc_id % 5 = idx""")
def label_lookup(spark, root):
    """Labels of predicted indices; an index without a label gives NULL."""
    documents = views.table(spark, root, "documents").select("doc_id", "lang")
    labels = label_indexer("lang").fit(documents).labels
    predictions = documents.select(
        "doc_id", (F.col("doc_id") % 5).cast("int").alias("prediction")
    )
    return joins.resolve_labels(predictions, labels, "prediction")


# --- catalogue ------------------------------------------------------------------------------


@query(f"""WITH {views.TAGGED},
words AS (SELECT unnest({_STRIPPED}) AS genre FROM tagged)
SELECT genre, count(*) AS "count" FROM words GROUP BY genre ORDER BY "count" DESC, genre
LIMIT 10""")
def top_tags(spark, root):
    return catalogue.top_tags(views.tagged(spark, root), n=10)


_WANTED = ["red", "blue", "ring", "widget", "bolt"]
_WANTED_SQL = ", ".join(f"'{word}'" for word in _WANTED)


@query(f"""WITH {views.TAGGED},
hits AS (SELECT p_partkey, [w FOR w IN list_distinct({_STRIPPED}) IF w IN ({_WANTED_SQL})] AS m
         FROM tagged),
words AS (SELECT unnest(m) AS genre FROM hits)
SELECT genre, count(*) AS "count", (SELECT count(*) FROM hits WHERE len(m) > 0) AS kept
FROM words GROUP BY genre""")
def wanted_tag_repartition(spark, root):
    return catalogue.wanted_repartition(views.tagged(spark, root), wanted=_WANTED)


@query(f"""WITH {views.TAGGED},
placed AS (SELECT p_partkey, TRACK_ID, {_STRIPPED}[1] AS genre,
                  row_number() OVER (PARTITION BY {_STRIPPED}[1] ORDER BY p_partkey) AS place
           FROM tagged)
SELECT p_partkey, TRACK_ID, genre FROM placed WHERE genre IN ({_WANTED_SQL}) AND place <= 25""")
def cap_per_class(spark, root):
    tagged = views.tagged(spark, root).select("p_partkey", "TRACK_ID", "tags")
    kept = catalogue.cap_first_genre(tagged, "p_partkey", wanted=_WANTED, cap=25)
    return kept.drop("tags")


@query(f"""WITH {views.LISTING}
SELECT count(*) AS found, count(*) FILTER (is_done) AS done,
       count(*) FILTER (NOT is_done) AS pending,
       count(*) FILTER (NOT is_done AND page_id % 3 = 0) AS failed,
       count(*) FILTER (NOT is_done AND page_id % 3 <> 0) AS extracted
FROM listing""")
def run_accounting(spark, root):
    names = views.listing(spark, root)
    results = names.filter(~F.col("is_done")).select(
        "name", (F.col("page_id") % 3 != 0).cast("int").alias("ok")
    )
    return catalogue.run_accounting(names, names.filter("is_done"), results, "name")


@query("""SELECT url, CAST(floor((row_number() OVER (ORDER BY url) - 1) / 20) AS BIGINT)
  AS batch_id FROM pages""")
def batch_assign(spark, root):
    return ordering.assign_batches(views.table(spark, root, "pages").select("url"), "url", size=20)


@query("""WITH numbered AS (
  SELECT o_orderkey, o_totalprice,
         row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders)
SELECT o_orderkey, o_totalprice FROM numbered WHERE place % 4 = 1""")
def shard_slice(spark, root):
    orders = views.table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return ordering.shard_slice(
        orders, F.desc("o_totalprice"), "o_orderkey", shard=1, shards=4
    )
