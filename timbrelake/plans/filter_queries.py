"""Projections, filters, schema-driven choices, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.operators import filters, joins
from timbrelake.operators.filters import Selection
from timbrelake.operators.profile import group_profile, group_zscore
from timbrelake.operators.profile import summary_table as summary
from timbrelake.plans import views
from timbrelake.plans.profile_queries import PROFILE, ZSCORE
from timbrelake.plans.registry import query
from timbrelake.session import scratch_path


@query("""SELECT c_custkey AS id, c_name AS title, c_acctbal * 2 AS doubled, 3005 AS fixed
FROM customer""")
def project_alias(spark, root):
    return (
        views.table(spark, root, "customer")
        .withColumn("fixed", F.lit(3005))
        .withColumn("doubled", F.col("c_acctbal") * 2)
        .withColumnsRenamed({"c_custkey": "id", "c_name": "title"})
        .drop("c_nationkey", "c_acctbal", "c_mktsegment")
    )


@query("""SELECT event_id, event_type AS kind, value, user_id % 6 AS user_id FROM events""")
def struct_expand(spark, root):
    packed = F.struct(
        F.col("event_type").alias("kind"), "value", (F.col("user_id") % 6).alias("user_id")
    )
    return views.table(spark, root, "events").select("event_id", packed.alias("f")).select(
        "event_id", "f.*"
    )


@query(f"""WITH {views.GENRE_ROWS}
SELECT p_partkey, unnest(genres) AS genres FROM genre_rows
UNION ALL SELECT p_partkey, p_brand FROM part""")
def normalise_genre(spark, root):
    """Both layouts: an array of genres is exploded, a single genre renamed."""
    many = filters.normalise_genre(views.genre_rows(spark, root).select("p_partkey", "genres"))
    single = views.table(spark, root, "part").select("p_partkey", F.col("p_brand").alias("genre"))
    return many.unionByName(filters.normalise_genre(single))


@query("""SELECT doc_id, lang, lang AS label_str
FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN ''
             ELSE lang END AS lang FROM documents)
WHERE lang IS NOT NULL AND lang <> ''""")
def filter_labelled(spark, root):
    label = F.when(F.col("doc_id") % 10 == 0, None).when(F.col("doc_id") % 10 == 1, "")
    documents = views.table(spark, root, "documents").select(
        "doc_id", label.otherwise(F.col("lang")).alias("lang")
    )
    return filters.with_label(documents, "lang")


@query(f"""WITH {views.TAGGED}
SELECT p_partkey, CAST(len(tags) AS INTEGER) AS n FROM tagged
WHERE p_partkey % 3 <> 0 AND len(tags) > 0""")
def filter_nonempty_array(spark, root):
    tagged = views.tagged(spark, root).select(
        "p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("tags")).alias("tags")
    )
    return filters.with_tags(tagged, "tags").select("p_partkey", F.size("tags").alias("n"))


_COLUMNS = "l_orderkey, l_linenumber, genres, user_id, uploaded_at, duration"
_NAMES = _COLUMNS.split(", ")


@query(f"""WITH {views.TRACKS}
SELECT {_COLUMNS} FROM tracks WHERE genres IN ('Brand#3', 'Brand#11')""")
def filter_isin(spark, root):
    chosen = Selection(genres=["Brand#3", "Brand#11"])
    return filters.select_rows(views.tracks(spark, root), chosen).select(*_NAMES)


@query(f"""WITH {views.TRACKS}
SELECT {_COLUMNS} FROM tracks WHERE uploaded_at >= '1996-03-01' AND uploaded_at <= '1996-05-31'""")
def filter_date_range(spark, root):
    """Dates are stored as text in a data set, so the range reaches its scan."""
    path = scratch_path(spark, "tracks")
    sinks.overwrite(views.tracks(spark, root).select("uploaded_at", *(n for n in _NAMES if n != "uploaded_at")), path)
    chosen = Selection(date_from="1996-03-01", date_to="1996-05-31")
    return filters.select_rows(sources.read_dataset(spark, path), chosen).select(*_NAMES)


_RANGES = Selection(users=list(range(20, 30)), date_from="1995-01-01", date_to="1995-06-30", duration=(10, 20))


@query(f"""WITH {views.TRACKS}
SELECT {_COLUMNS} FROM tracks WHERE user_id BETWEEN 20 AND 29 AND duration BETWEEN 10 AND 20
  AND uploaded_at BETWEEN '1995-01-01' AND '1995-06-30'""")
def clustered_ranges(spark, root):
    """Three ranges at once on a table written in the order of a space-filling key."""
    path = scratch_path(spark, "clustered")
    sinks.write_clustered(views.tracks(spark, root).select(*_NAMES), path, "uploaded_at", "duration", "user_id")
    return filters.select_rows(sources.read_dataset(spark, path), _RANGES)


@query(f"""WITH {views.TRACKS}
SELECT {_COLUMNS} FROM tracks WHERE duration >= 10 AND duration <= 12""")
def filter_numeric_range(spark, root):
    chosen = Selection(duration=(10, 12))
    return filters.select_rows(views.tracks(spark, root), chosen).select(*_NAMES)


@query(f"""WITH {views.TRACKS}
SELECT {_COLUMNS}, 'genres,users,date_from,duration' AS active FROM tracks
WHERE genres IN ('Brand#1', 'Brand#2', 'Brand#9') AND user_id IN (1, 2, 3, 5, 8)
  AND uploaded_at >= '1995-06-01' AND duration BETWEEN 5 AND 40""")
def dynamic_filter(spark, root):
    chosen = Selection(
        genres=["Brand#1", "Brand#2", "Brand#9"],
        users=[1, 2, 3, 5, 8],
        date_from="1995-06-01",
        duration=(5, 40),
    )
    return filters.select_rows(views.tracks(spark, root), chosen).select(
        *_NAMES, F.lit(",".join(chosen.active)).alias("active")
    )


@query("SELECT event_id, value FROM events WHERE event_type <> 'error'")
def filter_ok(spark, root):
    flagged = views.table(spark, root, "events").select(
        "event_id", "value", (F.col("event_type") != "error").cast("int").alias("ok")
    )
    return filters.only_ok(flagged)


@query("""SELECT c_custkey, c_name, c_acctbal, 3005 AS duration FROM customer
WHERE c_name = 'Customer#000000042'""")
def point_lookup(spark, root):
    return (
        views.table(spark, root, "customer")
        .filter(F.col("c_name") == "Customer#000000042")
        .select("c_custkey", "c_name", "c_acctbal", F.lit(3005).alias("duration"))
    )


@query("SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_numeric(spark, root):
    lines = views.table(spark, root, "lineitem")
    chosen = filters.feature_columns(lines, ["l_orderkey", "l_partkey", "l_suppkey"])
    return lines.select(*chosen)


@query("""SELECT 'o_orderkey' AS "column", 'present' AS status, count(o_orderkey) AS filled
FROM orders
UNION ALL SELECT 'o_custkey', 'present', count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderdate', 'present', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_genre', 'missing', 0
UNION ALL SELECT 'o_orderstatus', 'extra', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'extra', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderpriority', 'extra', count(o_orderpriority) FROM orders""")
def schema_contract(spark, root):
    orders = views.table(spark, root, "orders")
    expected = ["o_orderkey", "o_custkey", "o_genre", "o_orderdate"]
    return filters.schema_contract(orders, expected)


@query(f"""WITH {views.TRACKS}, {PROFILE}, {ZSCORE}
SELECT genres AS "Genre", "count" AS "Pistes", tempo AS "Tempo (bpm)",
       centroid AS "Centroid (Hz)", rms AS "RMS", zcr AS "ZCR", flatness AS "Flatness",
       z_centroid AS "Z Centroid", z_rms AS "Z RMS"
FROM zscored""")
def summary_table(spark, root):
    return summary(group_zscore(group_profile(views.tracks(spark, root))))


@query("SELECT DISTINCT o_custkey FROM orders")
def dedup_key(spark, root):
    orders = views.table(spark, root, "orders")
    return orders.select("o_custkey").dropDuplicates(["o_custkey"])


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_sorted(spark, root):
    customers = views.table(spark, root, "customer").select("c_mktsegment", "c_nationkey")
    return customers.distinct().orderBy("c_mktsegment", "c_nationkey")


@query(f"""WITH {views.GENRE_ROWS},
hit AS (SELECT p_partkey, [w FOR w IN list_distinct(genres) IF w IN ('red', 'ring', 'steel')]
        AS found FROM genre_rows)
SELECT p_partkey, array_to_string(list_sort(found), '|') AS matched
FROM hit WHERE len(found) > 0""")
def array_overlap_filter(spark, root):
    kept = filters.overlapping(views.genre_rows(spark, root), "genres", ["red", "ring", "steel"])
    return kept.select("p_partkey", F.array_join(F.sort_array("matched"), "|").alias("matched"))


@query(f"""WITH {views.LISTING}
SELECT name FROM listing EXCEPT SELECT name FROM listing WHERE is_done""")
def except_names(spark, root):
    names = views.listing(spark, root)
    return joins.pending(names.select("name"), names.filter("is_done"), "name")
