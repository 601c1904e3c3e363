"""Aggregates, windows, rankings and comparisons over the feature rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrelake.constants import (
    COMPARED_FEATURES,
    NOTES,
    PROFILE_COLUMNS,
    TEMPO_BOUNDS,
    TEMPO_BUCKETS,
    TONAL_AXES,
)
from timbrelake.constants import BANDS
from timbrelake.functions import arrays
from timbrelake.operators import compare, profile, rollup
from timbrelake.plans import views
from timbrelake.plans.registry import half_up, query
from timbrelake.session import scratch_path

# --- SQL parts shared by several queries ----------------------------------------------------

_MEANS = ",\n         ".join(
    f"{half_up(f'avg({source})', places)} AS {name}" for source, name, places in PROFILE_COLUMNS
)

PROFILE = f"""profile AS (
  SELECT genres, {_MEANS}, count(*) AS "count", {half_up('avg(duration)', 1)} AS duration_avg
  FROM tracks GROUP BY genres ORDER BY "count" DESC, genres LIMIT 12)"""


def _zscore(name: str) -> str:
    score = f"({name} - avg({name}) OVER ()) / nullif(stddev_samp({name}) OVER (), 0)"
    return f"coalesce({half_up(score, 2)}, 0) AS z_{name}"


ZSCORE = f"""zscored AS (
  SELECT *, {_zscore('centroid')}, {_zscore('rms')} FROM profile)"""


def _stat(name: str) -> list[str]:
    return [
        f"{half_up(f'avg({name})', 6)} AS {name}__mean",
        f"{half_up(f'stddev_samp({name})', 6)} AS {name}__std",
        f"{half_up(f'min({name})', 6)} AS {name}__min",
        f"{half_up(f'max({name})', 6)} AS {name}__max",
        f"{half_up(f'quantile_disc({name}, 0.1)', 6)} AS {name}__p10",
        f"{half_up(f'quantile_disc({name}, 0.9)', 6)} AS {name}__p90",
    ]


_STATS = ",\n       ".join(column for name in COMPARED_FEATURES for column in _stat(name))
STATS = f"stats AS (SELECT {_STATS} FROM measures)"

_COUNTED = 'counted AS (SELECT genres, count(*) AS "count" FROM tracks GROUP BY genres)'


def _case(value: str) -> str:
    steps = "".join(
        f" WHEN {value} < {bound} THEN '{label}'"
        for bound, label in zip(TEMPO_BOUNDS, TEMPO_BUCKETS)
    )
    return f"CASE{steps} ELSE '{TEMPO_BUCKETS[-1]}' END"


def _place(bucket: str) -> str:
    steps = "".join(f" WHEN '{label}' THEN {i}" for i, label in enumerate(TEMPO_BUCKETS))
    return f"CASE {bucket}{steps} END"


# --- global figures -----------------------------------------------------------------------


@query(f"""WITH {views.TRACKS}
SELECT count(*) AS total, {half_up('avg(tempo)', 1)} AS tempo_mean,
       count(DISTINCT genres) AS n_genres, {half_up('avg(duration)', 1)} AS duration_avg
FROM tracks""")
def kpi_summary(spark, root):
    return profile.kpi_summary(views.tracks(spark, root))


@query(f"WITH {views.MEASURES}, {STATS} SELECT * FROM stats")
def feature_stats(spark, root):
    return profile.feature_stats(views.measures(spark, root), exact=True)


@query(f"""WITH {views.TRACKS}
SELECT min(uploaded_at) AS date_min, max(uploaded_at) AS date_max FROM tracks""")
def date_range(spark, root):
    return profile.date_range(views.tracks(spark, root))


@query("""SELECT DISTINCT user_id FROM (
  SELECT CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS user_id FROM lineitem)
WHERE user_id IS NOT NULL""")
def facet_values(spark, root):
    users = views.table(spark, root, "lineitem").select(
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("user_id")
    )
    return profile.facet_values(users, "user_id")


# --- groups -------------------------------------------------------------------------------


@query(f"WITH {views.TRACKS}, {_COUNTED} SELECT * FROM counted")
def group_count(spark, root):
    return profile.group_count(views.tracks(spark, root))


@query("""SELECT user_id, count(*) AS "count" FROM events GROUP BY user_id HAVING count(*) >= 65""")
def having_min_support(spark, root):
    return profile.supported_groups(views.table(spark, root, "events"), "user_id", 65)


@query(f"WITH {views.TRACKS}, {PROFILE} SELECT * FROM profile")
def group_profile(spark, root):
    return profile.group_profile(views.tracks(spark, root))


def _rollup(spark, root):
    """A roll-up of all tracks in four batches, the last two of which came later."""
    rows = views.tracks(spark, root).withColumn("batch_id", F.col("l_linenumber") % 4)
    path = scratch_path(spark, "rollup")
    rollup.refresh(spark, rows.filter("batch_id < 2"), path)
    rollup.refresh(spark, rows, path)
    return spark.read.parquet(path)


@query(f"WITH {views.TRACKS}, {PROFILE} SELECT * FROM profile")
def rollup_profile(spark, root):
    """Means of the largest genres from a stored roll-up that was refreshed."""
    return profile.top_groups(rollup.group_profile(_rollup(spark, root)))


@query('SELECT source, count(*) AS "count" FROM documents GROUP BY source '
       'ORDER BY "count" DESC, source LIMIT 12')
def topk_groups(spark, root):
    """All groups are of equal size at rank 12, so the choice depends on the tie-break."""
    counted = profile.group_count(views.table(spark, root, "documents"), "source")
    return profile.top_groups(counted, "source")


@query(f"""WITH {views.TRACKS}, {_COUNTED}
SELECT genres, "count", CAST(rank() OVER (ORDER BY "count" DESC) AS INTEGER) AS rank
FROM counted ORDER BY "count" DESC, genres LIMIT 12""")
def genre_ranking(spark, root):
    return profile.genre_ranking(views.tracks(spark, root))


_PARETO_TOTAL = '(SELECT sum("count") FROM counted)'
_RUNNING = """sum("count") OVER (ORDER BY "count" DESC, genres
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(f"""WITH {views.TRACKS}, {_COUNTED}
SELECT genres, "count", CAST(rank() OVER (ORDER BY "count" DESC) AS INTEGER) AS rank,
       {half_up(f'CAST({_RUNNING} AS DOUBLE) / {_PARETO_TOTAL} * 100', 1)} AS cumul_pct,
       {half_up(f'CAST("count" AS DOUBLE) / {_PARETO_TOTAL} * 100', 1)} AS pct
FROM counted ORDER BY "count" DESC, genres LIMIT 12""")
def genre_pareto(spark, root):
    return profile.genre_pareto(views.tracks(spark, root))


@query(f"""WITH {views.TRACKS},
counted AS (SELECT {_case('tempo')} AS bucket, count(*) AS "count" FROM tracks GROUP BY ALL),
placed AS (SELECT *, {_place('bucket')} AS place FROM counted)
SELECT bucket, "count", CAST(sum("count") OVER w AS BIGINT) AS cumul,
       {half_up('CAST(sum("count") OVER w AS DOUBLE) / sum("count") OVER () * 100', 1)}
       AS cumul_pct
FROM placed WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def bucket_histogram(spark, root):
    return profile.bucket_histogram(views.tracks(spark, root))


@query(f"""WITH bucketed AS (
  SELECT {_case('CAST(o_custkey % 200 AS DOUBLE)')} AS bucket, o_totalprice FROM orders)
SELECT bucket, {half_up('avg(o_totalprice)', 2)} AS mean_price, {_place('bucket')} AS place
FROM bucketed GROUP BY bucket""")
def ordinal_sort(spark, root):
    """Bands in band order, not in alphabetical order."""
    bucket = profile.tempo_bucket((F.col("o_custkey") % 200).cast("double"))
    return (
        views.table(spark, root, "orders")
        .groupBy(bucket.alias("bucket"))
        .agg(profile.rounded(F.avg("o_totalprice"), 2).alias("mean_price"))
        .withColumn("place", profile.bucket_order(F.col("bucket")))
        .orderBy("place")
    )


@query(f"WITH {views.TRACKS}, {PROFILE}, {ZSCORE} SELECT * FROM zscored")
def group_zscore(spark, root):
    return profile.group_zscore(profile.group_profile(views.tracks(spark, root)))


@query(f"""WITH {views.TRACKS},
grouped AS (SELECT genres, {half_up('avg(zcr_mean)', 4)} AS zcr,
                   {half_up('avg(flatness_mean)', 5)} AS flatness, count(*) AS "count"
            FROM tracks GROUP BY genres ORDER BY "count" DESC, genres LIMIT 12),
ranked AS (SELECT *, {half_up('percent_rank() OVER (ORDER BY zcr)', 3)} AS pct_rank_zcr,
                  {half_up('percent_rank() OVER (ORDER BY flatness)', 3)} AS pct_rank_flatness
           FROM grouped)
SELECT *, {half_up('(pct_rank_zcr + pct_rank_flatness) / 2', 3)} AS noise_score FROM ranked""")
def noise_score(spark, root):
    return profile.noise_score(views.tracks(spark, root))


@query(f"""WITH {views.GENRE_ROWS},
tags AS (SELECT p_partkey, unnest(list_distinct(genres)) AS genre FROM genre_rows)
SELECT genre, count(*) AS pos, (SELECT count(*) FROM genre_rows) - count(*) AS neg
FROM tags GROUP BY genre HAVING count(*) >= 20 AND (SELECT count(*) FROM genre_rows) > count(*)""")
def class_balance(spark, root):
    return profile.class_balance(views.genre_rows(spark, root))


# --- one item against the data set ------------------------------------------------------------


def _compared(name: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, '{name}' AS feature, {name} AS value,
  {name}__mean AS ds_mean, {name}__std AS ds_std, {name}__min AS ds_min, {name}__max AS ds_max,
  {name}__p10 AS ds_p10, {name}__p90 AS ds_p90 FROM measures, stats"""


_GAP = "coalesce((value - ds_mean) / nullif(ds_mean, 0) * 100, 0)"
_PERCENT = f"CAST(round(CAST({_GAP} AS DECIMAL(38,16)), 4) AS DOUBLE)"


@query(f"""WITH {views.MEASURES}, {STATS},
compared AS ({' UNION ALL '.join(_compared(name) for name in COMPARED_FEATURES)}),
placed AS (SELECT *, {half_up('ds_mean - ds_std', 6)} AS band_low,
                  {half_up('ds_mean + ds_std', 6)} AS band_high, {_PERCENT} AS delta_pct
           FROM compared)
SELECT *, CASE WHEN abs(delta_pct) > 30 THEN 'red' WHEN abs(delta_pct) > 10 THEN 'yellow'
               ELSE 'green' END AS flag
FROM placed""")
def track_vs_dataset(spark, root):
    """Every track against the statistics of all tracks."""
    tracks = views.measures(spark, root)
    stats = profile.feature_stats(tracks, exact=True)
    return compare.track_vs_dataset(tracks, stats, "l_orderkey", "l_linenumber")


_OWN = """own AS (SELECT avg(mfcc_1_mean) AS m1, avg(mfcc_2_mean) AS m2, avg(mfcc_3_mean) AS m3,
                avg(mfcc_4_mean) AS m4, avg(mfcc_5_mean) AS m5 FROM tracks)"""
_CORNERS = [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1)]


@query(f"""WITH {views.TRACKS}, {PROFILE}, {_OWN},
top6 AS (SELECT * FROM profile ORDER BY "count" DESC, genres LIMIT 6)
{' UNION ALL '.join(
    f"SELECT genres AS series, {at} AS position, 'MFCC {i}' AS axis, mfcc{i} AS value FROM top6"
    f" UNION ALL SELECT 'track', {at}, 'MFCC {i}', {half_up(f'm{i}', 6)} FROM own"
    for at, i in _CORNERS)}""")
def profile_radar(spark, root):
    """Outlines of the six largest groups and of an average track."""
    tracks = views.tracks(spark, root)
    names = [f"mfcc_{i}_mean" for i in range(1, 6)]
    own = tracks.agg(*[profile.rounded(F.avg(name), 6).alias(name) for name in names])
    return compare.profile_radar(profile.group_profile(tracks), own)


_OTHER = [f"x{i}" for i in range(18, 60)]


def _named(kind: str, names: list[str], first: int) -> str:
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(names, 1))
    return f"""SELECT vec_id, '{kind}' AS kind, CAST(position AS INTEGER) AS position, name,
  coalesce(CAST(embedding[position + {first}] AS DOUBLE), 0) AS value
FROM embeddings, (VALUES {rows}) AS t(position, name)"""


@query(f"""{_named('chroma', NOTES, 0)} UNION ALL {_named('tonnetz', TONAL_AXES, 12)}
UNION ALL {_named('other', _OTHER, 18)} UNION ALL {_named('contrast', BANDS, 60)}""")
def vector_labels(spark, root):
    """All positions by name; the last group reaches past the end of the vectors."""
    vectors = views.table(spark, root, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v")
    )
    parts = [("chroma", NOTES, 0), ("tonnetz", TONAL_AXES, 12), ("other", _OTHER, 18), ("contrast", BANDS, 60)]

    def named(kind, names, first):
        entries = arrays.name_positions(F.slice("v", first + 1, len(names)), names)
        return F.transform(
            entries,
            lambda e: F.struct(
                F.lit(kind).alias("kind"), e["position"].alias("position"),
                e["name"].alias("name"), e["value"].alias("value"),
            ),
        )

    tagged = [named(*part) for part in parts]
    return vectors.select("vec_id", F.inline(F.concat(*tagged)))
