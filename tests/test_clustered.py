import glob

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from timbrelake import sinks
from timbrelake.plans import views


@pytest.fixture(scope="module")
def tracks(spark, root):
    return views.tracks(spark, root).select("l_orderkey", "l_linenumber", "uploaded_at", "duration", "user_id")


def groups(path, ranges):
    """Row groups that a reader with these ranges needs, and all of them."""
    needed = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            bounds = {c: meta.row_group(g).column(names.index(c)).statistics for c in ranges}
            total += 1
            needed += all(b.min <= high and b.max >= low for (low, high), b in ((ranges[c], bounds[c]) for c in ranges))
    return needed, total


def test_ranges_read_a_small_part_of_the_row_groups(spark, tracks, tmp_path):
    path, plain = f"{tmp_path}/z", f"{tmp_path}/plain"
    sinks.write_clustered(tracks, path, "uploaded_at", "duration", "user_id", rows_per_file=50)
    tracks.repartition(120).write.parquet(plain)
    assert rows(spark.read.parquet(path)) == rows(tracks) and spark.read.parquet(path).columns == tracks.columns
    ranges = {"uploaded_at": ("1995-01-01", "1995-06-30"), "duration": (10.0, 20.0)}
    needed, total = groups(path, ranges)
    assert total >= 100 and needed < total / 4 and groups(plain, ranges)[0] > 0.9 * groups(plain, ranges)[1]
    for name, (low, high) in {**ranges, "user_id": (2, 3)}.items():  # one range alone prunes too
        needed, total = groups(path, {name: (low, high)})
        assert needed < 0.6 * total, name
    condition = F.col("uploaded_at").between(*ranges["uploaded_at"]) & F.col("duration").between(10, 20)
    assert rows(spark.read.parquet(path).filter(condition)) == rows(tracks.filter(condition))


def test_key_interleaves_cells_and_takes_nulls(spark, tmp_path):
    frame = spark.range(64).select(
        F.when(F.col("id") != 5, (F.col("id") % 8).cast("double")).alias("a"), F.when(F.col("id") == 6, float("nan")).otherwise(F.floor(F.col("id") / 8) * 1.0).alias("b"), F.lit(1).alias("_z")
    )
    keys = {(r["a"], r["b"]): r["k"] for r in sinks.with_cluster_key(frame, ["a", "b"], "k", bits=3).collect()}
    assert keys[0.0, 0.0] == 0 and keys[7.0, 7.0] == max(v for (a, b), v in keys.items() if a is not None and b == b)
    assert keys[7.0, 0.0] > keys[3.0, 7.0] and keys[0.0, 6.0] > keys[1.0, 3.0]
    sinks.write_clustered(frame, f"{tmp_path}/t", "a", "b", rows_per_file=10)
    again = spark.read.parquet(f"{tmp_path}/t")
    assert again.columns == frame.columns and again.count() == 64
    sinks.write_clustered(frame.limit(0), f"{tmp_path}/empty", "a")
    assert spark.read.parquet(f"{tmp_path}/empty").count() == 0
    with pytest.raises(TypeError):
        sinks.write_clustered(frame.withColumn("x", F.array("a")), f"{tmp_path}/x", "x")
