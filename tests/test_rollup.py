import pytest
from helpers import rows
from pyspark.sql import functions as F

from timbrelake.operators import filters, rollup
from timbrelake.operators.filters import Selection
from timbrelake.plans import jobs, views
from timbrelake.session import scratch_path


@pytest.fixture(scope="module")
def tracks(spark, root):
    """Tracks in six batches, some values NULL."""
    frame = views.tracks(spark, root).withColumn("batch_id", F.col("l_orderkey") % 6)
    gone = F.col("l_orderkey") % 7 == 0
    return frame.withColumn("rms_mean", F.when(~gone, F.col("rms_mean"))).withColumn("duration", F.when(~gone, F.col("duration")))


@pytest.fixture(scope="module")
def store(spark, tracks):
    """A roll-up that was refreshed twice, from a data set in folders by batch."""
    data, path = scratch_path(spark, "tracks"), scratch_path(spark, "rollup")
    tracks.write.partitionBy("batch_id").parquet(data)
    dataset = spark.read.parquet(data)
    assert rollup.refresh(spark, dataset.filter("batch_id < 3"), path) == 3
    assert rollup.refresh(spark, dataset, path) == 3
    assert rollup.refresh(spark, dataset, path) == 0
    return path


SELECTIONS = [Selection(), Selection(genres=["Brand#11", "Brand#23"]), Selection(users=[1, 3]), Selection(date_from="1994-01-01", date_to="1995-06-30"), Selection(genres=["none"])]


@pytest.mark.parametrize("selection", SELECTIONS)
def test_overview_equals_the_full_scan(spark, tracks, store, selection):
    ours = rollup.overview(spark.read.parquet(store), selection)
    theirs = jobs.overview(tracks.drop("batch_id"), selection)
    assert set(ours) == set(theirs)
    for name, table in ours.items():
        expected = theirs[name].select(*table.columns) if name == "feature_stats" else theirs[name]
        assert table.columns == expected.columns
        assert rows(table) == rows(expected), name


def test_refresh_reads_new_batches_only(spark, tracks, store):
    other = tracks.filter("batch_id = 5").withColumn("batch_id", F.lit(6)).withColumn("genres", F.lit("new"))
    bad = F.raise_error("an old batch was read").cast("double")
    again = tracks.withColumn("tempo", F.when(F.col("batch_id") < 6, bad).otherwise(F.col("tempo"))).unionByName(other)
    path = scratch_path(spark, "copy")
    spark.read.parquet(store).write.partitionBy("batch_id").parquet(path)
    assert rollup.refresh(spark, again, path) == 1
    added = spark.read.parquet(path).filter("genres = 'new'").agg(F.sum("count")).first()[0]
    assert added == other.count()


def test_durations_have_no_cells(spark, tracks, store):
    with pytest.raises(ValueError):
        rollup.overview(spark.read.parquet(store), Selection(duration=(1, 2)))
    halves = [rollup.cells(filters.select_rows(tracks, Selection()).filter(F.col("l_linenumber") % 2 == i)) for i in (0, 1)]
    whole = rollup.group_profile(rollup.cells(tracks))
    assert rows(rollup.group_profile(rollup.merged(*halves))) == rows(whole)
    assert rollup.group_profile(rollup.cells(tracks.limit(0))).count() == 0


def test_one_large_batch_is_written_by_several_tasks(spark, tracks):
    path = scratch_path(spark, "large")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the cells are few
    try:
        assert rollup.refresh(spark, tracks.withColumn("batch_id", F.lit(1)), path) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(path)
    parts = stored.groupBy(F.input_file_name()).count().collect()
    assert len(parts) > 2 and max(r["count"] for r in parts) < stored.count() / 2
    assert stored.agg(F.sum("count")).first()[0] == tracks.count()
