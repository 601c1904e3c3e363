from pathlib import Path

import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from wavs import tone, write_wav

from timbrelake import sinks, sources
from timbrelake.constants import COMPARED_FEATURES
from timbrelake.functions.schema import compact_names, training_columns
from timbrelake.operators import compare, filters, learning
from timbrelake.operators.filters import Selection
from timbrelake.plans import jobs
from timbrelake.session import scratch_path
from timbrelake.streaming import extract_new_files

HEADER = "TRACK_ID\tARTIST_ID\tALBUM_ID\tPATH\tDURATION\tTAGS\n"


def _corpus(root, first, last):
    for i in range(first, last):
        write_wav(root / f"{i % 3}" / f"{i}.low.wav", tone(200 + 150 * (i % 4), 0.2))


def test_extract_build_and_train(spark, tmp_path):
    audio, out = tmp_path / "audio", scratch_path(spark, "features")
    _corpus(audio, 0, 23)
    (audio / "0" / "bad.low.wav").write_bytes(b"no sound")
    first = jobs.extract(spark, str(audio), out, batch_size=5)
    assert first == {"found": 24, "pending": 24, "extracted": 23, "failed": 1}
    failures = sources.read_dataset(spark, f"{out}_failures").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in failures] == ["bad.low.wav"] and failures[0]["error"]
    stored = sources.read_dataset(spark, out)
    assert stored.columns == ["path", *compact_names(), "batch_id"]
    assert {r["batch_id"] for r in stored.select("batch_id").collect()} == set(range(5))

    _corpus(audio, 23, 30)
    second = jobs.extract(spark, str(audio), out, batch_size=5, round_batches=1)
    assert second == {"found": 31, "pending": 8, "extracted": 7, "failed": 1}
    stored = sources.read_dataset(spark, out)
    assert stored.count() == 30 == stored.select("path").distinct().count()
    assert stored.agg(F.max("batch_id")).first()[0] == 6

    lines = [
        f"track_{i:07d}\ta\tb\t{i}.mp3\t30\tgenre---g{i % 4}\tmood---x\n" for i in range(2, 40)
    ]
    catalogue = tmp_path / "c.tsv"
    catalogue.write_text(HEADER + "".join(lines))
    target = scratch_path(spark, "training")
    dataset = jobs.build_dataset(spark, out, str(catalogue), target, users=None)
    assert dataset.count() == 28
    assert sorted(dataset.columns) == sorted(training_columns())
    assert {r["status"] for r in filters.schema_contract(dataset, training_columns()).collect()} \
        == {"present"}
    with_users = jobs.build_dataset(spark, out, str(catalogue), target)
    assert with_users.filter("user_id BETWEEN 0 AND 5").count() == 28

    model, metrics = jobs.train(
        with_users, "track_num", scratch_path(spark, "model"), numTrees=5, minInstancesPerNode=1
    )
    inputs = model.stages[1].getInputCols()
    assert inputs == compact_names()
    assert 0 <= metrics.first()["accuracy"] <= 1

    # One item against the data set: features, likely genres, distances, outlines.
    data = filters.normalise_genre(with_users)
    tables = jobs.overview(data, Selection(users=[0, 1, 2, 3, 4, 5]))
    assert tables["kpi"].first()["total"] == 28 and tables["stats"].count() == 4
    item = jobs.analyse_file(
        spark, f"file://{audio}/0/3.low.wav", "mine", scratch_path(spark, "history")
    )
    assert learning.predict_top(model, item, "filename").count() == 3
    placed = compare.track_vs_dataset(item, tables["feature_stats"], "filename")
    assert {r["feature"] for r in placed.collect()} == set(COMPARED_FEATURES)
    outlines = compare.profile_radar(tables["stats"], item)
    assert outlines.count() == 5 * 6


def test_extract_when_every_file_fails(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"x")
    out = scratch_path(spark, "nothing")
    expected = {"found": 1, "pending": 1, "extracted": 0, "failed": 1}
    assert jobs.extract(spark, str(tmp_path), out) == expected
    assert jobs.extract(spark, str(tmp_path), out) == expected


def test_rectangular_metadata(spark, tmp_path):
    (tmp_path / "m.tsv").write_text(HEADER + "track_05\ta\tb\t5.mp3\t30\tgenre---rock\n")
    found = jobs.read_metadata(spark, str(tmp_path / "m.tsv"), ragged=False)
    assert rows(found) == [("track_05", "5.mp3", 5, ["rock"])]


def test_filter_catalogue(spark, tmp_path):
    genres = ["rock", "pop", "folk"]
    lines = [
        f"track_{i:07d}\ta\tb\t{i}.mp3\t3.50\tmood---x\tgenre---{genres[i % 3]}\tgenre---folk\n"
        for i in range(60)
    ]
    source = tmp_path / "c.tsv"
    source.write_text(HEADER + "".join(lines))
    target = scratch_path(spark, "capped")
    found = jobs.filter_catalogue(spark, str(source), target, cap=4)
    assert rows(found) == [("folk", 4), ("rock", 4)]
    assert sources.header_of(spark, target) == HEADER.strip()
    written = sources.read_lines(spark, target).collect()
    assert {r["line"] + "\n" for r in written} <= set(lines)
    kept = {r["TRACK_ID"] for r in sources.read_catalogue(spark, target).collect()}
    assert kept == {f"track_{i:07d}" for i in (0, 3, 6, 9, 2, 5, 8, 11)}
    anywhere = jobs.filter_catalogue(spark, str(source), scratch_path(spark, "any"), cap=None)
    assert rows(anywhere) == [("folk", 60, 60), ("rock", 20, 60)]


def test_analyse_one_file(spark, tmp_path):
    history = scratch_path(spark, "history")
    assert jobs.history_entry(spark, history, "x") is None
    write_wav(tmp_path / "x.wav", tone(440))
    (tmp_path / "y.wav").write_bytes(b"?")
    uri = f"file://{tmp_path}"
    assert jobs.analyse_file(spark, f"{uri}/x.wav", "My song", history).count() == 1
    assert jobs.analyse_file(spark, f"{uri}/y.wav", "Broken", history).count() == 0
    with pytest.raises(AnalysisException):
        jobs.analyse_file(spark, f"{uri}/missing.wav", "None", history)
    stored = jobs.history_entry(spark, history, "My song")
    assert [r["duration"] for r in stored.collect()] == [0.5]
    assert sources.read_dataset(spark, history).count() == 1


def test_incremental_extraction(spark, tmp_path):
    audio, out = tmp_path / "audio", scratch_path(spark, "stream")
    progress = scratch_path(spark, "progress")
    _corpus(audio, 0, 4)
    extract_new_files(spark, str(audio), out, progress)
    assert sources.read_dataset(spark, out).count() == 4
    _corpus(audio, 4, 7)
    (audio / "0" / "bad.wav").write_bytes(b"x")
    for _ in range(2):
        extract_new_files(spark, str(audio), out, progress, files_per_batch=2)
    stored = sources.read_dataset(spark, out)
    assert stored.count() == 7 == stored.select("path").distinct().count()
    assert stored.columns == ["path", *compact_names()]
    failed = sources.read_dataset(spark, f"{out}_failures").collect()
    assert [(r["path"].rsplit("/", 1)[1], bool(r["error"])) for r in failed] == [("bad.wav", True)]


def test_repeated_batch_stores_nothing_twice(spark, tmp_path, monkeypatch):
    """A run that ends between storing a batch and recording it."""
    audio, out, progress = tmp_path / "audio", scratch_path(spark, "stream"), scratch_path(spark, "progress")
    _corpus(audio, 0, 3)
    (audio / "0" / "bad.wav").write_bytes(b"x")
    extract_new_files(spark, str(audio), out, progress)
    (tmp_path / "lost").mkdir()
    for file in Path(progress, "commits").iterdir():  # the stream forgets that the batch was done
        file.rename(tmp_path / "lost" / file.name)
    extract_new_files(spark, str(audio), out, progress)
    stored = [r["path"] for r in sources.read_dataset(spark, out).collect()]
    assert len(stored) == len(set(stored)) == 3 and sources.read_dataset(spark, f"{out}_failures").count() == 1


def test_shards_are_read_as_one(spark):
    base = scratch_path(spark, "shards")
    paths = [sinks.write_shard(spark.range(i, 9, 3), base, i) for i in range(3)]
    assert paths[1].endswith("dataset_part1.parquet")
    assert sources.read_dataset(spark, *paths).count() == 9


def test_array_form_job(spark, tmp_path):
    audio, out = tmp_path / "audio", scratch_path(spark, "arrays")
    _corpus(audio, 0, 4)
    (audio / "0" / "bad.low.wav").write_bytes(b"no sound")
    for _ in range(2):
        counts = jobs.extract_arrays(spark, str(audio), out)
        assert counts == {"found": 5, "extracted": 4, "failed": 1}
    stored = sources.read_dataset(spark, out)
    assert stored.count() == 4 and "ok" not in stored.columns
    assert sources.read_dataset(spark, f"{out}_failures").first()["path"].endswith("bad.low.wav")


def test_sharded_build_resumes(spark, tmp_path):
    audio, out = tmp_path / "audio", scratch_path(spark, "sharded")
    _corpus(audio, 2, 9)
    lines = [f"track_{i:07d}\ta\tb\t{i}.mp3\t30\tgenre---g{i % 2}\tmood---x\n" for i in range(2, 9)]
    (tmp_path / "c.tsv").write_text(HEADER + "".join(lines))
    first = jobs.build_shards(spark, str(audio), str(tmp_path / "c.tsv"), out, 3)
    assert first.count() == 7
    before = {r["path"] for r in first.select("path").collect()} if "path" in first.columns else None
    again = jobs.build_shards(spark, str(audio), str(tmp_path / "c.tsv"), out, 3)
    assert again.count() == 7 and again.columns == first.columns
    assert before is None or before == {r["path"] for r in again.select("path").collect()}
