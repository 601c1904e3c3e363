import hashlib

import pytest
from helpers import rows
from pyspark.sql import functions as F

from timbrelake import sinks, sources
from timbrelake.operators import joins
from timbrelake.session import scratch_path, shared_dir
from timbrelake.sources import files, listing

HEADER = "TRACK_ID\tARTIST_ID\tALBUM_ID\tPATH\tDURATION\tTAGS\n"
LINES = [
    "track_0000001\ta1\tb1\t01/1.mp3\t30.5\tgenre---rock\n",
    "track_0000002\ta1\tb1\t02/2.mp3\t31.0\n",
    "track_0000003\ta2\tb2\t03/3.mp3\t12\tgenre---pop\tmood---sad\tgenre---rock\n",
    "too\tshort\n",
    "track_0000004\ta2\tb2\t04/4.mp3\tbad\tmood---dark\t\n",
]


def _write(tmp_path, name="c.tsv"):
    (tmp_path / name).write_text(HEADER + "".join(LINES))
    return str(tmp_path)


def test_ragged_catalogue(spark, tmp_path):
    frame = sources.read_catalogue(spark, _write(tmp_path))
    found = {r["TRACK_ID"]: (r["DURATION"], r["tags"]) for r in frame.collect()}
    assert found == {
        "track_0000001": (30.5, ["genre---rock"]),
        "track_0000003": (12.0, ["genre---pop", "mood---sad", "genre---rock"]),
        "track_0000004": (None, ["mood---dark", ""]),
    }


def test_quoted_fields(spark, tmp_path):
    line = '"track_1"\ta\tb\t"x ""y"".mp3"\t1\tgenre---"odd\t"\n'
    (tmp_path / "q.tsv").write_text(HEADER + line)
    found = sources.read_catalogue(spark, str(tmp_path)).first()
    assert (found["TRACK_ID"], found["PATH"]) == ("track_1", 'x "y".mp3')
    assert found["tags"] == ['genre---"odd', '"']
    assert found["line"] + "\n" == line


def test_header_of_every_file_is_skipped_and_order_kept(spark, tmp_path):
    _write(tmp_path, "a.tsv")
    frame = sources.read_catalogue(spark, _write(tmp_path, "b.tsv"))
    ordered = [r["TRACK_ID"] for r in frame.orderBy("position").collect()]
    one = ["track_0000001", "track_0000003", "track_0000004"]
    assert ordered == one + one


def test_file_order_over_several_splits(spark, tmp_path):
    lines = [f"track_{i:07d}\ta\tb\t{i}.mp3\t1\tgenre---x\n" for i in range(5000)]
    (tmp_path / "big.tsv").write_text(HEADER + "".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = sources.read_catalogue(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 3
        ordered = [r["TRACK_ID"] for r in frame.orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == [f"track_{i:07d}" for i in range(5000)]


def test_catalogue_paths(spark, tmp_path):
    found = rows(sources.catalogue_paths(spark, _write(tmp_path)))
    assert found == [(f"0{i}/{i}.low.mp3",) for i in (1, 2, 3, 4)]


def test_catalogue_round_trip(spark, tmp_path):
    frame = sources.read_catalogue(spark, _write(tmp_path)).drop("position", "line")
    path = scratch_path(spark, "round")
    sinks.write_catalogue(frame.filter(F.col("DURATION").isNotNull()), path)
    again = sources.read_catalogue(spark, path).drop("position", "line")
    assert rows(again) == rows(frame.filter(F.col("DURATION").isNotNull()))
    assert spark.read.text(path).filter(F.col("value") == HEADER.strip()).count() >= 1


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.wav", "sub/b.wav", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = sources.list_files(spark, str(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["a.wav", "b.wav"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "folder_listing" in plan and "content" not in plan
    read = sources.list_files(spark, str(tmp_path), content=True).select("path")
    assert "ReadSchema: struct<path:string>" in read._jdf.queryExecution().executedPlan().toString()
    flat = sources.list_files(spark, str(tmp_path), recursive=False)
    assert [r["path"].rsplit("/", 1)[1] for r in flat.collect()] == ["a.wav"]


def test_manifest(spark, tmp_path):
    (tmp_path / "m.txt").write_text("abc one.tar\ndef two.tar\n")
    assert rows(sources.read_manifest(spark, str(tmp_path / "m.txt"))) == [
        ("abc", "one.tar"), ("def", "two.tar"),
    ]


def test_sample_takes_at_least_one(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(7)], "name STRING")
    assert sources.sample_names(names, "name").count() == 1
    many = spark.range(1000).select(F.col("id").cast("string").alias("name"))
    first = rows(sources.sample_names(many, "name"))
    assert len(first) == 50
    assert rows(sources.sample_names(many.repartition(7), "name")) == first
    assert rows(sources.sample_names(many, "name", seed=1)) != first


def test_partition_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "parts")
    frame = spark.range(20).withColumn("batch_id", F.col("id") % 4)
    sinks.append_partitioned(frame, path, "batch_id")
    read = sources.read_dataset(spark, path).filter(F.col("batch_id") == 2)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    assert read.count() == 5


def test_shared_dir_is_the_configured_one(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lines_with_control_characters_and_quoted_tabs(spark, tmp_path):
    lines = [
        "TRACK\tA\tB\tPATH\tD\tTAGS", "t1\ta\tb\t1.mp3\t30\tgenre---ro\x01ck\tgenre---pop",
        't2\ta\tb\t"x\ty.mp3"\t30\tgenre---"a""b"', "t3\ta\tb\t3.mp3\t30",
    ]
    (tmp_path / "c.tsv").write_text("\n".join(lines) + "\n")
    rows = {r["TRACK_ID"]: r for r in sources.read_catalogue(spark, str(tmp_path / "c.tsv")).collect()}
    assert rows["t1"]["tags"] == ["genre---ro\x01ck", "genre---pop"] and rows["t1"]["line"] == lines[1]
    assert rows["t2"]["PATH"] == "x\ty.mp3" and len(rows["t2"]["tags"]) == 1
    target = str(tmp_path / "out")
    sinks.write_lines(sources.read_lines(spark, str(tmp_path / "c.tsv")), target, lines[0])
    again = sources.read_lines(spark, target).select("line").collect()
    assert sorted(r["line"] for r in again) == sorted(lines[1:]) and sources.header_of(spark, target) == lines[0]


def test_manifest_keeps_names_and_refuses_lines_without_one(spark, tmp_path):
    (tmp_path / "m.txt").write_text("aa one.tar\nbb two words.tar\n\ncc  lead.tar\n")
    got = {(r["sha256"], r["name"]) for r in sources.read_manifest(spark, str(tmp_path / "m.txt")).collect()}
    assert got == {("aa", "one.tar"), ("bb", "two words.tar"), ("cc", " lead.tar")}
    (tmp_path / "bad.txt").write_text("aa one.tar\nbb\n")
    with pytest.raises(Exception, match="manifest"):
        sources.read_manifest(spark, str(tmp_path / "bad.txt")).collect()


def _tree(top):
    """Files at several depths, odd names and names that do not count."""
    names = ["a.wav", "x/b.wav", "x/y/c.wav", "x/y/z/d e.wav", "p=1/e.wav", "_p=2/f.wav", "x/é[1].wav", "x/g.txt", "q/h{1}.WAV",
             "_hidden/i.wav", ".dot/j.wav", "x/_k.wav", "x/.l.wav", "x/y/m.wav.tmp"]
    for i, name in enumerate(names):
        path = top / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"." * i)


@pytest.mark.parametrize("folders", [1, 3, 256])
@pytest.mark.parametrize("glob", ["*.wav", "*", "?.{wav,txt}", "[!a-c]*.wav", "é\\[1\\]*"])
def test_executors_list_what_the_binary_source_lists(spark, tmp_path, folders, glob):
    _tree(tmp_path)
    ours = sources.list_folders(spark, str(tmp_path), glob, folders=folders)
    theirs = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(str(tmp_path))
    want = rows(theirs.select("path", "length", F.col("modificationTime").cast("long")))
    assert rows(ours.select("path", "length", F.col("modificationTime").cast("long"))) == want and want


def test_listing_spreads_folders_and_keeps_only_them(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"f{i}").mkdir()
        for j in range(5):
            (tmp_path / f"f{i}" / f"{j}.wav").write_bytes(b"x")
    reader = listing._Reader({"path": f"file:{tmp_path}", "glob": "*.wav"})
    parts = reader.partitions()
    assert len(parts) == 13 and all(not p.deep for p in parts)
    few = listing._Reader({"path": f"file:{tmp_path}", "folders": "5"}).partitions()
    assert [p.deep for p in few] == [False] + [True] * 12
    frame = sources.list_folders(spark, str(tmp_path), "*.wav", folders=5)
    assert frame.count() == 60 and frame.rdd.getNumPartitions() == 13
    with pytest.raises(FileNotFoundError):
        sources.list_folders(spark, str(tmp_path / "none"))
    assert sources.list_folders(spark, f"{tmp_path}/f*") is None
    assert sources.list_files(spark, f"{tmp_path}/f*").count() == 60


def test_bucketed_store_joins_without_an_exchange(spark, tmp_path):
    path = f"{tmp_path}/store"
    frame = spark.range(0, 900, 1, 3).select((F.col("id") % 100).cast("int").alias("track_num"), F.col("id").alias("odd `name"), F.lit("x").alias("y"))
    sinks.write_bucketed(frame.filter("track_num < 50"), path, "track_num", 6)
    first = sources.read_bucketed(spark, path)
    assert first.count() == 450
    sinks.write_bucketed(frame.filter("track_num >= 50"), path, "track_num", append=True)
    store = sources.read_bucketed(spark, path)
    assert rows(store) == rows(frame)
    other = spark.range(100).select(F.col("id").cast("int").alias("track_num"), F.array(F.lit("g")).alias("genres")).repartition(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.enrich(store, other)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line)
        assert not any("Exchange" in line for line in plan.splitlines()[scan - 4 : scan]) and plan.count("Exchange hashpartitioning") == 1
        assert joined.count() == 900
        both = store.join(sources.read_bucketed(spark, path).groupBy("track_num").count(), "track_num")
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        sinks.write_bucketed(frame, path, "y", append=True)


@pytest.mark.parametrize("digits", [1, 4])
def test_sample_is_the_head_of_the_hash_order(spark, monkeypatch, digits):
    monkeypatch.setattr(files, "DIGITS", digits)
    names = [f"n{i % 700}" for i in range(1000)] + [None]
    frame = spark.createDataFrame([(n,) for n in names], "draw STRING").repartition(3)
    order = sorted(("" if n is None else hashlib.md5(f"42{n}".encode()).hexdigest(), n or "") for n in names)
    for fraction in (0.0, 0.1, 0.333, 1.0):
        got = sorted(r["draw"] or "" for r in sources.sample_names(frame, "draw", fraction).collect())
        assert got == sorted(n for _, n in order[: max(1, int(1001 * fraction))])
    plan = sources.sample_names(frame, "draw", 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan
    assert sources.sample_names(frame.limit(0), "draw").count() == 0
