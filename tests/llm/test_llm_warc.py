import glob
import gzip
import hashlib

from timbrelake.llm import warc
from timbrelake.session import scratch_path

BIG = "é😀x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 400
ROWS = [
    (1, "u", None), (2, None, ""), (3, "a\r\nb", BIG), (4, "u", BIG), (4, "u", BIG), (None, "u", "WARC/1.1\r\nx" * 200),
    (7, "u", "\r\n\r\n" * 500), (8, "u", "x" * 300_000), (9, "u", "x\0y\n" * 400), (9, "u", "tail\r\n\r\n"), (None, None, None),
    (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "y" * 1000), (13, "u", "y" * 1000),
]


def expected(rows):
    out = []
    data = [(p, (h or "").encode()) for p, _, h in rows]
    for i, (p, d) in enumerate(data):
        same = [(q is not None, q or 0, j) for j, (q, e) in enumerate(data) if e == d]
        top = max(same)
        revisit = len(d) >= 1000 and top[2] != i
        out.append((p, len(d), hashlib.sha1(d).hexdigest(), "revisit" if revisit else "response", top[1] if revisit else None))
    return sorted(out, key=str)


def test_round_trip_of_odd_payloads(spark):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'z' AS sha1", "1 AS bytes")
    table = scratch_path(spark, "pages")
    frame.repartition(3).write.parquet(table)
    for chunk in (1000, warc.CHUNK):
        path = scratch_path(spark, "warc")
        warc.write(spark.read.parquet(table), path, chunk)
        assert sorted(map(tuple, warc.read(spark, path).collect()), key=str) == expected(ROWS)


def test_archives_are_warc(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1), path, 5000)
    total = 0
    for name in glob.glob(f"{path}/part-*"):
        data = gzip.open(name).read()
        while data:  # by the stated lengths alone, as any reader does
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, total = rest[size + 4 :], total + 1
    assert total == warc.read_chunks(spark, path).count() > len(ROWS)


def test_running_digests_carry_over_chunks(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(ROWS[7:8], "page_id long, url string, html string"), path, 1000)
    rows = sorted(warc.running_digests(warc.read_chunks(spark, path).where("segmented")).collect(), key=lambda r: r.segment)
    assert [r.upto for r in rows] == list(range(1000, 300_001, 1000))
    assert [r.digest for r in rows[:3]] == [hashlib.sha1(b"x" * n).hexdigest() for n in (1000, 2000, 3000)]


def test_empty_table(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0
