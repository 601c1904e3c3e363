import hashlib
import random
import re
import zlib

import numpy as np
import plain
import pytest

from timbrelake.llm import periodic_runs, queries


def runs(words):
    """Every maximal stretch with a period q, its smallest, of at least 24 words and three periods."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        t = 0
        while t + q < n:
            end = t
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - t >= max(24, 3 * q):
                out.setdefault((t, end + q - t), q)
            t = end + 1
    return sorted(((a, size, q) for (a, size), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    return " ".join(w for i, w in enumerate(words) if not any(a + q <= i < a + size for a, size, q in found))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_of_random_sequences():
    draw, some = random.Random(5), 0
    for _ in range(400):
        k, n = draw.choice([1, 2, 2, 3, 5, 50]), draw.randrange(0, 120)
        words = [draw.randrange(k) for _ in range(n)]
        for _ in range(draw.randrange(0, 4)):
            if n:
                a, size = draw.randrange(n), draw.randrange(1, 90)
                words[a : a + size] = ([draw.randrange(k) for _ in range(draw.randrange(1, 20))] * 90)[: len(words[a : a + size])]
        found = periodic_runs.word_runs(np.array(words, np.int64))
        assert found == runs(words)
        some += bool(found)
    assert some > 100


@pytest.mark.parametrize("words", [fibonacci(700), [0] * 600, [0, 1] * 400, fibonacci(90) * 7, list(range(40)) * 20, [*range(30), *range(30)]])
def test_runs_of_repetitive_sequences(words):
    assert periodic_runs.word_runs(np.array(words, np.int64)) == runs(words)


def test_parts_of_the_index(monkeypatch):
    words = np.array((fibonacci(60) + [5, 6, 7, 8, 9, 10, 11, 12]) * 3, np.int64)
    sa, place, lcp = periodic_runs.suffix_array(words)
    suffixes = sorted(range(len(words)), key=lambda i: words[i:].tolist())
    assert sa.tolist() == suffixes and place[sa].tolist() == list(range(len(words)))
    for k in range(1, len(sa)):
        a, b = words[sa[k - 1] :].tolist(), words[sa[k] :].tolist()
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == (common if common >= periodic_runs.DEPTH else 0)
    whole = periodic_runs.branching_squares(words).tolist()
    monkeypatch.setattr(periodic_runs, "ITEMS", 3)
    assert periodic_runs.branching_squares(words).tolist() == whole


def test_query_on_the_whole_table(spark, root, docs):
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows, some = queries.op12_periodic_runs(spark, root).collect(), 0
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        words = planted(r.doc_id, text[r.doc_id])
        found = runs(words) if len(words) < 700 else periodic_runs.word_runs(np.unique(words, return_inverse=True)[1])
        lines = "".join(f"{a},{size},{q}\n" for a, size, q in found)
        assert (r.n_runs, r.runs_sha256) == (len(found), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
        best = min(found, key=lambda f: (-f[1] / f[2], f[0], f[2])) if found else (None, None, None)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        some += bool(found)
    assert some > 10


def test_edge_cases(spark):
    more = ["a b c " * 30, "x y z  a b\tc\n" + "é ü " * 14 + "é end", "one " * 23, "one " * 24]
    frame = plain.documents(spark, plain.TEXTS + more)
    for c in ("n_words", "runs", "c0", "of"):
        frame = frame.withColumn(c, frame.score)
    got = periodic_runs.find_runs(frame)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "c0", "of", "n_words", "runs", "collapsed"]
    for r in got.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        found = runs(words) if len(words) < 1000 else [(0, len(words), 5)]
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == found
        assert r.collapsed == collapsed(words, found) and (r.score, r.c0) == ("old", "old")
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0
    assert planted(None, "a") == queries.periodic(None, b"a").decode().split()
