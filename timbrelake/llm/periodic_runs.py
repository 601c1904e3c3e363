"""Periodic runs of words: enhanced suffix array, branching tandem test in each LCP interval, squares merged into runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.text import arrow_map, slices
from timbrelake.session import ship_package

#: A run has at least so many words, and its period at least so often.
SHORTEST, TIMES = 24, 3
#: Every run has a square of a multiple of its period of 7 words or more at its end (periods below 7: up
#: to 12 words), so that shallower LCP intervals hold nothing that deeper ones lack.
DEPTH = 7
#: In a run of 24 words or more, suffixes one period apart share at least so many words.
SHARED = 16
#: Suffixes of LCP intervals that are tested at once.
ITEMS = 1 << 20
BASE = 0x9E3779B97F4A7C15
ADDED = ("n_words", "runs", "collapsed")


def repeats(ids: np.ndarray) -> bool:
    """Whether some SHARED successive words may stand twice (equal hashes); if not, there is no run."""
    n = len(ids)
    if n < SHORTEST:
        return False
    powers, inverses = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE) * powers, out=sums[1:])
    h = np.sort((sums[SHARED:] - sums[:-SHARED]) * inverses[: n - SHARED + 1])
    return bool((h[1:] == h[:-1]).any())


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(1 << 14, 1 << n.bit_length())
        _TABLES[:] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64))) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _TABLES[0][:n], _TABLES[1][:n]


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, their places in it, and the LCP of each with the one before (0 below DEPTH).

    Prefix doubling: level k ranks suffixes by their first 2**k words, and only suffixes that are
    not alone with their rank are sorted again. LCPs are read from the levels, longest first.
    """
    n = len(ids)
    sa = np.argsort(ids, kind="stable")
    new = np.append(True, np.diff(ids[sa]) != 0)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank.astype(np.int32)], 1
    alone = new & np.append(new[1:], True)
    open_ = np.flatnonzero(~alone)
    while len(open_):
        suffix = sa[open_]
        second = suffix + width
        key = rank[suffix] * (n + 1) + np.where(second < n, rank[np.minimum(second, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[open_] = suffix = suffix[order]
        new = np.append(True, np.diff(key[order]) != 0)
        rank[suffix] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        levels.append(rank.astype(np.int32))
        width *= 2
        open_ = open_[~(new & np.append(new[1:], True))]
    lcp = np.zeros(n, np.int64)
    if len(levels) > 2:
        near = levels[2]
        at = np.flatnonzero(near[sa[1:]] == near[sa[:-1]]) + 1
        a, b, size = sa[at - 1], sa[at], np.zeros(len(at), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + size, b + size
            same = np.maximum(x, y) < n
            same[same] = levels[k][x[same]] == levels[k][y[same]]
            size[same] += 1 << k
        lcp[at] = np.where(size < DEPTH, 0, size)
    return sa, rank, lcp


def small_children(lcp: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """``first, end, left, right, depth`` of every child but the largest of every LCP interval.

    Children are stretches of the suffix array between the places where the interval's least LCP
    stands; open intervals are a stack, and no tree is built.
    """
    deep = np.flatnonzero(lcp)
    stack: list[tuple[int, list[int]]] = []

    def closed(depth: int, cuts: list[int], right: int) -> Iterator[tuple[int, int, int, int, int]]:
        cuts.append(right)
        sizes = [b - a for a, b in zip(cuts, cuts[1:])]
        largest = sizes.index(max(sizes))
        for c in range(len(sizes)):
            if c != largest:
                yield cuts[c], cuts[c + 1], cuts[0], right, depth

    before = -2
    for k, depth in zip(deep.tolist(), lcp[deep].tolist()):
        if k != before + 1:
            while stack:
                yield from closed(*stack.pop(), before + 1)
        before, left = k, k - 1
        while stack and stack[-1][0] > depth:
            below = stack.pop()
            left = below[1][0]
            yield from closed(*below, k)
        if stack and stack[-1][0] == depth:
            stack[-1][1].append(k)
        else:
            stack.append((depth, [left, k]))
    while stack:
        yield from closed(*stack.pop(), before + 1)


def branching_squares(ids: np.ndarray) -> np.ndarray:
    """``end, depth`` of every square of DEPTH or more words that the next word does not prolong, in order."""
    n = len(ids)
    sa, place, lcp = suffix_array(ids)
    found, held, size = [np.empty(0, np.int64)], [], 0

    def tested() -> np.ndarray:
        first, end, left, right, depth = np.array(held, np.int64).T
        times = end - first
        which = np.repeat(np.arange(len(held)), times)
        i = sa[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + first[which]]
        d, low, high = depth[which], left[which], right[which]
        out = []
        for start, other in ((i, i + d), (i - d, i - d)):  # the suffix is the square's first or its second half
            inside = np.flatnonzero((other >= 0) & (other < n))
            inside = inside[(place[other[inside]] >= low[inside]) & (place[other[inside]] < high[inside])]
            s, w = start[inside], d[inside]
            e = s + 2 * w
            branch = (e >= n) | (ids[np.minimum(e, n - 1)] != ids[s + w])
            out.append(e[branch] * (n + 1) + w[branch])
        return np.concatenate(out)

    for child in small_children(lcp):
        held.append(child)
        size += child[1] - child[0]
        if size >= ITEMS:
            found.append(tested())
            held, size = [], 0
    if held:
        found.append(tested())
    both = np.unique(np.concatenate(found))
    return np.stack([both // (n + 1), both % (n + 1)], 1)


def _leftmost(ids: np.ndarray, end: int, period: int) -> int:
    """Where the stretch up to end whose words a period apart are equal begins: its squares rotated to the left."""
    at, step = end - period, max(period, 16)
    while at > 0:
        low = max(0, at - step)
        apart = np.flatnonzero(ids[low:at] != ids[low + period : at + period])
        if len(apart):
            return low + int(apart[-1]) + 1
        at, step = low, 2 * step
    return 0


def word_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence of word numbers, by start, then period.

    A run is a stretch with smallest period q of at least ``max(SHORTEST, TIMES * q)`` words that no
    neighbouring word extends. Each shows once as a primitive square at its end; squares of
    multiples of its period end there too and are merged into it.
    """
    if not repeats(ids):
        return []
    out, last, known = [], -1, []
    for end, depth in branching_squares(ids).tolist():
        if end != last:
            last, known = end, []
        if any(depth % q == 0 and end - 2 * depth >= start for start, q in known):
            continue
        period = depth
        if depth < 2 * DEPTH:  # it may be a multiple of a period below DEPTH
            whole = ids[end - 2 * depth : end]
            period = next(q for q in range(1, depth + 1) if depth % q == 0 and (q >= DEPTH or (whole[q:] == whole[:-q]).all()))
            period = period if period < DEPTH else depth
        start = _leftmost(ids, end, period)
        known.append((start, period))
        if end - start >= max(SHORTEST, TIMES * period):
            out.append((start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def analysed(text: bytes) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """Number of words, runs, and the words that no run holds beyond its first period, joined by blanks."""
    words = text.split()  # at blanks and the five line and tab controls
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = word_runs(ids)
    if found:
        keep = np.ones(len(words), bool)
        for start, length, period in found:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return len(ids), found, b" ".join(words)


def find_runs(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists start, length and period of every run of words, by start, then period;
    ``collapsed`` is the text without the repeated part of every run, its words joined by single
    blanks. Words are what lies between blanks and line and tab controls and count as equal only
    if their bytes are. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. Every row is worked on by itself in the task that reads it, nothing is shuffled: repeated
    rows give repeated results, an empty table none. Whole texts are looked at whatever their
    length; memory grows with the longest text, by about 300 bytes for each of its words. Columns
    with one of the three new names are replaced, others are kept.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, texts in slices(batch, "text"):
            counts, found, kept = zip(*map(analysed, texts))
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            columns = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], ["start", "length", "period"])
            offsets = pa.array(np.append(0, np.cumsum([len(r) for r in found])).astype(np.int32))
            ours = [batch.column(c).slice(start, len(texts)) for c in names]
            made = [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, columns), pa.array(kept, pa.string())]
            yield pa.record_batch([*ours, *made], [*names, *ADDED])

    ship_package(docs.sparkSession)
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, own))
    schema = f"{kinds}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for n, c in zip(names, own)), F.col("text").alias("text"))
    out = arrow_map(rows, of, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, own)), *ADDED)
