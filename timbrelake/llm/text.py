"""Whole texts inside Arrow batches: bounded slices of bytes, word bounds and word hashes as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19


def byte_class(members: str) -> np.ndarray:
    """Table of 256 booleans from a description such as ``"09 az \\x80\\xff"`` (pairs of bounds)."""
    table = np.zeros(256, bool)
    for pair in members.split():
        low, high = pair.encode("latin-1")
        table[low : high + 1] = True
    return table


#: Bytes of words that are made of ASCII digits, small ASCII letters and everything beyond ASCII.
WORD = byte_class("09 az \x80\xff")
#: The other bytes than blanks and the five line and tab controls.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[bytes]]]:
    """Row number of the first text and the texts, about SLICE_BYTES at a time; null counts as empty."""
    values = batch.column(column).cast(pa.large_binary())
    start, taken, size = 0, [], 0
    for i, value in enumerate(values):
        text = value.as_py() or b""
        if taken and size + len(text) > SLICE_BYTES:
            yield start, taken
            start, taken, size = i, [], 0
        taken.append(text)
        size += len(text) + 1
    if taken:
        yield start, taken


def bounds(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of bytes that the table holds."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class WordHashes:
    """64-bit hashes of the words of a buffer, from prefix sums of a polynomial with wrap-around."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self) -> None:
        values = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values = values * np.uint64(2) + np.uint64(1)
        self._grow(SLICE_BYTES + 4096)

    def _grow(self, size: int) -> None:
        self.size = size
        self.powers = self._table(self.BASE, size)
        self.inverses = self._table(self.INVERSE, size)

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        table = np.full(size, base, np.uint64)
        table[0] = 1
        return np.cumprod(table)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each ``data[start:end]``; starts ascend."""
        step = SLICE_BYTES
        if len(data) <= self.size:
            return self._within(data, starts, ends)
        out, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):  # a text beyond the tables goes in pieces that end between words
            first = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, first + step, "right")))
            last = int(ends[j - 1])
            if last - first > self.size:
                self._grow(int(last - first))
            out[i:j] = self._within(data[first:last], starts[i:j] - first, ends[i:j] - first)
            i = j
        return out

    def _within(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Finishing step: every bit of the result depends on every bit of the input."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` successive values."""
    n = max(len(h) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return total


class Slice:
    """Lower-cased (A-Z) texts joined by newlines, with the words of each."""

    def __init__(self, texts: list[bytes], table: np.ndarray = WORD) -> None:
        self.joined = b"\n".join(texts).lower()
        self.data = np.frombuffer(self.joined, np.uint8)
        self.starts, self.ends = bounds(self.data, table)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.row_ends = np.cumsum(sizes) - 1
        self.row_starts = self.row_ends - sizes + 1
        #: Words of row r are those from first[r] to first[r + 1].
        self.first = np.append(np.searchsorted(self.starts, self.row_starts), len(self.starts))

    def words(self, low: int, high: int) -> list[bytes]:
        return [self.joined[s:e] for s, e in zip(self.starts[low:high].tolist(), self.ends[low:high].tolist())]


def arrow_map(frame, function: Callable, schema: str):
    """``mapInArrow`` with a function from one record batch to the batches it gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return frame.mapInArrow(run, schema)
