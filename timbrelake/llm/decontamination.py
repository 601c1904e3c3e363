"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact similarity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.text import Slice, WordHashes, arrow_map, mixed, slices, windows
from timbrelake.session import ship_package

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits of 128 up to which fingerprints are candidates. At similarity 0.8 the angle between
#: shingle counts gives 19 on average with a deviation of 4; unrelated windows differ in 64 with 6.
RADIUS = 40
#: Fingerprints are cut into 16 bytes; within the radius one byte differs in at most two bits.
BYTES = 16
#: Bytes of item texts that are held by every task at once; more items go in several passes.
ITEM_BYTES = 1 << 20


def simhash(shingles: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """128-bit fingerprints (two words each): majority of the bits of each row's shingles, weighted by count."""
    both = np.stack([shingles, mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))], 1)
    bits = np.unpackbits(both.view(np.uint8).reshape(-1, 8 * BYTES // 8), axis=1, bitorder="little")
    first = np.searchsorted(rows, np.arange(n))
    total = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    size = np.diff(np.append(first, len(rows)))
    return np.packbits(2 * total > size[:, None], axis=1, bitorder="little").view(np.uint64)


def shingles_of(words: list[bytes], width: int = SHINGLE) -> Counter:
    """Shingles with their weights, which are their counts; a shorter text is one shingle."""
    if len(words) < width:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    shared = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - shared
    return shared / whole if whole else 0.0


class Items:
    """Benchmark items by number of words, with fingerprints and their multi-index blocks."""

    def __init__(self, items: list[tuple], threshold: float = SIMILARITY, radius: int = RADIUS) -> None:
        self.threshold, self.radius, self.hashes = threshold, radius, WordHashes()
        texts = [(x or "").encode() for _, x in items]
        part = Slice(texts)
        h = self.hashes(part.data, part.starts, part.ends)
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None])
        self.ids, self.counts, self.groups, known = [i for i, _ in items], [], {}, {}
        sized: dict[int, list[int]] = {}
        for k in range(len(items)):
            low, high = int(part.first[k]), int(part.first[k + 1])
            self.counts.append(shingles_of(part.words(low, high)))
            if high > low:
                sized.setdefault(high - low, []).append(k)
        for n, members in sized.items():
            width = min(n, SHINGLE)
            own = [windows(h[part.first[k] : part.first[k + 1]], width) for k in members]
            known.setdefault(width, []).extend(own)
            prints = simhash(np.concatenate(own), np.repeat(np.arange(len(own)), n - width + 1), len(own))
            blocks = prints.view(np.uint8).reshape(len(own), BYTES)
            reach = np.stack([near[:, blocks[:, b]] <= radius // BYTES for b in range(BYTES)])
            self.groups[n] = (np.array(members), prints, reach)
        self.known = {w: np.unique(np.concatenate(x)) for w, x in known.items()}
        self.bitmap = {}
        for width, values in self.known.items():
            self.bitmap[width] = np.zeros(1 << 20, bool)
            self.bitmap[width][values & np.uint64((1 << 20) - 1)] = True

    def _hits(self, shingles: np.ndarray, width: int) -> np.ndarray:
        """Which shingles occur in some item."""
        hit = self.bitmap[width][shingles & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(hit)
        place = np.searchsorted(self.known[width], shingles[at])
        hit[at] = self.known[width][np.minimum(place, len(self.known[width]) - 1)] == shingles[at]
        return hit

    def _near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a window and an item of n words whose fingerprints lie in the radius, and their distance.

        ``reach[b][v]`` marks the items whose byte b differs from v in few enough bits; a pair in the
        radius is marked for at least one of the sixteen bytes.
        """
        members, own, reach = self.groups[n]
        blocks = prints.view(np.uint8).reshape(len(prints), BYTES)
        near = np.zeros((len(prints), len(members)), bool)
        for b in range(BYTES):
            near |= reach[b][blocks[:, b]]
        w, i = np.nonzero(near)
        far = np.bitwise_count(prints[w] ^ own[i]).sum(1, dtype=np.int64)
        ok = far <= self.radius
        return w[ok], members[i[ok]], far[ok]

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, float, int, int]]:
        """``(text, item, similarity, first word, words)`` for each text and item that match.

        A window matches by its shingles alone, so windows in which too few shingles occur in any
        item are passed over before they get a fingerprint; that loses none.
        """
        part, out = Slice(texts), []
        h = self.hashes(part.data, part.starts, part.ends)
        lengths = sorted(self.groups)
        for width in self.known:
            shingles = windows(h, width)
            hits = np.append(0, np.cumsum(self._hits(shingles, width)))
            upto = np.maximum(np.minimum(part.first[1:] - width + 1, len(shingles)), part.first[:-1])
            upto = np.minimum(upto, len(shingles))
            begin = np.minimum(part.first[:-1], len(shingles))
            inside = hits[upto] - hits[begin]
            sizes = [n for n in lengths if min(n, SHINGLE) == width]
            for t in np.flatnonzero(inside):
                out.extend(self._in_text(part, shingles, hits, int(t), width, [n for n in sizes if inside[t] >= self._need(min(n - width + 1, int(upto[t] - begin[t])), n - width + 1)]))
        return sorted(out)

    def _need(self, a: int, b: int) -> float:
        return self.threshold * (a + b) / (1 + self.threshold) - 1e-9

    def _in_text(self, part: Slice, shingles, hits, t: int, width: int, sizes: list[int]) -> Iterator[tuple]:
        low, high = int(part.first[t]), int(part.first[t + 1])
        found: dict[int, list[tuple]] = {}
        for n in sizes:
            mine = min(n, high - low)  # a text shorter than the item is one window
            m = mine - width + 1
            if m < 1 or m < self.threshold * (n - width + 1):
                continue
            at = np.arange(low, high - mine + 1)
            at = at[hits[at + m] - hits[at] >= self._need(m, n - width + 1)]
            for some in (at[i : i + 4096] for i in range(0, len(at), 4096)):
                grid = some[:, None] + np.arange(m)[None]
                prints = simhash(shingles[grid.ravel()], np.repeat(np.arange(len(some)), m), len(some))
                for w, item, far in zip(*(x.tolist() for x in self._near(prints, n))):
                    found.setdefault(item, []).append((far, int(some[w]), mine))
        for item, places in found.items():
            for _, start, n in sorted(places):
                same = similarity(shingles_of(part.words(start, start + n)), self.counts[item])
                if same >= self.threshold:
                    yield t, item, same, start - low, n
                    break


_BUILT: dict[tuple, Items] = {}


def _items(held, key: tuple) -> Items:
    """The index of a broadcast, made once in each worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Items(held.value, *key[1:])
    return _BUILT[key]


def item_blocks(benchmark: DataFrame, most: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """All items in blocks of about ``most`` bytes of text, one block on the driver at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if block and size + len(row.text) > most:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text) + 64
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS, most: int = ITEM_BYTES) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words`` for each document row and item that it holds.

    Words are runs of digits, letters and characters beyond ASCII, after A-Z are lower-cased. A
    window has as many words as the item (or is the whole text, if that is shorter). Fingerprints
    of windows and items that differ in ``radius`` bits or less are candidates; the weighted
    Jaccard similarity of their five-word shingles decides. Of several windows the one with the
    nearest fingerprint that passes is given. Items of fewer than five words are one shingle and
    match where their words stand together; items without words match nothing, as do null and
    empty texts. Repeated rows and items count one by one; other columns are ignored; an empty
    table on either side gives no rows. Documents are read once for every ``most`` bytes of items
    and never shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    out = None
    for number, block in enumerate(item_blocks(benchmark, most)):
        held = spark.sparkContext.broadcast(block)
        key = (f"{spark.sparkContext.applicationId}-{held._jbroadcast.id()}", threshold, radius)

        def of(batch: pa.RecordBatch, held=held, key=key) -> Iterator[pa.RecordBatch]:
            items = _items(held, key)
            for start, texts in slices(batch):
                if rows := items.matches(texts):
                    t, item, same, first, n = zip(*rows)
                    doc = batch.column("doc_id").take(pa.array([start + x for x in t]))
                    ids = pa.array([items.ids[k] for k in item], pa.int64())
                    yield pa.record_batch([doc, ids, pa.array(same), pa.array(first, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "item_id", "similarity", "start_word", "n_words"])

        found = arrow_map(source, of, schema)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS, most: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item (see :func:`leaks`), all columns kept."""
    spark = docs.sparkSession
    ship_package(spark)
    for block in item_blocks(benchmark, most):
        held = spark.sparkContext.broadcast(block)
        key = (f"{spark.sparkContext.applicationId}-{held._jbroadcast.id()}", threshold, radius)

        def of(batch: pa.RecordBatch, held=held, key=key) -> Iterator[pa.RecordBatch]:
            items = _items(held, key)
            keep = np.ones(batch.num_rows, bool)
            for start, texts in slices(batch):
                keep[[start + row[0] for row in items.matches(texts)]] = False
            yield batch.filter(pa.array(keep))

        docs = arrow_map(docs, of, docs.schema)
    return docs
