"""Token sequences: tokenised pieces of documents, packed by bounded-space online best fit."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.text import NOT_BLANK, WordHashes, bounds, byte_class, slices
from timbrelake.session import scratch_path, ship_package

LENGTH = 2048
#: Bins that a packer holds open.
OPEN_BINS = 16_384
#: Word parts whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1 << 20
TAIL = np.zeros(256, bool)
TAIL[list(b".,!?;:")] = True
PLAIN = byte_class("az 09")


class WordTokens:
    """Ids of texts under a tokenizer that drops blanks, from remembered ids of their parts.

    Parts are what stands between ASCII blanks, less one closing mark of ``.,!?;:`` after a letter
    or digit, which is a part of its own. The tokenizer cuts at these places anyway, so the ids of
    a text are those of its parts in order. The memory is a table with open addressing from 64-bit
    hashes of parts to runs in a pool of ids.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.hashes, self.remembered = WordHashes(), remembered
        self._forget()

    def _forget(self) -> None:
        self.slots = np.zeros(1 << (2 * self.remembered - 1).bit_length(), np.uint64)
        self.entry = np.zeros(len(self.slots), np.int32)
        self.mask = np.uint64(len(self.slots) - 1)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 1
        #: Entry 0 is the end of a document.
        self.at, self.size, self.entries = np.zeros(1 << 14, np.int64), np.ones(1 << 14, np.int64), 1

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        left, place = np.arange(len(h)), h & self.mask
        while len(left):
            there = self.slots[place]
            hit = there == h[left]
            out[left[hit]] = self.entry[place[hit]]
            go = ~hit & (there != 0)
            left, place = left[go], (place[go] + np.uint64(1)) & self.mask
        return out

    def _add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        """New entries; the hashes are distinct and not in the table."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros(len(self.pool), np.uint32))
        while self.entries + len(ids) > len(self.at):
            self.at, self.size = (np.append(x, np.zeros(len(x), np.int64)) for x in (self.at, self.size))
        self.pool[self.used : self.used + len(flat)] = flat
        fresh = slice(self.entries, self.entries + len(ids))
        self.at[fresh], self.size[fresh] = self.used + np.cumsum(sizes) - sizes, sizes
        number = np.arange(self.entries, self.entries + len(ids), dtype=np.int32)
        self.used, self.entries = self.used + len(flat), self.entries + len(ids)
        place = h & self.mask
        while len(h):
            free = self.slots[place] == 0
            self.slots[place[free]] = h[free]
            mine = free & (self.slots[place] == h)
            self.entry[place[mine]] = number[mine]
            h, number, place = h[~mine], number[~mine], (place[~mine] + np.uint64(1)) & self.mask

    def _encode(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of each part; those of letters alone go in one call, cut where a word ends."""
        out: list = [None] * len(parts)
        letters = [i for i, p in enumerate(parts) if p.isalpha()]
        ids = np.array(self.tokenizer.encode(" ".join([parts[i] for i in letters]), add_special_tokens=False).ids, np.uint32)
        cuts = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else np.empty(0, np.int64)
        if len(cuts) == len(letters):  # else a part is no single word to the tokenizer
            for i, run in zip(letters, np.split(ids, cuts)):
                out[i] = run
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, made in zip(rest, self.tokenizer.encode_batch([parts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(made.ids, np.uint32)
        return out

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the id 0 behind it, and where each text ends."""
        joined = b"\n".join(texts).lower()
        data = np.frombuffer(joined, np.uint8)
        starts, ends = bounds(data, NOT_BLANK)
        row_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        accented = (data[np.maximum(ends - 3, 0)] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        tail = (ends - starts > 1) & TAIL[last] & (PLAIN[before] | accented & (ends - starts > 2))
        closing = ends[tail] - 1
        ends = ends - tail
        order = np.argsort(np.concatenate([starts, closing, row_ends]), kind="stable")
        starts = np.concatenate([starts, closing, row_ends])[order]
        ends = np.concatenate([ends, closing + 1, row_ends])[order]
        row = order >= len(order) - len(texts)
        part = np.flatnonzero(~row)
        h = self.hashes(data, starts[part], ends[part])
        h[h == 0] = 1
        found = self._find(h)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            if self.entries + len(missing) > self.remembered and self.entries > 1:
                self._forget()
                missing = np.arange(len(h))
            _, one = np.unique(h[missing], return_index=True)
            one = missing[one]
            while 2 * (self.entries + len(one)) > len(self.slots):  # a slice with more parts than are remembered
                self.remembered *= 2
                self._forget()
                one = np.unique(h, return_index=True)[1]
            which = part[one]
            parts = [joined[s:e].decode() for s, e in zip(starts[which].tolist(), ends[which].tolist())]
            self._add(h[one], self._encode(parts))
            found = self._find(h)
        entry = np.zeros(len(order), np.int64)
        entry[part] = found
        sizes = self.size[entry]
        upto = np.cumsum(sizes)
        ids = self.pool[np.arange(upto[-1]) + np.repeat(self.at[entry] - upto + sizes, sizes)]
        return ids, upto[row]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and ``ids`` for every piece of every document.

    A document is its ids and the id 0; only documents beyond ``length`` are cut. ``ids`` are
    little-endian unsigned 32-bit numbers; without ``with_ids`` they stay in the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        step = 4 * length
        for batch in batches:
            for start, texts in slices(batch):
                rows: list[tuple] = []
                ids, ends = tokens(texts)
                flat = memoryview(ids.astype("<u4").tobytes())
                for r, (low, high) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                    own = flat[4 * low : 4 * high]
                    for p, at in enumerate(range(0, len(own), step)):
                        part = own[at : at + step]
                        rows.append((start + r, p, at // 4, len(part) // 4, zlib.crc32(part), bytes(part) if with_ids else None))
                row, *columns = zip(*rows)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                arrays = [batch.column("doc_id").take(pa.array(row)), *arrays]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                wide = len(names) - (not with_ids)
                yield pa.record_batch(arrays[:wide], names[:wide])

    ship_package(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class BestFit:
    """Online best fit with a fixed number of open bins.

    ``levels`` has bit f set if a bin with f free places is open; ``bins`` lists those bins. The
    fullest bin that still takes a piece is the lowest set bit at or above its length. When one
    more bin than allowed is open, the fullest closes first; a full bin closes at once.
    """

    def __init__(self, length: int, open_bins: int) -> None:
        self.length, self.open_bins = length, open_bins
        self.levels, self.count, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, size: int) -> tuple[int, int]:
        """Bin of the piece and its place there."""
        above = self.levels >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.length, self.made
            self.made += 1
        left = free - size
        if left:
            self.bins[left].append(bin_)
            self.levels |= 1 << left
            self.count += 1
            if self.count > self.open_bins:
                self._take((self.levels & -self.levels).bit_length() - 1)
        return bin_, self.length - free

    def _take(self, free: int) -> int:
        bin_ = self.bins[free].pop()
        if not self.bins[free]:
            self.levels &= ~(1 << free)
        self.count -= 1
        return bin_


def pack(table: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, sequences: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have ``doc_id``, ``piece`` and ``length``.

    Packers are hash buckets of about ``sequences`` sequences, so their number follows the data;
    each takes its pieces in falling length and holds ``open_bins`` bins. Which pieces meet
    depends on the rows alone, so a repeated task gives the same sequences.
    """
    total = table.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    packers = max(1, -(-total // (length * sequences)))
    names = table.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in table.dtypes) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bins = None, None
        for batch in batches:
            ids, places = [], []
            for p, size in zip(batch.column("_packer").to_pylist(), batch.column("length").to_pylist()):
                if p != packer:
                    packer, bins = p, BestFit(length, open_bins)
                bin_, place = bins.put(size)
                ids.append(p << 32 | bin_)
                places.append(place)
            columns = [batch.column(n) for n in names]
            yield pa.record_batch([*columns, pa.array(ids, pa.int64()), pa.array(places, pa.int64())], [*names, "sequence_id", "offset"])

    ship_package(table.sparkSession)
    placed = table.withColumn("_packer", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(packers)))
    ordered = placed.repartition("_packer").sortWithinPartitions("_packer", F.desc("length"), "doc_id", "piece")
    return ordered.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Null and empty texts are one piece that holds id 0. Every row is packed, also repeated rows
    and rows with a null doc_id; extra columns are ignored; an empty table gives no rows. Long
    texts are cut into full pieces and one rest. The table of pieces (without ids) is written to
    the shared folder, as it is read for its total and for packing.
    """
    path = scratch_path(docs.sparkSession, "pieces")
    pieces(docs, tokenizer, length, with_ids=False).write.parquet(path)
    return pack(docs.sparkSession.read.parquet(path), length)
