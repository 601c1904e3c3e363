"""SimHash near-duplicates: 64-bit fingerprints, bit-sliced comparison within blocks, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.components import connected_components
from timbrelake.llm.text import NOT_BLANK, arrow_map, bounds, slices
from timbrelake.session import scratch_path, ship_package

WIDTH = 4
SEED = 42
RADIUS = 4
#: The bits fall into RADIUS + 2 pieces, of which two are free of differences in every linked pair.
PIECES = (11, 11, 11, 11, 10, 10)
#: Fingerprints of a block that one task compares; larger blocks are cut into slabs of this size.
SLAB = 32_768
#: Pairs of a fingerprint and 64 others that are compared at once.
ITEMS = 1 << 16
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def slice_fingerprints(texts: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Fingerprints of texts: bit set if set in over half of the hashes of the word runs."""
    from xxhash import xxh64_intdigest

    raw = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    solid = NOT_BLANK[raw]
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # one blank after each word
    packed = raw[keep]
    packed[~solid[keep]] = 0x20
    data = packed.tobytes()
    starts, ends = bounds(packed, NOT_BLANK)
    word_starts = np.flatnonzero(solid & ~np.append(False, solid[:-1])) if len(raw) else starts
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    first = np.searchsorted(word_starts, np.append(0, np.cumsum(sizes)))
    counts = np.diff(first)
    runs = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    offset = np.append(0, np.cumsum(runs))
    rank = np.arange(offset[-1]) - np.repeat(offset[:-1], runs)
    begin = np.repeat(first[:-1], runs) + rank
    end = np.minimum(begin + width, np.repeat(first[1:], runs)) - 1
    hashes = np.array(
        [xxh64_intdigest(data[s:e], SEED) for s, e in zip(starts[begin].tolist(), ends[end].tolist())],
        np.uint64,
    )
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(runs)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.add.reduceat(bits, offset[full], axis=0, dtype=np.int32)
        major = total * 2 > runs[full, None]
        out[full] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def identified(docs: DataFrame) -> DataFrame:
    """Rows with a number of their own, ``_uid``, which a table gives again whenever it is read."""
    return docs.withColumn("_uid", F.monotonically_increasing_id())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(uid, doc_id, fp)`` for each row of :func:`identified`, fp the fingerprint's bits as a long."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, texts in slices(batch):
            fp = slice_fingerprints(texts).view(np.int64)
            ids = [batch.column(c).slice(start, len(texts)) for c in ("_uid", "doc_id")]
            yield pa.record_batch([*ids, pa.array(fp)], ["uid", "doc_id", "fp"])

    ship_package(docs.sparkSession)
    return arrow_map(docs.select("_uid", F.col("doc_id").cast("long").alias("doc_id"), "text"), of, "uid long, doc_id long, fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Plane p holds bit p of 64 values in each of its words; the number of values divides by 64."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_radius(planes: np.ndarray, query: np.ndarray, block: np.ndarray, valid: np.ndarray, radius: int):
    """Which of the 64 values of each item's block lie within the radius of the item's query.

    Three-bit (for radius 4) counters stand vertically, one bit of 64 counters in a word. They
    start so that the count radius + 1 overflows. Two planes at a time enter by a carry-save
    adder; items are abandoned once every counter of their block has overflowed. Gives the
    surviving items and their masks.
    """
    depth = int(radius).bit_length()
    begin = (1 << depth) - 1 - radius
    item = np.arange(len(query))
    count = [np.full(len(query), ONES if begin >> k & 1 else 0, np.uint64) for k in range(depth)]
    over = ~valid[block]
    for p in range(0, 64, 2):
        one = planes[p][block] ^ (np.uint64(0) - (query >> np.uint64(p) & np.uint64(1)))
        two = planes[p + 1][block] ^ (np.uint64(0) - (query >> np.uint64(p + 1) & np.uint64(1)))
        half = count[0] ^ one
        carry = (count[0] & one) | (half & two)
        count[0] = half ^ two
        for k in range(1, depth):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if p % 8 == 6:
            live = over != ONES
            if not live.all():
                item, query, block, over = item[live], query[live], block[live], over[live]
                count = [c[live] for c in count]
            if not len(item):
                break
    return item, ~over


def local_roots(n: int, a: np.ndarray, b: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """Least member of each node's component under the links a-b (and those that roots stand for)."""
    roots = np.arange(n) if roots is None else roots
    while len(a):
        least = np.minimum(roots[a], roots[b])
        np.minimum.at(roots, roots[a], least)
        np.minimum.at(roots, roots[b], least)
        while not np.array_equal(jumped := roots[roots], roots):
            roots = jumped
        open_ = roots[a] != roots[b]
        a, b = a[open_], b[open_]
    return roots


def run_links(keys: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links between each fingerprint and the least one that it reaches within its run of equal keys.

    Both arrays are sorted by key, then fingerprint; runs are compared whole, 64 fingerprints at
    a time. All pairs in the radius are found; what is given is one link for each fingerprint.
    """
    n = len(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if n else np.empty(0, np.int64)
    size = np.diff(np.append(first, n))
    many = size > 1
    if not many.any():
        return fps[:0], fps[:0]
    member = np.repeat(many, size)
    fps, size = fps[member], size[many]
    first = np.cumsum(size) - size
    blocks = (size + 63) // 64
    first_block = np.cumsum(blocks) - blocks
    run = np.repeat(np.arange(len(size)), size)
    rank = np.arange(len(fps)) - first[run]
    lane = first_block[run] * 64 + rank
    values = np.zeros(int(blocks.sum()) * 64, np.uint64)
    values[lane] = fps
    there = np.zeros(len(values), np.uint8)
    there[lane] = 1
    valid = np.packbits(there, bitorder="little").view(np.uint64)
    row_of = np.zeros(len(values), np.int64)
    row_of[lane] = np.arange(len(fps))
    planes = bit_planes(values)
    own = lane // 64
    last = first_block[run] + blocks[run]
    work = np.cumsum(last - own)
    roots, at = np.arange(len(fps)), 0
    while at < len(fps):
        done = work[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(work, done + ITEMS, "right")))
        times = (last - own)[at:upto]
        query = np.repeat(np.arange(at, upto), times)
        block = own[query] + np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times)
        item, mask = within_radius(planes, fps[query], block, valid, radius)
        found = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, bit = np.nonzero(found)
        a, b = query[item[i]], row_of[block[item[i]] * 64 + bit]
        roots = local_roots(len(fps), a[b > a], b[b > a], roots)
        at = upto
    moved = roots != np.arange(len(fps))
    return fps[moved], fps[roots[moved]]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys from sorted batches; a run may reach over several batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def links(keys, fps):
        a, b = run_links(keys, fps)
        a, b = a.view(np.int64), b.view(np.int64)
        if len(a):
            pairs = np.unique(np.stack([a, b], 1), axis=0)
            yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        size += batch.num_rows
        if size >= ITEMS:
            keys, fps = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(keys, keys[-1]))
            yield from links(keys[:cut], fps[:cut])
            held, size = [(keys[cut:], fps[cut:])], len(keys) - cut
    if held:
        yield from links(*(np.concatenate(x) for x in zip(*held)))


def _keys(column) -> list:
    """One key for each choice of two pieces: number of the choice and the bits of both."""
    shifts = np.cumsum((0, *PIECES[:-1])).tolist()
    part = [F.shiftrightunsigned(column, s).bitwiseAND((1 << w) - 1) for s, w in zip(shifts, PIECES)]
    pairs = list(combinations(range(len(PIECES)), 2))
    return [F.lit(n << 32).bitwiseOR(F.shiftleft(part[i], 11)).bitwiseOR(part[j]).alias("key") for n, (i, j) in enumerate(pairs)]


def links(distinct: DataFrame, slab: int = SLAB) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of fingerprints ``fp`` in the radius.

    Each fingerprint is compared within fifteen blocks, of which a pair in the radius shares at
    least one. Blocks beyond ``slab`` rows are cut into slabs and each pair of slabs is a block,
    so no pair is lost and no task holds more than two slabs.
    """
    keyed = distinct.select("fp", F.explode(F.array(*_keys(F.col("fp")))).alias("key"))
    hot = keyed.groupBy("key").count().where(F.col("count") > slab)
    plain = keyed
    if not hot.isEmpty():
        sized = keyed.join(hot, "key", "left")
        parts = F.ceil(F.col("count") / slab).cast("int")
        mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        cut = (
            sized.where("count is not null").withColumn("parts", parts).withColumn("mine", mine)
            .withColumn("other", other)
            .select("fp", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"))
        )
        plain = sized.where("count is null").select("fp", "key").union(cut)
    placed = plain.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return placed.mapInArrow(_linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` for every row.

    Words are what lies between blanks after A-Z are lower-cased; runs of four words are hashed,
    repeats included; a shorter text is one run. A null or empty text has fingerprint zero and is
    linked like any other. Fingerprints with four or fewer differing bits are linked. The
    component's name is the least doc_id reachable; a null doc_id names none, repeated rows stay.
    Extra columns are ignored, an empty table gives no rows. Equal fingerprints are one node, so
    groups of copies cost one comparison. Fingerprints are written to the shared folder once.
    """
    table, rooted = _rooted(identified(docs.select("doc_id", "text")))
    named = rooted.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return table.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written table of fingerprints, and each distinct one with its first row and its root."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs).write.parquet(path)
    table = spark.read.parquet(path)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")).alias("least")
    nodes = table.groupBy("fp").agg(first)
    roots = connected_components(links(nodes.select("fp")))
    rooted = nodes.join(roots, F.col("node") == F.col("fp"), "left")
    return table, rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each near-duplicate group the row with the least doc_id (nulls last), all columns kept.

    Groups are those of :func:`near_duplicates`; of equal doc_ids the first row stays. Texts are
    shuffled once, to keep the rows that were chosen.
    """
    rows = identified(docs)
    _, rooted = _rooted(rows)
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.uid").alias("_uid"))
    return rows.join(kept, "_uid", "left_semi").select(*(f"`{c}`" for c in docs.columns))
