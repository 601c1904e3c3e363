"""Near-duplicate groups by shingle similarity: op5's fingerprints and MinHash bands propose, exact Jaccard of five-word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.llm import near_dedup
from timbrelake.llm.components import connected_components
from timbrelake.llm.near_dedup import identified, local_roots
from timbrelake.llm.text import NOT_BLANK, Slice, WordHashes, arrow_map, mixed, slices, windows
from timbrelake.session import scratch_path, ship_package

SHINGLE = 5
SIMILARITY = 0.8
#: A band is the least values of ROWS hashes. At similarity 0.8 a pair shares a band with a chance of
#: 0.41, so that it shares none of 32 with one of 5e-8.
BANDS, ROWS = 32, 4
#: Shingles whose hashes are made at once.
BLOCK = 1 << 16
#: Nodes and shingles of a slab of a band; a block is a pair of slabs.
SLAB_NODES, SLAB_SHINGLES = 1_024, 1 << 20
#: Shingles of at most so many sets count pair by pair, the others by matrix products of so many columns.
RARE, COLUMNS = 8, 2_048
MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: list[bytes], hashes: WordHashes) -> list[np.ndarray]:
    """Distinct hashed shingles of each text, ascending; a text of fewer than five words is one shingle."""
    part = Slice(texts, NOT_BLANK)
    h = hashes(part.data, part.starts, part.ends)
    out = []
    for low, high in zip(part.first[:-1].tolist(), part.first[1:].tolist()):
        width = min(SHINGLE, high - low)
        out.append(np.unique(windows(h[low:high], width)) if width else h[:0])
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Keys of the bands of sets that are not empty, one row each."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    least = np.empty((len(sets), BANDS * ROWS), np.uint32)
    at = 0
    while at < len(sets):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK, "right")) + at)
        h = (np.concatenate(sets[at:upto]) >> np.uint64(32)).astype(np.uint32)
        first = np.cumsum(sizes[at:upto]) - sizes[at:upto]
        for k, m in enumerate(MULTIPLIERS):
            least[at:upto, k] = np.minimum.reduceat(h * m, first)
        at = upto
    values = least.astype(np.uint64).reshape(len(sets), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sets), BANDS))
    for r in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, r] + np.uint64(1))
    return keys


def sketches(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, one, two, n, bands, fp`` of each row of :func:`identified`.

    one and two are 128 bits of its set of shingles, fp is the fingerprint of :mod:`near_dedup`.
    """

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for start, texts in slices(batch):
            sets = shingle_sets(texts, hashes)
            n = np.fromiter(map(len, sets), np.int32, len(sets))
            one, two = (
                mixed(np.array([mixed(s ^ np.uint64(x)).sum(dtype=np.uint64) for s in sets], np.uint64)).view(np.int64)
                for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F)
            )
            full = np.flatnonzero(n)
            keys = band_keys([sets[i] for i in full]).view(np.int64) if len(full) else np.empty((0, BANDS), np.int64)
            offsets = np.append(0, np.cumsum(np.where(n > 0, BANDS, 0))).astype(np.int32)
            ids = [batch.column(c).slice(start, len(texts)) for c in ("_uid", "doc_id")]
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            fp = pa.array(near_dedup.slice_fingerprints(texts).view(np.int64))
            yield pa.record_batch([*ids, pa.array(one), pa.array(two), pa.array(n), bands, fp], ["uid", "doc_id", "one", "two", "n", "bands", "fp"])

    ship_package(docs.sparkSession)
    rows = docs.select("_uid", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, of, "uid long, doc_id long, one long, two long, n int, bands array<long>, fp long")


_HASHES: list[WordHashes] = []


def _hashes() -> WordHashes:
    """The hash tables of a worker, made once."""
    if not _HASHES:
        _HASHES.append(WordHashes())
    return _HASHES[0]


def _verified(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets of shingles are similar; texts are read from a row of each."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, good = _hashes(), np.zeros(batch.num_rows, bool)
        for start, left in slices(batch, "text_a"):
            upto = start + len(left)
            right = batch.slice(start, len(left))
            done = start
            for _, texts in slices(right, "text_b"):
                one = shingle_sets(left[done - start : done - start + len(texts)], hashes)
                for i, (x, y) in enumerate(zip(one, shingle_sets(texts, hashes))):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good[done + i] = shared >= similarity * (len(x) + len(y) - shared) - 1e-9
                done += len(texts)
            assert done == upto
        yield batch.select(["a", "b"]).filter(pa.array(good))

    texts = _texts(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), rows, nodes)
    both = (
        pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    )
    return arrow_map(both, of, "a long, b long")


def _texts(wanted: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` of one row of each of the wanted nodes."""
    uids = nodes.join(wanted, "node", "left_semi").select("node", F.col("least.uid").alias("_uid"))
    return rows.select("_uid", "text").join(uids, "_uid").select("node", "text")


def _kept(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _sized(a: str, b: str, similarity: float) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9


def _close(nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that the fingerprints propose, as many as connect what they connect.

    Each node is paired with the least one of its fingerprint, and these where
    :func:`near_dedup.links` links their fingerprints.
    """
    full = nodes.where("n > 0").select("fp", F.struct("node", "n").alias("y"))
    least = _kept(full.groupBy("fp").agg(F.min("y").alias("x")), "fingerprints")
    near = near_dedup.links(least.select("fp")).toDF("fp", "other")
    near = near.join(least, "fp").join(least.toDF("other", "y"), "other")
    pairs = least.join(full, "fp").select("x", "y").union(near.select("x", "y"))
    fit = (F.col("x.node") != F.col("y.node")) & _sized("x.n", "y.n", similarity)
    return pairs.where(fit).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def links(rows: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links whose components are those of all pairs of nodes that share a band and are similar.

    Each node is compared with those that its fingerprint proposes and with the least node of each
    of its bands first. What this connects is not compared again, so a large group of copies costs
    a few comparisons for each member. The nodes of bands that are not connected then are compared
    where they meet, see ``_open_links``.
    """
    keyed = nodes.where("n > 0").select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("times"), F.min(F.struct("node", "n")).alias("star")).where("times > 1")
    members = _kept(keyed.join(shared.select("key", "star"), "key"), "bands")
    tried = _kept(
        members.where(F.col("node") != F.col("star.node")).where(_sized("n", "star.n", similarity))
        .select(F.col("star.node").alias("a"), F.col("node").alias("b")).union(_close(nodes, similarity)).distinct(), "tried",
    )
    first = _kept(_verified(tried, rows, nodes, similarity), "links")
    roots = connected_components(first)
    return first.union(_kept(_open_links(members, roots, rows, nodes, similarity), "links"))


def _open_links(members: DataFrame, roots: DataFrame, rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Links between similar nodes of a band that are not connected yet, as few as join their parts.

    Bands that still hold several parts are compared whole, each in one task that gets the texts
    of its nodes; bands with the same nodes once. A band of many nodes or shingles is cut into
    slabs, and every pair of slabs is a block of its own, so that no task holds more than two.
    """
    placed = members.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("part"))
    apart = (
        placed.groupBy("key")
        .agg(
            F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("size"), F.sum("n").alias("shingles"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .where("a <> b").groupBy("size", "shingles", "x", "y").agg(F.min("key").alias("key"))
    )
    slabs = F.greatest(F.ceil(F.col("size") / SLAB_NODES), F.ceil(F.col("shingles") / SLAB_SHINGLES)).cast("int")
    open_ = _kept(placed.join(apart.select("key", slabs.alias("slabs")), "key"), "open")
    mine = F.pmod(F.xxhash64("node"), F.col("slabs")).cast("int")
    dealt = open_.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1))).select(
        F.col("node").alias("of"), "part", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("block")
    )
    texts = _texts(open_.select("node").distinct(), rows, nodes).toDF("of", "text")
    blocks = dealt.join(texts, "of").select("block", "of", "part", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            part = table.column("part").to_numpy()
            if len(part) > 1 and (part != part[0]).any():
                batch = table.combine_chunks().to_batches()[0]
                sets = [s for _, texts in slices(batch) for s in shingle_sets(texts, _hashes())]
                a, b = similar_pairs(sets, similarity)
                roots = local_roots(len(part), *_joining(part, a, b))
                moved = np.flatnonzero(roots != np.arange(len(part)))
                of = table.column("of").to_numpy()
                yield pa.record_batch([pa.array(of[moved]), pa.array(of[roots[moved]])], ["a", "b"])

    ship_package(rows.sparkSession)
    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long").where("a <> b").distinct()


def _joining(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links between different parts."""
    apart = part[a] != part[b]
    return a[apart], b[apart]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal blocks from sorted batches; a run may reach over several."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column("block").to_numpy()
        cuts = np.append(0, np.flatnonzero(np.diff(key)) + 1).tolist()
        for start, end in zip(cuts, [*cuts[1:], len(key)]):
            if held and start == 0 and held[0].column("block")[0].as_py() != key[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            if end < len(key):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def similar_pairs(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets with the Jaccard similarity, by numbers of shared members.

    Members that few sets hold add their pairs one by one; the others are columns of a 0/1
    matrix, whose product with itself counts the rest.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    member, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(member, kind="stable")
    owner, many = owner[order], times[member[order]]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for m in range(2, RARE + 1):
        few = owner[many == m].reshape(-1, m)
        for i in range(m):
            for j in range(i):
                np.add.at(shared, (few[:, j], few[:, i]), 1)
    often = many > RARE
    column = np.cumsum(np.append(0, np.diff(member[order][often]) != 0)) if often.any() else np.empty(0, np.int64)
    row = owner[often]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, (start, start + COLUMNS))
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[row[low:high], column[low:high] - start] = 1
        shared += dense @ dense.T
    either = size[:, None] + size[None, :] - shared
    a, b = np.nonzero(np.triu(shared >= similarity * either - 1e-9, 1))
    return a, b


def _nodes(rows: DataFrame) -> DataFrame:
    """Written table of the distinct sets of shingles: ``least`` row, ``node``, ``fp`` of a row, ``n, bands``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")).alias("least")
    own = F.min(F.struct("uid", "fp")).alias("own")
    sets = sketches(rows).groupBy("one", "two").agg(first, own, F.first("n").alias("n"), F.first("bands").alias("bands"))
    return _kept(sets.select("least", F.col("own.uid").alias("node"), "own.fp", "n", "bands"), "nodes")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Of each group of similar texts the row with the least doc_id (nulls last), all columns kept.

    Words are what lies between blanks after A-Z are lower-cased. Two texts are similar if the
    Jaccard similarity of their sets of five-word shingles is 0.8 or more; groups are the
    components of similar pairs. Null, empty and blank texts are one group. Of equal doc_ids the
    first row stays. All columns are kept whatever their names; an empty table gives no rows. ``docs`` has to give the same rows in the same partitions whenever it is read, as
    a written table does. Texts are shuffled for the pairs that are compared, and once to keep
    the rows that were chosen.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    columns = [F.col(f"`{c}`").alias(n) for n, c in zip(names, docs.columns)]
    rows = identified(docs.select(*columns, F.col("doc_id").alias("doc_id"), F.col("text").alias("text")))
    nodes = _nodes(rows)
    roots = connected_components(links(rows, nodes, similarity))
    rooted = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("group"))
    kept = rooted.agg(F.min("least").alias("least")).select(F.col("least.uid").alias("_uid"))
    return rows.join(kept, "_uid", "left_semi").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
