"""Line deduplication: chunks and windows of lines that stand elsewhere already are removed."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrelake.llm.text import NOT_BLANK, SLICE_BYTES, WordHashes, bounds
from timbrelake.session import remove_path, scratch_path, ship_package

#: A paragraph of this many words is bounded by its own ends, whatever stands around it; windows of
#: lines have this many words or more.
LONG = 50
#: What a place ``KINDS * number + kind`` means: a chunk by its number, the least run of lines of LONG
#: words that begins with a line, and the one that ends with a line.
CHUNK, AHEAD, BACK = range(3)
KINDS = 3
#: Hashes of windows are apart from those of chunks.
APART = np.uint64(0x6A09E667F3BCC909)
#: Repeated chunks are removed where they make a run of this many words or more.
LEAST = 25
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True


class Chunks:
    """Chunks of lines of some texts; those of text t are ``first[t]`` to ``first[t + 1]``.

    A line is what stands between newlines, cut further where blanks follow ``.``, ``!`` or ``?``;
    blanks around it do not belong to it. A boundary stands behind a line whose hash is the least
    of a rolling window of three lines, with it in the middle, so that chunks have two lines or
    more and three on average; also at the ends of a text, and around a paragraph (what stands
    between newlines) of 50 words or more. All but the ends of texts depend on adjoining lines
    only, so what is inserted before a passage moves no boundary inside of it.
    """

    def __init__(self, texts: list[bytes], hashes: WordHashes) -> None:
        self.joined = b"\n".join(texts)
        data = np.frombuffer(self.joined, np.uint8)
        row_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        solid = np.flatnonzero(NOT_BLANK[data])
        newlines = np.cumsum(data == 0x0A)
        paragraph = newlines[solid]
        step = np.diff(solid)
        cut = (paragraph[1:] != paragraph[:-1]) | (step > 1) & STOP[data[solid[:-1]]]
        at = np.flatnonzero(cut)
        some = len(solid) > 0
        starts = solid[np.append(0, at + 1)] if some else solid
        ends = solid[np.append(at, len(solid) - 1)] + 1 if some else solid
        text = np.searchsorted(row_ends, starts, "right")
        word_starts, _ = bounds(data, NOT_BLANK)
        words = np.diff(np.append(np.searchsorted(word_starts, starts), len(word_starts)))
        h = hashes(data, starts, ends)
        new_text = np.append(True, text[1:] != text[:-1]) if some else np.empty(0, bool)
        close = np.zeros(len(h), bool)
        close[1:-1] = (h[1:-1] < h[:-2]) & (h[1:-1] < h[2:]) & ~new_text[1:-1] & ~new_text[2:]
        own = newlines[starts]
        part = np.cumsum(np.append(False, own[1:] != own[:-1])) if some else own
        total = np.bincount(part, words)[part] if some else own
        edge = np.append(part[1:] != part[:-1], True) if some else np.empty(0, bool)
        long_ = total >= LONG
        close |= edge & (long_ | np.append(long_[1:], True))[: len(edge)]
        close |= np.append(new_text[1:], True)[: len(close)]
        last = np.flatnonzero(close)
        begin = np.append(0, last[:-1] + 1) if len(last) else last
        self.line_starts, self.line_ends, self.line_words = starts, ends, words
        self.begin, self.last = begin, last
        self.line_first = np.searchsorted(text, np.arange(len(texts) + 1))
        self.line_text = text
        self.upto = np.append(0, np.cumsum(words))
        #: Line behind the window that begins with each line, or -1 where the text ends before.
        self.behind = np.searchsorted(self.upto, self.upto[:-1] + LONG)
        inside = self.behind <= self.line_first[text + 1] if some else np.empty(0, bool)
        self.behind = np.where(inside, self.behind, -1)
        self.starts, self.ends = starts[begin], ends[last]
        self.text = text[begin]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.lines = last - begin + 1
        self.words = np.add.reduceat(words, begin) if len(begin) else begin
        self.keys = hashes(data, self.starts, self.ends).view(np.int64)
        self.row_starts = np.append(0, row_ends[:-1] + 1)

    def window_keys(self, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        """Lines with which a window begins, and the hashes of these windows."""
        at = np.flatnonzero(self.behind > 0)
        data = np.frombuffer(self.joined, np.uint8)
        h = hashes(data, self.line_starts[at], self.line_ends[self.behind[at] - 1])
        return at, (h ^ APART).view(np.int64)

    def lines_of(self, texts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First line of each place in its text, and the line behind its last."""
        number, kind = np.divmod(places, KINDS)
        low, high = np.empty_like(number), np.empty_like(number)
        chunk, ahead, back = (np.flatnonzero(kind == x) for x in (CHUNK, AHEAD, BACK))
        k = self.first[texts[chunk]] + number[chunk]
        low[chunk], high[chunk] = self.begin[k], self.last[k] + 1
        low[ahead] = self.line_first[texts[ahead]] + number[ahead]
        high[ahead] = self.behind[low[ahead]]
        high[back] = self.line_first[texts[back]] + number[back] + 1
        low[back] = np.searchsorted(self.upto, self.upto[high[back]] - LONG, "right") - 1
        return low, high

    def with_ends_beside(self, texts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places and those of windows that end between the end of one and that of the next line's.

        A repeated passage has a repeated window at each of its lines up to the last one that fits;
        what is behind that one's end belongs to one of these windows.
        """
        ahead = places % KINDS == AHEAD
        t = texts[ahead]
        line = self.line_first[t] + places[ahead] // KINDS
        limit = self.line_first[t + 1]
        after = np.where(line + 1 < limit, self.behind[np.minimum(line + 1, len(self.behind) - 1)], -1)
        upto = np.where(after > 0, after - 1, limit)
        some = np.flatnonzero(self.behind[line] < upto)
        found = {(int(t[i]), KINDS * (x - int(self.line_first[t[i]])) + BACK) for i in some for x in range(int(self.behind[line[i]]), int(upto[i]))}
        if not found:
            return texts, places
        more = np.array(sorted(found), np.int64)
        return np.append(texts, more[:, 0]), np.append(places, more[:, 1])

    def without(self, t: int, drop: np.ndarray) -> bytes:
        """Text t without its chunks ``drop`` (booleans), each with the blanks behind it."""
        return self.without_lines(t, np.repeat(drop, self.lines[self.first[t] : self.first[t + 1]]))

    def without_lines(self, t: int, drop: np.ndarray) -> bytes:
        """Text t without its lines ``drop`` (booleans), each with the blanks behind it."""
        low, high = self.line_first[t], self.line_first[t + 1]
        begin = self.row_starts[t]
        end = self.row_starts[t + 1] - 1 if t + 1 < len(self.row_starts) else len(self.joined)
        edges = np.append(self.line_starts[low:high], end)
        kept = [self.joined[begin : edges[0]]]
        kept += [self.joined[edges[i] : edges[i + 1]] for i in np.flatnonzero(~drop)]
        return b"".join(kept)


def in_slices(values: list, rows: list[int]) -> Iterator[list[int]]:
    """The rows in groups whose texts have about SLICE_BYTES."""
    taken, size = [], 0
    for r in rows:
        if taken and size + len(values[r]) > SLICE_BYTES:
            yield taken
            taken, size = [], 0
        taken.append(r)
        size += len(values[r])
    if taken:
        yield taken


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.large_binary()).to_pylist()]


def chunk_rows(identified: DataFrame) -> DataFrame:
    """``h, uid, k`` for each chunk and each window that begins with a line: hash and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = _texts(batch)
            for rows in in_slices(texts, list(range(len(texts)))):
                c = Chunks([texts[r] for r in rows], hashes)
                at, keys = c.window_keys(hashes)
                number = np.append(np.arange(len(c.text)) - c.first[c.text], at - c.line_first[c.line_text[at]])
                kind = np.repeat([CHUNK, AHEAD], [len(c.text), len(at)])
                row = pa.array(rows[0] + np.append(c.text, c.line_text[at]))
                k = (KINDS * number + kind).astype(np.int32)
                yield pa.record_batch([pa.array(np.append(c.keys, keys)), batch.column("_uid").take(row), pa.array(k)], ["h", "uid", "k"])

    return identified.select("_uid", "text").mapInArrow(run, "h long, uid long, k int")


def _listed(rows: list[int], at: list) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and place, for each place of some rows."""
    sizes = [len(at[r]) for r in rows]
    return np.repeat(np.arange(len(rows)), sizes), np.fromiter((p for r in rows for p in at[r]), np.int64, sum(sizes))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``c1, c2, doc_id, uid, k, line, lines`` for what the rows' ``_at`` lists and the windows beside it.

    c1 and c2 are the digest of the kind and the bytes.
    """
    hashes = WordHashes()
    for batch in batches:
        texts, at = _texts(batch), batch.column("_at").to_pylist()
        for rows in in_slices(texts, [r for r, x in enumerate(at) if x]):
            c = Chunks([texts[r] for r in rows], hashes)
            t, place = c.with_ends_beside(*_listed(rows, at))
            low, high = c.lines_of(t, place)
            marks = [bytes([k]) for k in range(KINDS)]
            spans = zip((place % KINDS).tolist(), c.line_starts[low].tolist(), c.line_ends[high - 1].tolist())
            digests = b"".join(blake2b(marks[k] + c.joined[s:e], digest_size=16).digest() for k, s, e in spans)
            content = np.frombuffer(digests, np.int64).reshape(-1, 2)
            row = pa.array(np.array(rows)[t])
            yield pa.record_batch(
                [pa.array(content[:, 0].copy()), pa.array(content[:, 1].copy()), batch.column("doc_id").take(row), batch.column("_uid").take(row),
                 *(pa.array(x.astype(np.int32)) for x in (place, low - c.line_first[t], high - low))],
                ["c1", "c2", "doc_id", "uid", "k", "line", "lines"],
            )


def _rebuilder(names: list[str], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, at = _texts(batch), batch.column("_at").to_pylist()
            out = batch.column("text").to_pylist()
            chunks, words = np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int64)
            for rows in in_slices(texts, [r for r, x in enumerate(at) if x]):
                c = Chunks([texts[r] for r in rows], hashes)
                text, place = _listed(rows, at)
                runs = place % KINDS != CHUNK
                low, high = c.lines_of(text[runs], place[runs])
                cover = np.zeros(len(c.line_starts) + 1, np.int64)
                np.add.at(cover, low, 1)
                np.add.at(cover, high, -1)
                covered = np.cumsum(cover)[:-1] > 0
                for t, r in enumerate(rows):
                    own = slice(c.first[t], c.first[t + 1])
                    size = c.words[own]
                    drop = np.zeros(len(size), bool)
                    drop[[p // KINDS for p in at[r] if p % KINDS == CHUNK]] = True
                    run_of = np.cumsum(np.append(0, drop[1:] != drop[:-1]))
                    total = np.bincount(run_of, size)
                    drop &= ((total >= least) & (np.bincount(run_of, c.lines[own]) > 1) | (total >= LONG))[run_of]
                    begin = c.line_first[t]
                    lines = np.repeat(drop, c.lines[own]) | covered[begin : c.line_first[t + 1]]
                    if lines.any():
                        out[r] = c.without_lines(t, lines).decode()
                        chunks[r] = np.logical_or.reduceat(lines, c.begin[own] - begin).sum()
                        words[r] = c.line_words[begin : c.line_first[t + 1]][lines].sum()
            columns = [pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.record_batch([*columns, pa.array(chunks), pa.array(words)], [*names, "removed_chunks", "removed_words"])

    return run


def _by_row(places: DataFrame) -> DataFrame:
    return places.groupBy("uid").agg(F.array_sort(F.collect_list("k")).alias("_at"))


def _placed(identified: DataFrame, at: DataFrame, how: str) -> DataFrame:
    return identified.join(at, F.col("_uid") == F.col("uid"), how).drop("uid")


def _written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame from the shared folder; what was shuffled for it is let go of."""
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()  # Spark's cleaner deletes the shuffle files of plans that are gone
    return spark.read.parquet(path)


def _proposed(places: DataFrame) -> DataFrame:
    """``uid`` and ``_at``, the places whose hashes stand elsewhere too."""
    repeated = places.groupBy("h").count().where("count > 1").select("h")
    return _by_row(places.join(repeated, "h", "left_semi"))


def deduplicate_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` without repeated passages, and ``removed_chunks``, ``removed_words``.

    What occurs more than once in all texts stays where it occurs first (least doc_id, a null
    before all others; within it the first place) and goes elsewhere. Compared are the least runs
    of lines of 50 words that begin or end with any line, so that a repeated passage of whole
    lines of 50 words goes up to its true ends, whatever stands around it; and chunks, which go
    where they stand in a run of such chunks of ``least`` words and more than one line. A run that
    overlaps its own first place stays. Hashes propose; what is equal is decided by a 128-bit
    cryptographic digest of the bytes. ``removed_chunks`` counts the chunks that lose a line.
    Every row stays; a text of nothing but repeats becomes empty, null and empty texts are
    unchanged, repeated rows are occurrences like others. Other columns are kept as they are,
    except that clashing ``removed_*`` columns are replaced.

    Counting shuffles hashes and places only, partially aggregated, so a passage that a third of
    all documents share is one row a task. Texts are shuffled by row. ``docs`` has to give the
    same rows in the same partitions whenever it is read, as a written table does.
    """
    spark = docs.sparkSession
    ship_package(spark)
    names = [c for c in docs.columns if c.lower() not in ("removed_chunks", "removed_words", "_uid", "_at")]
    kinds = dict(docs.dtypes)
    identified = docs.select(*(f"`{c}`" for c in names)).withColumn("_uid", F.monotonically_increasing_id())
    path = scratch_path(spark, "chunks")
    chunk_rows(identified).write.parquet(path)
    proposed = _written(spark, _proposed(spark.read.parquet(path)), "proposed")
    remove_path(spark, path)
    contents = _written(spark, _placed(identified, proposed, "inner").select("_uid", F.col("doc_id").cast("long"), "text", "_at").mapInArrow(
        _contents, "c1 long, c2 long, doc_id long, uid long, k int, line int, lines int"
    ), "contents")
    first = (
        contents.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "uid", "line")).alias("keep"))
        .where("n > 1").select("c1", "c2", F.col("keep.uid").alias("keep_uid"), F.col("keep.line").alias("keep_line"))
    )
    stays = (F.col("uid") == F.col("keep_uid")) & (F.col("line") < F.col("keep_line") + F.col("lines"))
    going = _written(spark, _by_row(contents.join(first, ["c1", "c2"]).where(~stays)), "going")
    schema = ", ".join(f"`{c}` {'string' if c == 'text' else kinds[c]}" for c in names)
    return _placed(identified, going, "left").mapInArrow(_rebuilder(names, least), f"{schema}, removed_chunks int, removed_words long")
