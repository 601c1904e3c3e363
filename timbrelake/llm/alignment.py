"""Cross-tokenizer alignment: each distinct text is tokenised twice and aligned once, its counts weigh by its copies."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timbrelake.llm.text import slices
from timbrelake.session import scratch_path, ship_package

#: How GPT-2 style tokenizers cut a text before merging bytes (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts without bytes from here on (characters below U+0240) go through the faster merger, whose
#: character classes are those of the tokenizer file there; a test compares both on all of them.
PLAIN = 0xC9
#: Bytes of text in a block, whose linked pairs of ids are looked up together.
BLOCK_BYTES = 1 << 23
#: A text that more than one in HOT documents share meets them in SALTS parts. At most HOT texts can be such.
HOT, SALTS = 1000, 64
#: A link is the number ``a << B_BITS | b`` of its two ids.
B_BITS = 20
#: Links of groups with more tokens than this on both sides are made from distinct ids.
WIDE = 64
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class ByteTokens:
    """Ids and byte lengths under a byte-level merge tokenizer; special tokens' strings are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described.get("added_tokens", []) if t["special"]}
        byte_of = _byte_letters()
        vocabulary = described["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        ranks = {self.bytes[number]: number for token, number in vocabulary.items() if token not in special}
        self.fast = Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of each text with a blank before it."""
        out = []
        for text in texts:
            words = " " + text.decode()
            if not text or np.frombuffer(text, np.uint8).max() < PLAIN:
                out.append(self.fast.encode_ordinary(words))
            else:
                out.append(self.slow.encode(words, add_special_tokens=False).ids)
        return out


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable Latin-1 for itself, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PieceTokens:
    """Ids and bytes under a SentencePiece model, which puts a blank before the text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def __call__(self, texts: list[bytes]) -> list[list[int]]:
        return [self.model.encode(t.decode()) for t in texts]


class Aligner:
    """Alignment of slices of texts under two tokenizers."""

    def __init__(self, first: str, second: str) -> None:
        self.one, self.two = ByteTokens(first), PieceTokens(second)
        self.size_a = np.array([len(b) for b in self.one.bytes], np.int64)
        self.size_b = np.array([len(b) for b in self.two.bytes], np.int64)
        most = max(len(self.size_a), len(self.size_b))
        #: Decimal ids followed by each of the marks that may stand behind them.
        self.shown = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(most)]
        self.most = most

    def ids(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none where the bytes of either are not those of the text with a blank before it."""
        a, b = self.one(texts), self.two(texts)
        byte_a, byte_b = self.one.bytes.__getitem__, self.two.bytes.__getitem__
        for i, text in enumerate(texts):
            want = b" " + text
            if not text or b"".join(map(byte_a, a[i])) != want or b"".join(map(byte_b, b[i])) != want:
                a[i], b[i] = [], []
        return a, b

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text ``n_a, n_b, n_groups, n_links`` and its groups as text; per text and linked pair text, link and times."""
        rows_a, rows_b = self.ids(texts)
        n_a, n_b = (np.fromiter(map(len, rows), np.int64, len(rows)) for rows in (rows_a, rows_b))
        a, b = (np.fromiter(chain.from_iterable(rows), np.int64, int(n.sum())) for rows, n in ((rows_a, n_a), (rows_b, n_b)))
        if not len(a):
            return np.zeros((len(texts), 4), np.int64), [""] * len(texts), *(np.empty(0, np.int64) for _ in range(3))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])  # texts have equal bytes on both sides
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        many_a, many_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        last = np.cumsum(n_a)  # the group of a text's last token ends the text
        upto = np.where(last > 0, group_a[np.maximum(last - 1, 0)] + 1, 0)
        groups = np.diff(upto, prepend=0)
        linked = np.append(0, np.cumsum(many_a * many_b))
        links = np.diff(linked[upto], prepend=0)
        text, link, times = self._links(a, b, group_a, group_b, many_a, many_b, upto)
        return np.stack([n_a, n_b, groups, links], 1), self._shown(a, b, group_a, group_b, last + np.cumsum(n_b)), text, link, times

    def _links(self, a, b, group_a, group_b, many_a, many_b, upto) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, link and number of occurrences of all pairs, each text and link once."""
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        wide = (many_a > WIDE) & (many_b > WIDE)
        token = np.flatnonzero(~wide[group_a])
        times = many_b[group_a[token]]
        left = np.repeat(token, times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first_b[group_a[left]]
        text_of = np.searchsorted(upto, np.arange(len(many_a)), "right")
        text, link, count = [text_of[group_a[left]]], [a[left] << B_BITS | b[right]], [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            ids_a, count_a = np.unique(a[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
            ids_b, count_b = np.unique(b[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
            link.append((ids_a[:, None] << B_BITS | ids_b[None, :]).ravel())
            count.append((count_a[:, None] * count_b[None, :]).ravel())
            text.append(np.full(len(link[-1]), text_of[g]))
        text, link, count = map(np.concatenate, (text, link, count))
        order = np.lexsort((link, text))
        text, link = text[order], link[order]
        new = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(link) != 0)))
        return text[new], link[new], np.add.reduceat(count[order], new)

    def _shown(self, a, b, group_a, group_b, ends) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text, whose tokens end at ``ends`` of those of both sides."""
        side = np.append(2 * group_a, 2 * group_b + 1)  # groups in order, in each the first tokenizer's side
        order = np.argsort(side, kind="stable")
        side = side[order]
        mark = np.append(np.where(side[1:] == side[:-1], 0, 1 + side[:-1] % 2), 3)
        mark[ends[ends > 0] - 1] = 3
        parts = list(map(self.shown.__getitem__, (np.append(a, b)[order] + mark * self.most).tolist()))
        return ["".join(parts[low:high]) for low, high in zip([0, *ends[:-1].tolist()], ends.tolist())]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    """The tokenizers of a worker, loaded once."""
    if (first, second) not in _ALIGNERS:
        _ALIGNERS[first, second] = Aligner(first, second)
    return _ALIGNERS[first, second]


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values, kind))


TEXT_ROW = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
LINK_ROW = "block long, place array<int>, times array<int>, pairs array<long>, weights array<long>"


def alignments(docs: DataFrame, first: str, second: str, with_groups: bool = True) -> DataFrame:
    """Written table of the aligned distinct texts, and of the linked pairs of ids of each block of texts.

    A text's row has ``key`` (its SHA-256), ``n`` (how many documents have it), counts, and
    ``groups`` such as ``a1,a2|b1;a3|b2`` (null without ``with_groups``) with its SHA-256. Its links
    are ``place`` and ``times``: which pair of its block, and how often. A block's row, without a
    key, has ``pairs`` (``a << B_BITS | b``) and ``weights``, the number of documents that hold the
    pair. Documents are shuffled by their whole text, copies are counted before that.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        align, number = aligner(first, second), TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = texts_held = 0

        def block() -> Iterator[pa.RecordBatch]:
            keys, copies, counts, shown, text, link, times = zip(*held)
            many, copies, shown = np.concatenate(counts), np.concatenate(copies), [s for part in shown for s in part]
            text, link, times = np.concatenate(text), np.concatenate(link), np.concatenate(times)
            pairs, place = np.unique(link, return_inverse=True)
            weights = np.zeros(len(pairs), np.int64)
            np.add.at(weights, place, copies[text])
            per_text = np.bincount(text, minlength=len(copies))
            rows = len(copies)
            none = lambda kind, n: pa.nulls(n, kind)
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            yield pa.record_batch(
                [
                    pa.concat_arrays(keys), pa.array(copies), *(pa.array(many[:, k].copy()) for k in range(4)),
                    pa.array([sha256(s.encode()).hexdigest() if s else "" for s in shown]), pa.array(shown if with_groups else [None] * rows, pa.string()),
                    pa.array(np.full(rows, number)), _lists(place.astype(np.int32), per_text, pa.int32()), _lists(times.astype(np.int32), per_text, pa.int32()),
                    none(longs, rows), none(longs, rows),
                ], names,
            )
            yield pa.record_batch(
                [
                    none(pa.binary(), 1), *(none(pa.int64(), 1) for _ in range(5)), none(pa.string(), 1), none(pa.string(), 1), pa.array([number]),
                    none(ints, 1), none(ints, 1), _lists(pairs, [len(pairs)], pa.int64()), _lists(weights, [len(pairs)], pa.int64()),
                ], names,
            )

        for batch in batches:
            for start, texts in slices(batch):
                counts, shown, text, link, times = align(texts)
                keys, copies = (batch.column(c).slice(start, len(texts)) for c in ("key", "n"))
                held.append((keys, copies.to_numpy(), counts, shown, text + texts_held, link, times))
                texts_held += len(texts)
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield from block()
                    held, size, texts_held, number = [], 0, 0, number + 1
        if held:
            yield from block()

    ship_package(docs.sparkSession)
    names = [c.split()[0] for c in f"{TEXT_ROW}, {LINK_ROW}".split(", ")]
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    keyed = distinct.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), "n", "text")
    path = scratch_path(docs.sparkSession, "alignments")
    keyed.mapInArrow(run, f"{TEXT_ROW}, {LINK_ROW}").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best`` for every linked pair of ids: documents that hold it, and whether no pair of its first id has more."""
    pairs = aligned.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "weights")).alias("x"))
    counts = pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.weights").alias("count"))
    # At most as many rows meet as the second vocabulary has ids.
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", B_BITS)))
    return counts.withColumn("best", F.col("count") == highest)


def _measured(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of each text of a block, given the counts of the block's pairs."""
    order = np.argsort(pairs.column("at").to_numpy())
    count, best = pairs.column("count").to_numpy()[order], pairs.column("best").to_numpy()[order].astype(np.int64)
    place, times = (texts.column(c).combine_chunks() for c in ("place", "times"))
    per_text = np.append(0, np.cumsum(place.value_lengths().to_numpy()))
    place, times = place.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = [np.diff(np.append(0, np.cumsum(times * x[place]))[per_text]) for x in (best, count)]
    return texts.select(["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]).append_column("n_best", pa.array(sums[0])).append_column(
        "count_sum", pa.array(sums[1])
    )


def measures(aligned: DataFrame) -> DataFrame:
    """``key, n``, counts and ``groups_sha256`` of each distinct text of :func:`alignments`, with ``n_best`` and ``count_sum``.

    Every block asks once for each of its pairs, and gets their counts back as one group with its texts.
    """
    asked = aligned.where("pairs is not null").select("block", F.posexplode("pairs").alias("at", "pair"))
    known = asked.join(pair_counts(aligned), "pair").select(F.col("block").alias("of"), "at", "count", "best")
    texts = aligned.where("key is not null").select("block", "key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times")
    schema = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_measured, schema)


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """All columns of ``docs`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups_sha256``.

    ``first`` is the file of a byte-level merge tokenizer, which reads a text with a blank before it,
    ``second`` a SentencePiece model, which puts that blank there itself. Byte offsets where tokens of
    both end cut them into groups; every pair of tokens of a group is a link. The count of a pair of
    ids is the number of documents that hold it linked; ``n_best`` counts the links that no pair with
    their first id beats, ``count_sum`` adds up the counts of all links.

    Each distinct text is tokenised and aligned once, and what it adds to counts is multiplied by its
    copies. Null and empty texts, and those whose tokens do not give the text's bytes back, have no
    tokens: zeros and an empty ``groups_sha256``. Repeated rows and null ids are documents like
    others; an empty table gives no rows; a long text is aligned whole in one task. Columns named like
    the new ones are replaced. Texts are shuffled once by their whole text, after copies were
    counted; documents meet the measures by the SHA-256 of the text, a frequent text in SALTS parts.
    """
    added = (*MEASURES, "groups_sha256")
    own = [c for c in docs.columns if c not in added]
    names = [f"c{i}" for i in range(len(own))]
    aligned = alignments(docs.select("text"), first, second, with_groups=False)
    whole = aligned.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * HOT >= whole
    hot = aligned.where("key is not null").where(frequent).select("key", F.lit(True).alias("hot"))  # at most HOT rows
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for n, c in zip(names, own)), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    salted = rows.join(F.broadcast(hot), "key", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(0)
    )
    parts = F.when(frequent, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    out = salted.join(measures(aligned).withColumn("salt", F.explode(parts)), ["key", "salt"], "left")
    return out.select(
        *(F.col(n).alias(c) for n, c in zip(names, own)), *(F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
