"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.text import Slice, WordHashes, arrow_map, mixed, slices
from timbrelake.session import scratch_path, ship_package

#: Labelled rows that the label model and the classifier are fitted on, at most about so many.
TRAINING_ROWS = 20_000
#: Word beginnings (in bytes) that are patterns besides the whole words.
BEGINNINGS = (4, 5, 6)
#: Patterns of toxic texts that are counted, those that vote, and the voters that they make.
CANDIDATES, PATTERNS, VOTERS = 20_000, 512, 64
#: A pattern votes if its chi-square statistic with the labels is at least this.
EVIDENCE = 22.0
#: It also has to be so many times as frequent in toxic texts.
LIFT = 5.0
#: Chances that a label 1, and a label 0, is given to texts that are clean, and that are toxic.
LABELS = ((0.005, 0.98), (0.995, 0.02))
THRESHOLD = 0.3
#: Insults that vote in any corpus, whatever the labels say.
LEXICON = (
    "idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "trash", "disgusting",
    "clown", "imbecile", "dumb", "vermin", "bastard", "filthy",
)


def pattern_hashes(part: Slice, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word and word beginning, once for each text."""
    size = part.ends - part.starts
    text = np.searchsorted(part.first[1:], np.arange(len(size)), "right")
    found, owner = [hashes(part.data, part.starts, part.ends)], [text]
    for n in BEGINNINGS:
        some = size > n
        h = hashes(part.data, part.starts[some], part.starts[some] + n)
        found.append(mixed(h ^ np.uint64(n)))
        owner.append(text[some])
    return np.concatenate(found), np.concatenate(owner)


@dataclass
class Patterns:
    """Known patterns: hashes in rising order, with a filter of their low bits before the search."""

    known: np.ndarray

    def __post_init__(self) -> None:
        self.low = np.zeros(1 << 20, bool)
        self.low[self.known & np.uint64((1 << 20) - 1)] = True

    def of(self, texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        """Text and pattern number of each pattern in each text, once, in rising order."""
        h, text = pattern_hashes(Slice(texts), hashes)
        maybe = np.flatnonzero(self.low[h & np.uint64((1 << 20) - 1)])
        h, text = h[maybe], text[maybe]
        place = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        hit = self.known[place] == h if len(self.known) else np.zeros(len(h), bool)
        pairs = np.unique(text[hit] * np.int64(len(self.known) or 1) + place[hit])
        return pairs // (len(self.known) or 1), pairs % (len(self.known) or 1)


def lexicon_hashes() -> np.ndarray:
    part = Slice([" ".join(LEXICON).encode()])
    return WordHashes()(part.data, part.starts, part.ends)


def held_out(doc_id) -> object:
    """Whether a row is kept from learning: crc32 of its number as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """``text, toxic`` of about ``most`` labelled rows that are not held out, chosen by a hash of doc_id.

    The chosen labels are broadcast: their number is bounded by ``most``, so texts stay in place.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    share = min(1.0, most / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _toxic_patterns(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for _, texts in slices(batch):
        h, text = pattern_hashes(Slice(texts), hashes)
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])) if len(h) else np.empty(0, bool)
        values, counts = np.unique(h[new], return_counts=True)
        yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], ["h", "n"])


def present(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """``toxic, at``: for each training text the numbers of the known patterns that it holds."""
    patterns = Patterns(known)

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for start, texts in slices(batch):
            text, number = patterns.of(texts, hashes)
            lists = np.split(number, np.searchsorted(text, np.arange(1, len(texts))))
            yield pa.record_batch(
                [batch.column("toxic").slice(start, len(texts)), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))],
                ["toxic", "at"],
            )

    return arrow_map(docs, of, "toxic int, at array<int>")


@dataclass
class LabelModel:
    """Voters that fire or abstain, given a hidden label.

    ``fire[v, y]`` is the chance that voter v fires on texts of label y; abstaining says nothing,
    as each lexicon knows few of the ways to be toxic. Correlated voters repeat one another: with
    r the voters' correlations within a label, a vote counts 1 / (1 + sum of the positive r with
    the others). Chances and the share of toxic texts are fitted by expectation maximisation. The
    labels vote as well, with chances that are given: they are mostly right.
    """

    fire: np.ndarray
    weight: np.ndarray
    share: float

    @classmethod
    def fit(cls, votes: np.ndarray, said: np.ndarray, rounds: int = 25) -> tuple[LabelModel, np.ndarray]:
        """The model and the posterior chance of each text to be toxic."""
        votes = np.column_stack([votes, said, 1 - said])
        posterior = np.clip(said.astype(float), 0.02, 0.98)
        model = None
        for _ in range(rounds):
            both = np.stack([1 - posterior, posterior], 1)
            fire = (votes.T @ both + np.array([0.05, 0.5])) / (both.sum(0) + 1.0)
            fire = np.clip(fire, 1e-4, 1 - 1e-4)
            fire[-2:] = LABELS
            expected = both @ fire.T
            rest = votes - expected
            scale = np.sqrt((rest**2).mean(0)) + 1e-9
            r = (rest.T @ rest) / len(votes) / np.outer(scale, scale)
            np.fill_diagonal(r, 0.0)
            weight = 1 / (1 + np.maximum(r, 0).sum(1))
            weight[-2:] = 1.0
            model = cls(fire, weight, float(np.clip(posterior.mean(), 1e-3, 0.999)))
            after = model.posterior(votes)
            if np.abs(after - posterior).max() < 1e-6:
                break
            posterior = after
        return model, posterior

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.fire[:, 1] / self.fire[:, 0])
        odds = np.log(self.share / (1 - self.share)) + votes @ (on * self.weight)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass
class Classifier:
    """Weights of known patterns; a text's score depends on which of them it holds."""

    known: np.ndarray
    weights: np.ndarray
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Classifier:
    """Fit voters, label model and classifier on a bounded sample of labelled rows (see module).

    Without rows of both labels the classifier is a constant, the smoothed share of toxic rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "toxicity")
    training_texts(docs, labels, most).write.parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")
    sizes = {row.toxic: row["count"] for row in texts.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        share = (bad + 0.5) / (bad + good + 5)
        return Classifier(np.empty(0, np.uint64), np.empty(0), float(np.log(share / (1 - share))))
    least = max(3, bad // 500)
    counts = arrow_map(texts.where("toxic = 1").select("text"), _toxic_patterns, "h long, n long")
    frequent = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = frequent.orderBy(F.desc("n"), "h").limit(CANDIDATES).collect()
    known = np.unique(np.append(np.array([r.h for r in rows], np.int64).view(np.uint64), lexicon_hashes()))
    present(texts, known).write.parquet(f"{path}/present")
    table = spark.read.parquet(f"{path}/present")
    pairs = table.select("toxic", F.explode("at").alias("p")).groupBy("p").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    seen = np.zeros((len(known), 2))
    for row in pairs.collect():  # as many rows as candidates
        seen[row.p] = row.bad, row.n
    in_bad, in_good, total = seen[:, 0], seen[:, 1] - seen[:, 0], bad + good
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = total * (in_bad * (good - in_good) - in_good * (bad - in_bad)) ** 2 / (bad * good * seen[:, 1] * (total - seen[:, 1]))
    toxic = (in_bad + 0.5) / (bad + 1) > LIFT * (in_good + 0.5) / (good + 1)
    chi = np.where(toxic & np.isfinite(chi), chi, 0)
    chosen = np.argsort(-chi, kind="stable")[:PATTERNS]
    fixed = np.flatnonzero(np.isin(known, lexicon_hashes()))
    chosen = np.union1d(chosen[chi[chosen] >= EVIDENCE], fixed)
    place = F.array(*[F.lit(int(p)) for p in chosen])
    few = table.select("toxic", F.array_intersect("at", place).alias("at")).collect()  # at most about `most` rows
    index = {int(p): k for k, p in enumerate(chosen)}
    held = [[index[p] for p in row.at] for row in few]
    voter = np.empty(len(chosen), np.int64)
    voter[np.argsort(-chi[chosen], kind="stable")] = np.arange(len(chosen)) % VOTERS
    votes = np.zeros((len(few), int(voter.max()) + 1))
    for i, own in enumerate(held):
        votes[i, voter[own]] = 1
    _, posterior = LabelModel.fit(votes, np.array([row.toxic for row in few]))
    examples = []
    for own, p in zip(held, posterior.tolist()):
        vector = Vectors.sparse(len(chosen), sorted(own), [1.0] * len(own))
        examples += [(vector, float(y), w) for y, w in ((1, p), (0, 1 - p)) if w > 1e-4]
    frame = spark.createDataFrame(examples, ["features", "label", "weight"])
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(frame)
    order = np.argsort(known[chosen])
    return Classifier(known[chosen][order], model.coefficients.toArray()[order], float(model.intercept))


def score(docs: DataFrame, classifier: Classifier, name: str = "score") -> DataFrame:
    """The rows of ``docs`` with their score behind the other columns; a text decides alone."""
    patterns = Patterns(classifier.known)

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, out = WordHashes(), []
        for _, texts in slices(batch):
            text, number = patterns.of(texts, hashes)
            total = np.bincount(text, classifier.weights[number], len(texts)) if len(text) else np.zeros(len(texts))
            out.append(1 / (1 + np.exp(-np.clip(total + classifier.intercept, -700, 700))))
        yield pa.record_batch([*batch.columns, pa.array(np.concatenate(out))], [*batch.schema.names, name])

    ship_package(docs.sparkSession)
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + f", {name} double"
    return arrow_map(docs, of, schema)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts get the score of a text without patterns. Labels other than 0 and 1, null
    labels and labels without a document are not learned from; a document with two labels counts
    twice. Repeated rows and rows with a null doc_id are scored like others (a null is not held
    out). Other columns are ignored; an empty table gives no rows. Only labels, patterns and
    votes of the bounded training sample reach the driver; documents are never shuffled.
    """
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels, most))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns kept."""
    scored = score(docs, fit(docs, labels, most), "_score").where(F.col("_score") < threshold)
    return scored.select(*(f"`{c}`" for c in docs.columns))
