"""Binary logistic models of all tags at once: every step reads the rows once, however many tags there are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from timbrelake.session import scratch_path, ship_package

#: Margins that a task holds at once (rows times tags).
CELLS = 1 << 20
#: Weights that go to the tasks of a pass at most; more tags are fitted in further groups.
WEIGHTS = 1 << 23
#: Earlier steps from which curvature is learned.
MEMORY = 10


def tag_matrix(rows: DataFrame, features: str, tags: str, names: Sequence[str], test: str) -> DataFrame:
    """Written table of ``x`` (array of doubles), ``own`` (numbers of the row's tags among ``names``) and ``test``."""
    from pyspark.ml.functions import vector_to_array

    known = pa.array(list(names), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tags")
            flat, parent = pc.index_in(pc.list_flatten(lists), known), pc.list_parent_indices(lists)
            there = flat.is_valid()
            number, row = flat.filter(there).to_numpy().astype(np.int64), parent.filter(there).to_numpy().astype(np.int64)
            pairs = np.unique(row * (len(known) + 1) + number)  # a tag counts once a row
            row, number = pairs // (len(known) + 1), pairs % (len(known) + 1)
            offsets = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(offsets), pa.array(number.astype(np.int32)))
            yield pa.record_batch([batch.column("x"), own, batch.column("test")], ["x", "own", "test"])

    ship_package(rows.sparkSession)
    plain = rows.select(vector_to_array(features).alias("x"), F.col(tags).alias("tags"), F.col(test).alias("test"))
    path = scratch_path(rows.sparkSession, "tag-matrix")
    plain.mapInArrow(run, "x array<double>, own array<int>, test boolean").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _dense(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, and row and tag of each tagging, of a bounded number of rows."""
    step = max(1, CELLS // max(1, width))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
        own = part.column("own")
        yield x, pc.list_parent_indices(own).to_numpy().astype(np.int64), own.flatten().to_numpy().astype(np.int64)


def _summed(frame: DataFrame, run) -> dict[int, np.ndarray]:
    """Sums by ``tag`` of the rows of numbers that the tasks give, added in order of the tasks."""

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        values = [np.frombuffer(table.column("sums")[int(i)].as_py(), np.float64) for i in order]
        return pa.table({"tag": table.column("tag").slice(0, 1), "sums": pa.array([np.sum(values, 0).tobytes()], pa.binary())})

    parts = frame.mapInArrow(run, "tag int, part int, sums binary")
    found = parts.groupBy("tag").applyInArrow(add, "tag int, sums binary").collect()
    return {r.tag: np.frombuffer(r.sums, np.float64) for r in found}


def _emitted(sums: np.ndarray, tags: Sequence[int]) -> pa.RecordBatch:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    columns = [pa.array(tags, pa.int32()), pa.array([part] * len(tags), pa.int32()), pa.array([row.tobytes() for row in sums], pa.binary())]
    return pa.record_batch(columns, ["tag", "part", "sums"])


def _gram(train: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the sum of the outer products of their features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for x, _, _ in _dense(batch, 1 << 8):
                total = x.T @ x if total is None else total + x.T @ x
                n += len(x)
        if n:
            yield _emitted(np.append(float(n), total.ravel())[None, :], [0])

    found = _summed(train.select("x", "own"), run).get(0)
    if found is None:
        return 0, np.zeros((0, 0))
    d = int(round((len(found) - 1) ** 0.5))
    return int(found[0]), found[1:].reshape(d, d)


def _losses(train: DataFrame, theta: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-losses and their gradients at ``theta`` (intercept last) for some tags, in one pass."""
    sent = train.sparkSession.sparkContext.broadcast((theta, tags))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta, tags = sent.value
        place = np.full(int(tags.max()) + 1, -1)
        place[tags] = np.arange(len(tags))
        sums = np.zeros((len(tags), theta.shape[1] + 1))
        for batch in batches:
            for x, row, tag in _dense(batch, len(tags)):
                z = x @ theta[:, :-1].T + theta[:, -1]
                asked = tag < len(place)
                row, tag = row[asked], place[tag[asked]]
                row, tag = row[tag >= 0], tag[tag >= 0]
                sums[:, 0] += np.logaddexp(0, z).sum(0)
                np.subtract.at(sums[:, 0], tag, z[row, tag])
                rest = 0.5 * (1 + np.tanh(0.5 * z))  # the sigmoid without overflow
                rest[row, tag] -= 1
                sums[:, 1:-1] += rest.T @ x
                sums[:, -1] += rest.sum(0)
        yield _emitted(sums, tags.tolist())

    found = _summed(train.select("x", "own"), run)
    sent.unpersist()
    rows = np.stack([found[t] for t in tags.tolist()])
    return rows[:, 0], rows[:, 1:]


def fit_logistic(
    train: DataFrame, positives: Sequence[int], reg: float, tol: float = 1e-7, passes: int = 100
) -> np.ndarray:
    """Weights of every tag's logistic model with an L2 penalty, the unpenalised intercept last.

    ``train`` is a :func:`tag_matrix` and ``positives`` the rows of each tag in it, of which there
    is at least one, and one without the tag. Minimises mean log-loss plus ``reg / 2`` times the
    squared weights with limited-memory BFGS, whose first curvature is that of the base rate: the
    features' correlations, taken apart once, times ``p (1 - p)``. All tags step side by side; a
    pass gives loss and gradient of every tag that has not converged, each at its own trial point,
    so the number of passes is that of the slowest tag. Sums are added in order of the tasks.
    """
    n, gram = _gram(train)
    count = len(positives)
    d = len(gram)
    if not n or not count:
        return np.zeros((count, d + 1))
    group = max(1, WEIGHTS // (d + 1))
    if count > group:
        parts = [_steps(train, np.arange(a, min(count, a + group)), positives, n, gram, reg, tol, passes) for a in range(0, count, group)]
        return np.concatenate(parts)
    return _steps(train, np.arange(count), positives, n, gram, reg, tol, passes)


def _steps(train, tags, positives, n, gram, reg, tol, passes) -> np.ndarray:
    share = np.array([positives[t] for t in tags]) / n
    size, basis = np.linalg.eigh(gram / n)
    rate = (share * (1 - share))[:, None]
    scale = np.append(1 / (rate * np.maximum(size, 0) + max(reg, 1e-12)), 1 / rate, axis=1)
    penalty = np.append(np.full(len(size), float(reg)), 0.0)

    def curved(k: np.ndarray, g: np.ndarray) -> np.ndarray:
        """First guess of the inverse curvature of tags k, times g."""
        return np.append((g[:, :-1] @ basis * scale[k, :-1]) @ basis.T, g[:, -1:] * scale[k, -1:], axis=1)

    def value(k: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss, slope = _losses(train, theta, tags[k])
        return loss / n + 0.5 * (penalty * theta**2).sum(1), slope / n + penalty * theta

    theta = np.zeros((len(tags), len(size) + 1))
    theta[:, -1] = np.log(share / (1 - share))
    live = np.arange(len(tags))
    f, g = value(live, theta)
    moves = np.zeros((MEMORY, *theta.shape))
    bends = np.zeros((MEMORY, *theta.shape))
    inverse = np.zeros((MEMORY, len(tags)))  # 1 / (move . bend), 0 for an empty place
    step, way = np.ones(len(tags)), np.zeros_like(theta)
    fresh = np.ones(len(tags), bool)
    for _ in range(passes):
        live = live[np.abs(g[live]).max(1) > tol]
        if not len(live):
            break
        new = live[fresh[live]]
        if len(new):
            q, used = g[new].copy(), []
            for m in range(MEMORY):
                a = inverse[m, new] * (moves[m, new] * q).sum(1)
                q -= a[:, None] * bends[m, new]
                used.append(a)
            q = curved(new, q)
            for m in reversed(range(MEMORY)):
                b = inverse[m, new] * (bends[m, new] * q).sum(1)
                q += (used[m] - b)[:, None] * moves[m, new]
            way[new], step[new], fresh[new] = -q, 1.0, False
        trial = theta[live] + step[live, None] * way[live]
        f_new, g_new = value(live, trial)
        slope = (g[live] * way[live]).sum(1)
        good = f_new <= f[live] + 1e-4 * step[live] * slope + 1e-15
        step[live[~good]] /= 2
        took = live[good]
        move, bend = trial[good] - theta[took], g_new[good] - g[took]
        turn = (move * bend).sum(1)
        for store, last in ((moves, move), (bends, bend)):
            store[1:, took] = store[:-1, took]
            store[0, took] = last
        inverse[1:, took] = inverse[:-1, took]
        inverse[0, took] = np.where(turn > 1e-300, 1 / np.where(turn > 1e-300, turn, 1), 0)
        theta[took], f[took], g[took], fresh[took] = trial[good], f_new[good], g_new[good], True
        live = live[step[live] > 1e-12]
    return theta


def tag_scores(matrix: DataFrame, theta: np.ndarray) -> DataFrame:
    """``tag, score, label`` of every row and tag: the margin of the tag's model, and whether the row has it."""
    sent = matrix.sparkSession.sparkContext.broadcast(theta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta = sent.value
        for batch in batches:
            for x, row, tag in _dense(batch, len(theta)):
                z = x @ theta[:, :-1].T + theta[:, -1]
                label = np.zeros(z.shape)
                label[row, tag] = 1
                tags = np.tile(np.arange(len(theta), dtype=np.int32), len(x))
                yield pa.record_batch([pa.array(tags), pa.array(z.ravel()), pa.array(label.ravel())], ["tag", "score", "label"])

    return matrix.select("x", "own").mapInArrow(run, "tag int, score double, label double")


def areas_under_roc(scored: DataFrame, *by: str, label: str = "label", score: str = "score") -> DataFrame:
    """``auc`` of each group ``by``: exact area under ROC, from rank sums of groups of equal scores.

    Rows are counted by score, the counts sorted in parallel and summed up within their partition;
    then only sums of partitions are added up, so no group and no frequent score meets in one
    task. Without positive rows the area is 0, without negative ones 1; rows with a NULL score or
    label do not count.
    """
    one = F.col(label).cast("double") == 1
    ties = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(F.count_if(one).cast("double").alias("_pos"), F.count_if(~one).cast("double").alias("_neg"))
    )
    placed = ties.orderBy(*by, "_score").withColumn("_part", F.spark_partition_id())
    within = W.partitionBy(*by, "_part").orderBy("_score").rowsBetween(W.unboundedPreceding, -1)
    won = F.col("_pos") * (F.coalesce(F.sum("_neg").over(within), F.lit(0.0)) + F.col("_neg") / 2)
    parts = placed.withColumn("_won", won).groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in ("_won", "_pos", "_neg")])
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    whole = F.col("_won") + F.col("_pos") * F.coalesce(F.sum("_neg").over(before), F.lit(0.0))
    sums = parts.withColumn("_won", whole).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("_won", "_pos", "_neg")])
    area = F.when(F.col("_pos") == 0, 0.0).when(F.col("_neg") == 0, 1.0).otherwise(F.try_divide("_won", F.col("_pos") * F.col("_neg")))
    return sums.select(*by, area.alias("auc"))
