"""Exact top-k search by inner product: MaxScore over dimension postings in shards, then a merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timbrelake.session import ship_package

TOP = 20
#: Vectors of a shard and queries of a block: one task works on one of each.
SHARD, BLOCK = 4_096, 1_024
#: Vectors that are traversed between two looks at the scores to beat.
STEP = 1_024
NO_ID = (1 << 63) - 1


def vectors(frame: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``uid, vec_id, v``: floor(64 * x) of each component; without unusable vectors.

    Vectors that are null or hold a null or a component that is not finite are left out.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.select(
        F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("vec_id"), values.alias("x")
    )
    return rows.where(F.col("x").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        "uid", "vec_id", F.transform("x", lambda x: F.floor(x * 64)).alias("v")
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column; shorter vectors are filled up with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


class Best:
    """The k best candidates of each query so far: greater score first, then smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.n = k, queries
        self.query, self.row = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score, self.id = np.empty(0), np.empty(0, np.int64)
        #: Score that a candidate has to reach.
        self.least = np.full(queries, -np.inf)

    def add(self, query, row, score, id_) -> None:
        query, row = np.append(self.query, query), np.append(self.row, row)
        score, id_ = np.append(self.score, score), np.append(self.id, id_)
        order = np.lexsort((id_, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.query, order = query[keep], order[keep]
        self.row, self.score, self.id = row[order], score[order], id_[order]
        last = rank[keep] == self.k - 1
        self.least[self.query[last]] = self.score[last]


def maxscore(q: np.ndarray, q_uid: np.ndarray, v: np.ndarray, v_uid: np.ndarray, v_id: np.ndarray, k: int = TOP) -> Best:
    """The k best vectors of a shard for each query, none but the query's own row left out.

    A dimension is a term; its posting list holds the vectors whose contribution is above the
    least. Terms whose greatest contributions together cannot lift a vector from the least score
    to the score to beat are not essential: a vector in no essential list need not be looked at.
    Essential lists are traversed to partial scores; the others are probed, those with wide
    bounds first, only while vectors can still reach the score to beat: for the whole block while
    many can, then for the few that are left.
    """
    best = Best(len(q), k)
    high, low = v.max(0), v.min(0)
    up, down = np.maximum(q * high, q * low), np.minimum(q * high, q * low)
    spread = up - down
    order = np.argsort(spread, 1, kind="stable")  # narrow terms first
    reach = np.cumsum(np.take_along_axis(spread, order, 1), 1)
    floor = down.sum(1)
    sequence = np.argsort(v_id, kind="stable")
    for at in range(0, len(v), STEP):
        rows = sequence[at : at + STEP]
        block = v[rows]
        skipped = (floor[:, None] + reach) < best.least[:, None]
        essential = np.empty_like(skipped)
        np.put_along_axis(essential, order, ~skipped, 1)
        partial = np.where(essential, q, 0) @ block.T
        can = q_uid[:, None] != v_uid[rows][None]
        pending = ~essential
        while True:
            can &= partial + np.where(pending, up, 0).sum(1)[:, None] >= best.least[:, None]
            if not pending.any() or can.sum() < can.size >> 6:
                break
            now = _next_terms(pending, spread)
            partial += np.where(now, q, 0) @ block.T
            pending &= ~now
        if len(rows) > k and not np.isfinite(best.least).all():
            # nothing to beat yet: the first block sets it
            cut = np.partition(np.where(can, partial, -np.inf), len(rows) - k, 1)[:, len(rows) - k]
            can &= partial >= np.where(np.isfinite(best.least), -np.inf, cut)[:, None]
        i, j = np.nonzero(can)
        score, left = partial[i, j], pending[i]
        while len(i) and left.any():
            now = _next_terms(left, spread[i])
            score = score + np.einsum("nd,nd->n", np.where(now, q[i], 0), block[j])
            left &= ~now
            ok = score + np.where(left, up[i], 0).sum(1) >= best.least[i]
            i, j, score, left = i[ok], j[ok], score[ok], left[ok]
        best.add(i, rows[j], score, v_id[rows[j]])
    return best


def _next_terms(pending: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Of the pending terms of each row those whose bounds are at least half as wide as the widest."""
    width = np.where(pending, spread, -1.0)
    return pending & (width >= width.max(1, keepdims=True) / 2)


def plain(q: np.ndarray, q_uid: np.ndarray, v: np.ndarray, v_uid: np.ndarray, v_id: np.ndarray, k: int = TOP) -> Best:
    """As :func:`maxscore` with integers of any size, for components beyond what doubles hold exactly."""
    best = Best(len(q), k)
    best.score = best.score.astype(object)
    for i in range(len(q)):
        scores = v.astype(object) @ q[i].astype(object)
        rows = [r for r in range(len(v)) if v_uid[r] != q_uid[i]]
        rows.sort(key=lambda r: (-scores[r], v_id[r]))
        rows = rows[:k]
        best.query, best.row = np.append(best.query, [i] * len(rows)).astype(np.int64), np.append(best.row, rows).astype(np.int64)
        best.score, best.id = np.append(best.score, scores[rows]), np.append(best.id, v_id[rows])
    return best


def _search(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_uid", "query_id", "vec_id", "score"]
        empty = pa.table([pa.array([], pa.int64())] * 4, names)
        if not candidates.num_rows or not queries.num_rows:
            return empty
        width = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (candidates, queries))
        if not width:
            width = 1
        v, q = matrix(candidates.column("v"), width), matrix(queries.column("v"), width)
        v_uid, v_id = (candidates.column(c).to_numpy() for c in ("uid", "vec_id"))
        q_uid, q_id = (queries.column(c).to_numpy() for c in ("uid", "vec_id"))
        size = float(np.abs(q.astype(float)).max() * np.abs(v.astype(float)).max() * 2 * width)
        if size < 1 << 52:
            best = maxscore(q.astype(float), q_uid, v.astype(float), v_uid, v_id, k)
            score = best.score.astype(np.int64)
        else:
            best = plain(q, q_uid, v, v_uid, v_id, k)
            score = np.array([max(-NO_ID - 1, min(NO_ID, int(s))) for s in best.score], np.int64)
        return pa.table([q_uid[best.query], q_id[best.query], best.id, score], names)

    return run


def top_k(frame: DataFrame, every: int = 20, k: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows with the greatest inner product.

    Queries are the rows whose vec_id divides by ``every``; a row is never its own candidate, a
    repeated row is. Components are floor(64 * x); equal scores go to the smaller vec_id, a null
    vec_id comes last. Unusable vectors (see :func:`vectors`) take no part; vectors of unequal
    length are filled up with zeros; scores beyond a long are its bounds. Fewer candidates than k
    give fewer rows, an empty table gives none. Extra columns are ignored.

    Rows go to shards of about ``shard`` vectors, queries to blocks; every pair of a shard and a
    block is one task of bounded size, and copies of one vector are spread like others. The best
    k of each shard are merged by a window that cuts before it shuffles.
    """
    spark = frame.sparkSession
    ship_package(spark)
    found = vectors(frame)
    asked = found.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID))
    n, queries = found.count(), asked.count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-queries // block))
    left = found.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = asked.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    some = pairs.applyInArrow(_search(k), "query_uid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id"))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score"
    )
