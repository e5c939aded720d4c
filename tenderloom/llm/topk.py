"""Exact top-k inner products by block-at-a-time pruning.

Candidates are cut into shards of consecutive ids; a shard groups its vectors so that similar ones stand together, cuts them into blocks of ``BLOCK`` and
keeps the blocks' vectors (the forward index) and the largest and smallest value of each dimension. The bound of a block for a query is the sum over its
dimensions of the larger of weight times largest and weight times smallest. Each query takes the blocks in falling order of bounds and stops
once a bound is below its k-th score so far (an equal bound is still scored, for ties go to smaller ids). Shards give their exact top k; a
query's best of those is its answer. Groups of queries meet every shard by an equi-join key; one shard and one group are in memory at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import stored

SHARD, GROUP, BLOCK, PIVOTS = 8192, 512, 64, 32
# So many tasks share the queries of one shard.
SPLITS = 4


def integer_vectors(df: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * component). Rows with a null id, a null vector or a null or non-finite component are left out."""
    whole = F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros to one width; a missing component adds nothing to a product."""
    out = np.zeros((len(column), width), np.int64)
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    row, at = np.repeat(np.arange(len(column)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = column.flatten().to_numpy()
    return out


def _chunks(vectors: DataFrame, size: int, width: int) -> DataFrame:
    """Consecutive vectors as rows of at most ``size``: number, n, ids and components as binary."""
    def run(batches):
        from pyspark import TaskContext
        part, k, held = TaskContext.get().partitionId(), 0, []

        def row():
            nonlocal k, held
            ids, v = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            k, held = k + 1, []
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + k], pa.int64()), pa.array([len(ids)], pa.int64()),
                                               pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], ["number", "n", "ids", "v"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                one = batch.slice(at, size)
                held.append((one.column("vec_id").to_numpy(), _matrix(one.column("v"), width)))
                if sum(len(h[0]) for h in held) + size > size * 2 - 1:
                    yield row()
        if held:
            yield row()

    return vectors.mapInArrow(run, "number long, n long, ids binary, v binary")


class Shard:
    """Forward index of one shard, grouped, with the term maxima and minima of its blocks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        pivots = vectors[np.linspace(0, len(ids) - 1, min(PIVOTS, len(ids))).astype(int)].astype(float)
        near = (vectors.astype(float) @ pivots.T - 0.5 * (pivots * pivots).sum(axis=1)).argmax(axis=1)
        order = np.lexsort((ids, near))
        self.ids, self.vectors = ids[order], vectors[order]
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((np.arange(len(ids)), self.ids))] = np.arange(len(ids))
        self.low = len(ids) - 1 - rank        # breaks ties: larger for smaller ids
        starts = np.arange(0, len(ids), BLOCK)
        self.starts = np.append(starts, len(ids))
        self.most, self.least = np.maximum.reduceat(self.vectors, starts), np.minimum.reduceat(self.vectors, starts)
        self.largest = int(np.abs(self.vectors).max(initial=0))

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, candidate ids and scores of each query's best k here, but itself."""
        reach = int(np.abs(q).max(initial=0)) * self.largest * q.shape[1]
        if reach >= 1 << 48:
            return self._plain(q_ids, q, k)
        kind = np.float32 if reach < 1 << 24 else np.float64      # products and sums stay exact
        weights, index = q.astype(kind), self.vectors.astype(kind)
        bounds = np.maximum(weights, 0) @ self.most.T.astype(kind) + np.minimum(weights, 0) @ self.least.T.astype(kind)
        order = np.argsort(-bounds, axis=1, kind="stable")
        best = np.full((len(q), k), np.iinfo(np.int64).min)
        rows, at, width = np.arange(len(q))[:, None], 0, 1
        while at < order.shape[1]:
            mine = order[:, at:at + width]
            alive = bounds[rows, mine] >= (best[:, :1] >> 14)
            if not alive[:, 0].any():
                break
            wanted = np.zeros(bounds.shape, bool)
            wanted[np.broadcast_to(rows, mine.shape)[alive], mine[alive]] = True
            for b in np.flatnonzero(wanted.any(axis=0)):
                who, own = np.flatnonzero(wanted[:, b]), slice(self.starts[b], self.starts[b + 1])
                keys = ((weights[who] @ index[own].T).astype(np.int64) << 14) + self.low[own]
                keys[q_ids[who][:, None] == self.ids[own]] = np.iinfo(np.int64).min
                best[who] = np.partition(np.concatenate([best[who], keys], axis=1), keys.shape[1], axis=1)[:, -k:]
            best.sort(axis=1)
            at, width = at + width, min(2 * width, 64)
        by_low = np.empty(len(self.ids), np.int64)
        by_low[self.low] = self.ids
        found = best > np.iinfo(np.int64).min
        return np.repeat(q_ids, found.sum(axis=1)), by_low[best[found] & 0x3FFF], best[found] >> 14

    def _plain(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Components so large that a product leaves the exact range of doubles: whole numbers of any size, clamped to a long at the end."""
        rows = []
        for i, one in zip(q_ids, q):
            scores = self.vectors.astype(object) @ one.astype(object)
            ranked = sorted((-s, int(c)) for s, c in zip(scores, self.ids) if c != i)[:k]
            rows += [(i, c, max(min(-s, (1 << 63) - 1), -(1 << 63))) for s, c in ranked]
        return tuple(np.array([r[j] for r in rows], np.int64) for j in range(3))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the k largest inner products of each query with all vectors but those of its own id.

    Both tables are (vec_id, v array<long>) as ``integer_vectors`` gives them. Ties go to the smaller id; fewer candidates give fewer
    rows. Missing components count as 0. A repeated id is a candidate as often as it occurs, and a query's answers are those of all its rows. Empty tables give no rows.
    """
    vectors = stored(vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id"), "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    shards = stored(_chunks(vectors, SHARD, width), "shards")
    groups = _chunks(queries.select("vec_id", "v").repartitionByRange("vec_id").sortWithinPartitions("vec_id"), GROUP, width)
    numbers = [r.number for r in shards.select("number").collect()]      # one long per SHARD vectors
    split = F.pmod(F.xxhash64("number"), F.lit(SPLITS))
    left = shards.select(F.col("number").alias("shard"), F.explode(F.array(*(F.lit(s).cast("long") for s in range(SPLITS)))).alias("split"), F.lit(0).alias("kind"), "ids", "v")
    right = groups.select(F.explode(F.array(*(F.lit(n).cast("long") for n in numbers)) if numbers else F.array().cast("array<long>")).alias("shard"), split.alias("split"), F.lit(1).alias("kind"), "ids", "v")
    met = left.union(right).repartition("shard", "split").sortWithinPartitions("shard", "split", "kind")

    def run(batches):
        shard = None
        for batch in batches:
            for kind, ids, v in zip(batch.column("kind").to_pylist(), batch.column("ids"), batch.column("v")):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                v = np.frombuffer(v.as_buffer(), np.int64).reshape(len(ids), width)
                if kind == 0:
                    shard = Shard(ids, v)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in shard.search(ids, v, k)], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
