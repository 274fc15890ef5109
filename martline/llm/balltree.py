"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Vectors are dealt over shards of bounded size by a hash of their row.  Each shard
builds a ball tree and meets the queries in blocks; nodes are taken in the order
of their inner-product upper bound  q.c + |q| r,  and a node that cannot beat a
query's current kth score is skipped for that query.  A first round searches one
shard per query; its kth scores are shared with all shards as where to start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import stored

#: Vectors of one shard, vectors of one leaf, queries of one block.
SHARD_ROWS, LEAF, BLOCK = 16_384, 128, 512
NONE = np.iinfo(np.int64).min
_VECTOR = "row long, vec_id long, dim int, q binary"


def quantised(column: pa.Array) -> list[bytes | None]:
    """floor(256 * x) of every component as int64 bytes; None where the vector takes no part."""
    out = []
    for v in column.to_numpy(zero_copy_only=False):
        if v is not None:
            x = np.asarray(v, dtype=np.float64)  # a null component becomes NaN
            if np.isfinite(x).all():
                out.append(np.clip(np.floor(256 * x), -2.0**63, 2.0**63 - 1024).astype(np.int64).tobytes())
                continue
        out.append(None)
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a and b, exact (held to the range of a long)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = a.shape[1] * float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max())
    if bound < 2.0**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    wide = a.astype(object) @ b.T.astype(object)
    return np.clip(wide, NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


class BallTree:
    """Nodes with centre and radius over rows that are ordered so that each node is one stretch."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.points = points.astype(np.float64)
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, end, left child, right child
        centres, radii = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = self.points[self.order[a:b]]
            centre = own.mean(axis=0)
            apart = ((own - centre) ** 2).sum(axis=1)
            at = len(self.nodes)
            self.nodes.append((a, b, -1, -1))
            centres.append(centre)
            radii.append(np.sqrt(apart.max()))
            if parent >= 0:
                p = self.nodes[parent]
                self.nodes[parent] = (p[0], p[1], at, p[3]) if side == 0 else (p[0], p[1], p[2], at)
            if b - a > LEAF and apart.max() > 0:
                one = own[apart.argmax()]
                two = own[((own - one) ** 2).sum(axis=1).argmax()]
                along = own @ (two - one)
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(along, mid)]
                todo += [(a, a + mid, at, 0), (a + mid, b, at, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """[query, node]: no inner product with the node's rows is larger (rounding included)."""
        top = queries @ self.centres.T + norms[:, None] * self.radii
        return top + 1e-9 * (np.abs(top) + norms[:, None] * (1 + self.radii)) + 1e-6


class Shard:
    """The vectors of one dimension in a shard, and their tree."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, vectors: np.ndarray):
        self.tree = BallTree(vectors)
        order = self.tree.order
        self.row, self.vec_id, self.vectors = row[order], vec_id[order], vectors[order]

    def search(self, row: np.ndarray, vectors: np.ndarray, kth: np.ndarray,
               k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, vec_id, score) that can be among the k best, given scores that are known to be reached.

        The node with the largest bound over its queries comes first.
        """
        real = vectors.astype(np.float64)
        bound = self.tree.bounds(real, np.sqrt((real * real).sum(axis=1)))
        kth, best = kth.copy(), np.full((len(row), k), NONE)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        queue = [(-bound[:, 0].max(), 0)]
        while queue:
            _, node = heapq.heappop(queue)
            active = np.flatnonzero(bound[:, node] >= kth)
            if not len(active):
                continue
            a, b, left, right = self.tree.nodes[node]
            if left >= 0:
                for child in (left, right):
                    able = bound[active, child] >= kth[active]
                    if able.any():
                        heapq.heappush(queue, (-bound[active[able], child].max(), child))
                continue
            score = _products(vectors[active], self.vectors[a:b])
            score[self.row[a:b][None, :] == row[active][:, None]] = NONE
            merged = np.concatenate([best[active], score], axis=1)
            best[active] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            kth[active] = np.maximum(kth[active], best[active].min(axis=1))
            q, v = np.nonzero((score >= kth[active][:, None]) & (score > NONE))
            found.append((active[q], self.vec_id[a:b][v], score[q, v]))
        if not found:
            return
        q, v, s = (np.concatenate(x) for x in zip(*found))
        good = s >= kth[q]
        q, v, s = q[good], v[good], s[good]
        order = np.lexsort((v, -s, q))  # k best of each query, ties to the smaller id
        q, v, s = q[order], v[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        yield q[rank < k], v[rank < k], s[rank < k]


def _search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query row, query_id, vec_id, score) of the queries in their shards.

    ``vectors(shard, row, vec_id, dim, q)`` and ``queries(shard, row, vec_id, dim, q, kth)`` meet by shard:
    a shard's vectors come first in its task and are kept, its queries stream past in blocks.
    """
    both = (vectors.select("shard", F.lit(0).alias("part"), "row", "vec_id", "dim", "q", F.lit(None).cast("long").alias("kth"))
            .unionByName(queries.select("shard", F.lit(1).alias("part"), "row", "vec_id", "dim", "q", "kth"))
            .repartition("shard").sortWithinPartitions("shard", "part", "dim", "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, shards, held = None, [], {}, []

        def matrix(items: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return (np.array([i[0] for i in items], np.int64), np.array([i[1] for i in items], np.int64),
                    np.array([np.frombuffer(i[2], np.int64) for i in items]))

        def answer() -> Iterator[pa.RecordBatch]:
            for dim in sorted({h[3] for h in held}):
                if dim not in shards:
                    continue
                own = [h for h in held if h[3] == dim]
                row, vec_id, q = matrix(own)
                kth = np.array([NONE if h[4] is None else h[4] for h in own], np.int64)
                for at, ids, score in shards[dim].search(row, q, kth, k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[at]), pa.array(vec_id[at]), pa.array(ids), pa.array(score)],
                        ["row", "query_id", "vec_id", "score"])
            held.clear()

        def build() -> None:
            for dim in {r[3] for r in rows}:
                own = [r for r in rows if r[3] == dim]
                shards[dim] = Shard(*matrix(own))
            rows.clear()

        for b in batches:
            for shard, part, row, vec_id, dim, q, kth in zip(*(b.column(i).to_pylist() for i in range(7))):
                if shard != now:
                    yield from answer()
                    now, rows, shards = shard, [], {}
                if part == 0:
                    rows.append((row, vec_id, q, dim))
                    continue
                if rows:
                    build()
                held.append((row, vec_id, q, dim, kth))
                if len(held) >= BLOCK:
                    yield from answer()
        yield from answer()

    return both.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: query_id, rank (from 1), vec_id, score.

    Components are floor(256 * x); the score is the integer inner product with any
    row but the query's own, ties to the smaller vec_id; all rows return if
    there are fewer than ``k``.  Vectors that are null or hold a null or
    non-finite component, and rows without a vec_id, take no part; vectors of
    another length than the query's don't either.  Rows that repeat a vec_id are rows of their own.
    """
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = quantised(b.column(2))
            keep = pa.array([x is not None for x in q], pa.bool_())
            dim = [0 if x is None else len(x) // 8 for x in q]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dim, pa.int32()),
                                              pa.array(q, pa.binary())], ["row", "vec_id", "dim", "q"]).filter(keep)

    plain = (embeddings.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                               F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null"))
    rows = stored(plain.mapInArrow(prepare, _VECTOR), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    vectors = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    queries = vectors.where(F.col("vec_id") % every == 0)
    # first round: one shard each; its kth score is a score that the answer reaches
    home = _search(vectors, queries.withColumn("kth", F.lit(None).cast("long")), k)
    reached = stored(home.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("low")), "reached")
    kth = F.when(F.col("n") >= k, F.col("low"))
    shared = queries.join(reached, "row", "left").withColumn("kth", kth).drop("n", "low", "shard")
    everywhere = shared.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = _search(vectors, everywhere, k)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
