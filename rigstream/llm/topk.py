"""Exact top-k search by inner product with Fagin's threshold algorithm.

Candidates are split into shards. A shard keeps one sorted list per dimension. A query reads the
lists from the end that its component favours, ever deeper, a group of queries together; every row newly met is
scored once, for the queries that still search, and the sum of the products at the present depth bounds all rows not met yet. A query stops when that
bound is below its k-th best score (strictly, as ties go to the smaller id). Depths double.

Queries are dealt in blocks and meet every shard in a co-group of bounded size; the best k of each
shard meet in one more aggregation. Nothing of the queries or the candidates is broadcast.

A vector takes no part if it is null or empty, has a null or non-finite component or one that is not finite
once scaled, or no id. Vectors of another length than the query's are not compared. Rows of the query's id are
not its candidates; all other rows are, repeated ones each. Of several vectors of one id the first by length and packed
bytes is the query. Scores are exact whole numbers; beyond 64 bits they are cut to the largest or smallest
one. Empty tables give no rows. Columns beside id and vector do not matter, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rigstream.llm import vectors as packing

SHARD = 4_096
QUERIES = 4_096
#: Queries that read the lists together, and the depth they read to at first.
GROUP, FIRST_DEPTH = 64, 16


def scaled(vectors: DataFrame, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``dims`` and ``v``, the components floor(scale * x) packed, of the rows that take part."""
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("_v"))
    return packing.packed(named.where(F.col("vec_id").isNotNull()), scale, "_v")


class Lists:
    """The sorted lists of a shard, one per dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        order = np.argsort(rows, axis=0, kind="stable")
        self.rising = np.take_along_axis(rows, order, 0)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))

    def _bounds(self, queries: np.ndarray, depth: int, small: bool) -> np.ndarray:
        """What no row beyond ``depth`` in all lists exceeds, for each query."""
        high, low = self.rising[len(self.rows) - depth], self.rising[depth - 1]
        if small:
            return (np.maximum(queries, 0) @ high + np.minimum(queries, 0) @ low).astype(np.int64)
        ends = np.where(queries > 0, high, np.where(queries < 0, low, 0.0))
        return np.array([packing.products(q[None, :], e[None, :], False)[0, 0] for q, e in zip(queries, ends)])

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, small: bool) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """For each of some queries the rows of the ``k`` best and their scores; and how many products were taken.

        The queries read the lists together: a row that any of them newly meets is scored, once, for all that still search.
        """
        n = len(self.rows)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        left = np.ones(n, bool)
        searching, taken, before, depth = np.arange(len(queries)), 0, 0, min(FIRST_DEPTH, n)
        while len(searching):
            q = queries[searching]
            up, down = np.flatnonzero((q > 0).any(axis=0)), np.flatnonzero((q < 0).any(axis=0))
            met = np.zeros(n, bool)
            met[self.order[up, n - depth : n - before]] = True
            met[self.order[down, before:depth]] = True
            if depth == n:
                met[:] = True
            new = np.flatnonzero(met & left)
            left[new] = False
            taken += len(q) * len(new)
            scores = packing.products(q, self.rows[new], small)
            ids = self.ids[new]
            bounds = self._bounds(q, depth, small)
            goes_on = np.ones(len(searching), bool)
            for at, number in enumerate(searching):
                best[number] = self._merged(best[number], new, np.where(ids == own[number], packing.LEAST, scores[at]), own[number], k)
                found = best[number][1]
                goes_on[at] = depth < n and not (len(found) == k and found[-1] > bounds[at])
            searching = searching[goes_on]
            before, depth = depth, min(n, 2 * depth)
        return best, taken

    def _merged(self, best: tuple[np.ndarray, np.ndarray], new: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of those so far and the new rows; ties go to the smaller id."""
        rows, held = best
        cut = held[-1] if len(held) == k else np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else packing.LEAST
        may = np.flatnonzero(scores >= cut)
        may = may[self.ids[new[may]] != own]
        rows, held = np.append(rows, new[may]), np.append(held, scores[may])
        # the lowest 64-bit number has no opposite
        kept = np.lexsort((self.ids[rows], -np.maximum(held, packing.LEAST + 1)))[:k]
        return rows[kept], held[kept]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``, ``rows_scored``: the k best of ``vectors`` for each of ``queries``.

    Both hold ``vec_id``, ``dims`` and ``v``, as ``scaled`` makes them. ``rows_scored`` counts the products that the
    query's group took in the shard that the row comes from.
    """
    # queries that come of the same table must not share its columns' identities with it
    asked = queries.groupBy(F.col("vec_id").alias("asked")).agg(F.min(F.struct("dims", "v")).alias("_q")).select("asked", "_q.*")
    shards, blocks = (max(1, -(-df.count() // size)) for df, size in ((vectors, shard), (asked, block)))
    # a row's own number deals repeated rows over the shards
    number = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    held = vectors.withColumn("shard", number).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    put = asked.withColumn("block", F.pmod(F.xxhash64("asked"), F.lit(blocks)).cast("int"))
    put = put.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    schema = pa.schema([(name, pa.int64()) for name in ("query_id", "vec_id", "score", "rows_scored")])

    def meet(key: tuple, theirs: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        if theirs.num_rows and rows.num_rows:
            dims = key[2].as_py()
            asking, own = packing.unpacked(theirs.column("v"), dims), theirs.column("asked").to_numpy()
            lists = Lists(packing.unpacked(rows.column("v"), dims), rows.column("vec_id").to_numpy())
            small = packing.are_small(asking, lists.rows)
            for begin in range(0, len(own), GROUP):
                part = slice(begin, begin + GROUP)
                searched, taken = lists.search(asking[part], own[part], k, small)
                for query_id, (best, scores) in zip(own[part], searched):
                    found.append([np.full(len(best), query_id), lists.ids[best], scores, np.full(len(best), taken)])
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
        return pa.table(columns, schema=schema)

    keys = ["block", "shard", "dims"]
    met = put.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long, rows_scored long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "rows_scored")
