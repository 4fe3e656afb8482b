"""Nearest neighbours by inner product with a vantage-point tree per shard (operator 6).

Vectors get one more component that brings all of them to the greatest norm M, and
queries a zero there; then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the largest inner
products are the nearest points of a metric space.  Rows are dealt to shards of a
bounded number of rows by a hash of their id, queries to blocks; each (shard, block)
pair is one task's work: build the tree over the shard, search it for the block.  The
shards' best are merged by Spark.

A branch is left out if the triangle inequality shows that it holds nothing nearer than
the k-th found so far; ``factor`` divides that k-th distance.  With 1 the search is
exact; greater factors leave out more and may miss neighbours.

Nulls and edges: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither as queries nor as candidates, nor do rows without an
id; vectors whose square overflows are compared one by one (a product that is minus
infinity or no number is no find); vectors meet only vectors of their own length; ties go to the smaller id; rows that
repeat an id and a vector are one candidate; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
LEAF = 256
K = 20
FACTOR = 1.1
FOUND = "query_id long, vec_id long, score double"


class VpTree:
    """Vantage-point tree over unit-padded points; leaves hold up to ``LEAF`` rows."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.points, self.ids = points, ids
        with np.errstate(over="ignore"):
            self.squares_ = (points ** 2).sum(1)
        held = np.isfinite(self.squares_)  # distances to the others overflow: they are compared one by one
        self.others = np.flatnonzero(~held)
        self.root = self._build(np.flatnonzero(held), np.random.default_rng(len(points)))

    def _build(self, rows: np.ndarray, rng: np.random.Generator):
        if len(rows) <= LEAF:
            return rows
        vantage = self.points[rows[rng.integers(len(rows))]]
        d = np.sqrt(np.maximum(((self.points[rows] - vantage) ** 2).sum(1), 0))
        order = np.argsort(d, kind="stable")
        rows, d, half = rows[order], d[order], len(rows) // 2
        # both sides keep their range of distances, so equal distances may stand on either
        return (vantage, (d[0], d[half - 1]), (d[half], d[-1]), self._build(rows[:half], rng), self._build(rows[half:], rng))

    def search(self, queries: np.ndarray, ids: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k largest inner products of each query; a query's own id is left out."""
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1, np.int64)
        self.reach = np.full(len(queries), np.inf)  # distance to the k-th found
        self.queries, self.own, self.factor = queries, ids, factor
        with np.errstate(over="ignore", invalid="ignore"):
            self.squares = (queries ** 2).sum(1) + self.squares_[np.isfinite(self.squares_)].max(initial=0.0)
            for rows in (self.others, self.root):
                self._visit(rows, np.arange(len(queries)))
        return self.found, self.best

    def _visit(self, node, q: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            return self._leaf(node, q)
        vantage, *ranges, inner, outer = node
        d = np.sqrt(np.maximum(((self.queries[q] - vantage) ** 2).sum(1), 0))
        gaps = [np.maximum(np.maximum(lo - d, d - hi), 0) for lo, hi in ranges]
        first = gaps[0] <= gaps[1]
        for near, child in ((first, inner), (~first, outer)):
            self._branch(child, q[near], gaps[0 if child is inner else 1][near])
        for far, child in ((~first, inner), (first, outer)):
            self._branch(child, q[far], gaps[0 if child is inner else 1][far])

    def _branch(self, child, q: np.ndarray, gap: np.ndarray) -> None:
        q = q[gap <= self.reach[q] / self.factor + 1e-9]
        if len(q):
            self._visit(child, q)

    def _leaf(self, rows: np.ndarray, q: np.ndarray) -> None:
        if not len(rows) or not len(q):
            return
        scores = self.queries[q] @ self.points[rows].T
        scores[np.isnan(scores)] = -np.inf
        some = scores.max(1) >= self.best[q, -1]
        q, scores = q[some], scores[some]
        if not len(q):
            return
        ids = np.broadcast_to(self.ids[rows], scores.shape)
        scores = np.where(ids == self.own[q, None], -np.inf, scores)
        scores, ids = np.concatenate((self.best[q], scores), 1), np.concatenate((self.found[q], ids), 1)
        k = self.best.shape[1]
        # ties at the k-th place go to the smaller id, so order by both
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
        self.best[q], self.found[q] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
        worst = self.best[q, -1]
        self.reach[q] = np.where(np.isfinite(worst) & np.isfinite(self.squares[q]), np.sqrt(np.maximum(self.squares[q] - 2 * worst, 0)), np.inf)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in order of the components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = K, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every row for which ``is_query`` holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = materialize(rows.groupBy("vec_id", "v", "dim").agg(F.max("asks").alias("asks")).withColumn("square", norm), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("asking"), F.max(F.when(F.col("square") < float("inf"), F.col("square"))).alias("top"))
    sizes = [r for r in sizes.collect() if r["asking"]]  # one row per vector length
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = None
    for r in sizes:
        shards, blocks, top = -(-r["n"] // shard_rows), -(-r["asking"] // block_queries), r["top"] or 0.0
        own = rows.filter(F.col("dim") == r["dim"])
        shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
        block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
        pad = F.when(F.col("square") < float("inf"), F.sqrt(F.greatest(F.lit(top) - F.col("square"), F.lit(0.0)))).otherwise(0.0)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        points = own.select(F.lit(r["dim"]).alias("dim"), shard.alias("shard"), every(blocks).alias("block"), "vec_id", F.concat("v", F.array(pad)).alias("v"), F.lit(False).alias("asks"))
        queries = own.filter("asks").select(F.lit(r["dim"]).alias("dim"), every(shards).alias("shard"), block.alias("block"), "vec_id", F.concat("v", F.array(F.lit(0.0))).alias("v"), F.lit(True).alias("asks"))
        both = points.unionByName(queries)
        parts = both if parts is None else parts.unionByName(both)

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["asks"].to_numpy()
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        v, ids = np.stack(frame["v"].to_numpy()), frame["vec_id"].to_numpy()
        tree = VpTree(v[~asks], ids[~asks])
        found, scores = tree.search(v[asks], ids[asks], k, factor)
        at = np.nonzero(scores > -np.inf)
        place = np.full(found.shape, -1)
        order = np.argsort(ids[~asks], kind="stable")
        place[at] = order[np.searchsorted(ids[~asks], found[at], sorter=order)]
        return pd.DataFrame({"query_id": ids[asks][at[0]], "vec_id": found[at], "score": products(v[asks][at[0]], v[~asks][place[at]])})

    found = parts.groupBy("dim", "shard", "block").applyInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.filter(~F.isnan("score")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
