"""Nearest neighbours by inner product with a vantage-point tree per shard.

The inner product is no metric, but with one more coordinate sqrt(M^2 - |x|^2) for candidates (M the largest norm) and 0 for queries the
Euclidean distance falls as the inner product rises, so the triangle inequality may prune. A child whose distance bound exceeds ``factor``
times the distance of the k-th best so far is skipped: factor one is exact search, smaller ones skip more. Scores are exact either way.

Every row is indexed. Shards hold about SHARD rows; queries go to every shard in blocks, and the best of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates per tree, queries per task, and candidates per leaf.
SHARD, QUERIES, LEAF = 8192, 16384, 256
#: Production pruning factor: 1 restores exact search.
FACTOR = 1.0


class Tree:
    """A vantage-point tree over the rows of a matrix, whose last column is the added coordinate."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 5):
        self.points, self.leaf, self.rng = points, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        centre = self.points[rows[self.rng.integers(len(rows))]]
        d = np.sqrt(((self.points[rows] - centre) ** 2).sum(axis=1))
        half = len(rows) // 2
        order = np.argpartition(d, half)  # split by rank: equal distances cannot unbalance the tree
        near, far = order[:half], order[half:]
        return centre, (d[near].min(), d[near].max(), self._build(rows[near])), (d[far].min(), d[far].max(), self._build(rows[far]))


class Search:
    """Batched search: queries walk down together, each group nearer child first."""

    def __init__(self, tree: Tree, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, top: float, factor: float):
        self.tree, self.ids, self.vectors, self.query_ids, self.queries, self.k, self.factor = tree, ids, vectors, query_ids, queries, k, factor
        self.flat = np.hstack([queries, np.zeros((len(queries), 1))])
        self.reach = (queries**2).sum(axis=1) + top * top
        self.best = np.full((len(queries), k), -np.inf)
        self.who = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0
        if len(queries):
            self._visit(tree.root, np.arange(len(queries)))

    def _radius(self, q: np.ndarray) -> np.ndarray:
        kth = self.best[q, -1]
        return np.where(np.isinf(kth), np.inf, np.sqrt(np.maximum(self.reach[q] - 2 * np.where(np.isinf(kth), 0, kth), 0)))

    def _open(self, child, q: np.ndarray, d: np.ndarray) -> np.ndarray:
        low, high, _ = child
        bound = np.maximum(np.maximum(low - d, d - high), 0)
        r = self._radius(q)
        return bound <= self.factor * r + 1e-7 * (1 + np.where(np.isinf(r), 0, r))

    def _visit(self, node, q: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            return self._scan(node, q)
        centre, near, far = node
        d = np.sqrt(np.maximum(((self.flat[q] - centre) ** 2).sum(axis=1), 0))
        inside = d <= near[1]
        for first, then, who in ((near, far, inside), (far, near, ~inside)):
            for child in (first, then):
                go = who.copy()
                go[who] = self._open(child, q[who], d[who])
                if go.any():
                    self._visit(child[2], q[go])
        return None

    def _scan(self, rows: np.ndarray, q: np.ndarray) -> None:
        self.compared += len(rows) * len(q)
        scores = self.queries[q] @ self.vectors[rows].T
        a, b = np.nonzero((scores >= self.best[q, -1][:, None]) & (self.ids[rows][None, :] != self.query_ids[q][:, None]))
        if not len(a):
            return
        hit = np.unique(a)
        owner = np.concatenate([a, np.repeat(hit, self.k)])
        score = np.concatenate([scores[a, b], self.best[q[hit]].ravel()])
        who = np.concatenate([self.ids[rows[b]], self.who[q[hit]].ravel()])
        order = np.lexsort((who, -score, owner))
        owner, score, who = owner[order], score[order], who[order]
        start = np.searchsorted(owner, hit)
        take = start[:, None] + np.arange(self.k)
        self.best[q[hit]], self.who[q[hit]] = score[take], who[take]


def usable(v: Column) -> Column:
    """Not null, without null, infinite or NaN components, and not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, shard: int = SHARD, per_task: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` candidates with the largest inner product found for each query, ties to the smaller id.

    Both tables have vec_id and embedding. Rows that are not ``usable`` or have a null id take no part; a query meets vectors of its own
    length only and never a row with its own id. Queries repeated under one id count once; repeated candidates are all returned. With fewer
    than ``k`` candidates all are returned; empty tables give no rows.
    """
    def clean(df):
        return df.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))

    rows, asked = clean(vectors), clean(queries).dropDuplicates(["vec_id"])
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    stats = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("shards"), F.max(norm).alias("top"))
    loads = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_task)).cast("int").alias("splits"))
    plan = stats.join(loads, "dim")  # a row for each vector length
    one = rows.join(plan, "dim").select(
        "dim", F.pmod(F.xxhash64("vec_id", "v"), "shards").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), F.lit(0).alias("asks"), "vec_id", "v", "top")
    two = asked.join(plan, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("vec_id"), "splits").cast("int").alias("split"), F.lit(1).alias("asks"), "vec_id", "v", "top")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy() == 1
        ids, all_vectors = pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_list())
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if asks.all() or not asks.any():
            return empty
        order = np.argsort(ids[~asks], kind="stable")
        have, named, top = all_vectors[~asks][order], ids[~asks][order], float(pdf["top"].iloc[0])
        added = np.sqrt(np.maximum(top * top - (have**2).sum(axis=1), 0))[:, None]
        found = Search(Tree(np.hstack([have, added])), named, have, ids[asks], all_vectors[asks], k, top, factor)
        q, r = np.nonzero(found.best > -np.inf)
        return pd.DataFrame({"query_id": found.query_ids[q], "vec_id": found.who[q, r], "score": found.best[q, r]})

    best = one.unionByName(two).groupBy("dim", "shard", "split").applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
