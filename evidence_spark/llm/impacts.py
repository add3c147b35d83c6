"""Exact top-k by inner product from an impact-ordered index, scored a segment at a time.

1. Vectors of whole numbers are dealt to shards. In a shard, each dimension's entries are quantised to LEVELS values; rows with the same level of a
   dimension are a posting segment, and all that a segment says of its rows is that level. A row's distance from its quantised self is kept.
2. A query visits segments by descending impact, the absolute product of its entry with the level, and adds the product to the score of every
   row of the segment.
3. Each segment that a row still misses can add or take away at most the impact reached, and at most the largest impact of its dimension;
   quantisation at most the query's norm times the row's distance (Cauchy and Schwarz). So every score lies between two known bounds. Rows
   whose upper bound is below the k-th best lower bound, or below the k-th best score of a sample of candidates, are out by proof. Visiting
   stops when few rows are left, or no segments.
4. The rows that are left are scored exactly, and the best of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.session import spread

#: Candidates per shard, queries per task, quantised values of a dimension, and candidates whose exact scores give the first threshold.
SHARD, QUERIES, LEVELS, SAMPLE = 8192, 4096, 128, 2048
#: Segments between two looks at the bounds, and possible members of a shard at which visiting ends.
STRIDE, FEW = 512, 64
#: Entries are held to this size; larger ones count as it, so that scores of 2,048 dimensions fit in a long.
LARGEST = 1 << 26


class Index:
    """Posting segments of one shard: dimension, level, and the rows from ``start`` to ``stop`` of ``rows``."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        n, dim = vectors.shape
        self.vectors = vectors
        width = max(1, -(-2 * int(np.abs(vectors).max(initial=0)) // levels))
        step = np.floor_divide(vectors, width)
        middle = step * width + (width - 1) / 2
        self.distance = np.sqrt(((vectors - middle) ** 2).sum(axis=1))
        rows, dims, mids, starts = [], [], [], []
        for d in range(dim):
            order = np.argsort(step[:, d], kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(step[order, d]) != 0))
            rows.append(order)
            dims.append(np.full(len(first), d))
            mids.append(middle[order[first], d])
            starts.append(first + d * n)
        self.rows = np.concatenate([np.empty(0, np.int64), *rows])
        self.dims = np.concatenate([np.empty(0, np.int64), *dims])
        self.mids = np.concatenate([np.empty(0), *mids])
        self.starts = np.concatenate([np.empty(0, np.int64), *starts])
        self.stops = np.append(self.starts[1:], len(self.rows)) if dim else self.starts
        self.visited = 0

    def possible(self, query: np.ndarray, k: int, least: float, own: np.ndarray, stride: int = STRIDE, few: int = FEW) -> np.ndarray:
        """Rows that may belong to the ``k`` best, or reach ``least``; all that do are among them. Rows in ``own`` never belong."""
        n = len(self.vectors)
        q = query.astype(float)
        slack = np.sqrt(q @ q) * self.distance
        impact = np.abs(q[self.dims] * self.mids)
        order = np.argsort(-impact, kind="stable")
        order = order[impact[order] > 0]
        most = np.zeros(len(q))
        np.maximum.at(most, self.dims, impact)
        score, met = np.zeros(n), np.zeros(n, np.int64)
        alive = np.ones(n, bool)
        alive[own] = False
        for at in range(0, len(order) + 1, stride):
            segments = order[at: at + stride]
            if len(segments):
                sizes = self.stops[segments] - self.starts[segments]
                ends = np.cumsum(sizes)
                places = np.repeat(self.starts[segments] - ends + sizes, sizes) + np.arange(ends[-1])
                rows = self.rows[places]
                score += np.bincount(rows, np.repeat(q[self.dims[segments]] * self.mids[segments], sizes), n)
                met += np.bincount(rows, minlength=n)
                self.visited += len(rows)
            # a visited dimension of a row has at least the impact reached, so it counts as that in the first sum
            reached = impact[order[at + stride]] if at + stride < len(order) else 0.0
            rest = np.minimum(most, reached).sum() - met * reached + slack
            rest = rest + 1e-9 * (1 + rest + np.abs(score))
            low = (score - rest)[alive]
            bound = max(least, np.partition(low, len(low) - k)[len(low) - k]) if len(low) >= k else least
            alive &= score + rest >= bound
            if alive.sum() <= max(few, k):
                break
        return np.flatnonzero(alive)


def top(index: Index, ids: np.ndarray, query_id: int, query: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the at most ``k`` best rows of the index, ties to the smaller id; rows below ``least`` may be missing."""
    rows = index.possible(query, k, least, np.flatnonzero(ids == query_id))
    scores = index.vectors[rows] @ query
    best = np.lexsort((ids[rows], -scores))[:k]
    return rows[best], scores[best]


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * c) of every entry, as longs; entries beyond LARGEST count as LARGEST. Null for vectors that are null or hold null or non-finite entries."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(wide, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))))


def _first_thresholds(asked: DataFrame, rows: DataFrame, k: int, sample: int) -> DataFrame:
    """``asked`` with ``least``, the ``k``-th best score among a sample of the candidates: no member of the result scores less. The sample has at most
    ``sample`` rows, picked by the hash of the id, and is broadcast; lengths and queries with too few others in it get no threshold."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in picked}:
        of_dim = [r for r in picked if r["dim"] == dim]
        by_dim[dim] = np.array([r["vec_id"] for r in of_dim]), np.array([r["v"] for r in of_dim], np.int64).reshape(len(of_dim), dim)
    shared = asked.sparkSession.sparkContext.broadcast(by_dim)

    @F.pandas_udf("double")
    def least(ids: pd.Series, dims: pd.Series, vectors: pd.Series) -> pd.Series:
        out = np.full(len(ids), -np.inf)
        for dim, (named, known) in shared.value.items():
            own = np.flatnonzero((dims == dim).to_numpy())
            for at in range(0, len(own), 256):
                mine = own[at: at + 256]
                scores = (np.array([vectors.iloc[i] for i in mine], np.int64).reshape(len(mine), dim) @ known.T).astype(float)
                scores[ids.to_numpy()[mine][:, None] == named[None, :]] = -np.inf
                if len(named) >= k:
                    out[mine] = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        return pd.Series(out)

    return asked.withColumn("least", least("vec_id", "dim", "v"))


def exact_top(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD, per_task: int = QUERIES, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` candidates with the largest inner product for each query, ties to the smaller id.

    Both tables have vec_id and x, an array of longs. Rows with a null id or x take no part; a query meets vectors of its own length only and
    never a row with its own id. Queries repeated under one id count once; repeated candidates are all returned. With fewer than ``k`` candidates all
    are returned; empty tables give no rows; other columns are not read.
    """
    def clean(df):
        return df.where("vec_id is not null and x is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("x").alias("v"), F.size("x").alias("dim"))

    rows, asked = clean(vectors), clean(queries).dropDuplicates(["vec_id"])
    asked = _first_thresholds(asked, rows, k, sample)
    shards = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("shards"))
    loads = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_task)).cast("int").alias("splits"))
    plan = F.broadcast(shards.join(loads, "dim"))  # a row for each vector length
    one = rows.join(plan, "dim").select(
        "dim", F.pmod(F.xxhash64("vec_id"), "shards").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), F.lit(None).cast("double").alias("least"), "vec_id", "v")
    two = asked.join(plan, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("vec_id"), "splits").cast("int").alias("split"), "least", "vec_id", "v")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["least"].notna().to_numpy()
        ids = pdf["vec_id"].to_numpy(np.int64)
        values = np.array(pdf["v"].to_list(), np.int64).reshape(len(pdf), -1)
        order = np.argsort(ids[~asks], kind="stable")
        have, named = values[~asks][order], ids[~asks][order]
        index, found = Index(have), []
        for query_id, query, least in zip(ids[asks].tolist(), values[asks], pdf["least"].to_numpy()[asks].tolist(), strict=True):
            at, scores = top(index, named, query_id, query, k, least)
            found.append((np.full(len(at), query_id), named[at], scores))
        columns = [np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    keys = ["dim", "shard", "split"]
    best = spread(one.unionByName(two), *keys).groupBy(*keys).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
