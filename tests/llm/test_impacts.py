"""Exact top-k search by impacts against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidence_spark.llm import impacts as I
from evidence_spark.llm.queries import QUERIES


def brute(rows, k=10, every=100, scale=1024):
    """(query, rank, candidate, score) of rows (id, vector)."""
    ok = [(i, [int(np.floor(scale * np.float64(c))) for c in v]) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for i, q in ok:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op13_exact_top"](spark, sf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("shard, sample", [(8192, 2048), (150, 20), (70, 3)])
def test_shards_ties_and_odd_rows(spark, tmp_path, shard, sample):
    rng = np.random.default_rng(7)
    rows = [(i, np.round(rng.normal(size=6), 1).tolist()) for i in range(500)]
    rows += [(1000 + i, [0.5, 0.5, 0.0, 0.0, 0.0, -1.0]) for i in range(250)]  # a third of the rows are one vector
    rows += [(2000, None), (2100, [float("nan")] * 6), (2200, [float("inf")] + [1.0] * 5), (2300, [None] + [1.0] * 5), (None, [1.0] * 6), (2400, [0.0] * 6), (2500, [1.0, -2.0]), (2501, [0.5, 0.5]), (2600, []), (2601, [])]
    spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<float>, rank int, score double").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    x = df.select("vec_id", I.whole_numbers(F.col("embedding"), 1024).alias("x"))
    got = I.exact_top(x, x.where("vec_id % 100 = 0"), 10, shard, 5, sample)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    if shard == 8192:
        assert sorted(tuple(r) for r in QUERIES["op13_exact_top"](spark, str(tmp_path)).collect()) == brute(rows)


def test_segments_are_left_out_by_proof():
    rng = np.random.default_rng(8)
    vectors = np.floor(1024 * rng.normal(size=(8000, 32)) * 0.8 ** np.arange(32)).astype(np.int64)
    index = I.Index(vectors)
    queries = vectors[::400]
    for k, q in enumerate(queries):
        exact = vectors @ q
        exact[400 * k] = -(1 << 60)
        want = np.lexsort((np.arange(len(vectors)), -exact))[:10]
        rows, scores = I.top(index, np.arange(len(vectors)), 400 * k, q, 10, -np.inf)
        assert rows.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()
    assert index.visited < 0.6 * vectors.size * len(queries)


def test_bounds_hold_for_every_stride():
    rng = np.random.default_rng(9)
    vectors = rng.integers(-600, 600, (700, 12))
    vectors[::3] = vectors[0]
    for levels, stride in ((1, 1), (3, 7), (40, 16), (5000, 1000)):
        index = I.Index(vectors, levels)
        for q in rng.integers(-600, 600, (20, 12)):
            exact = vectors @ q
            kept = index.possible(q, 5, -np.inf, np.array([4]), stride, 0)
            best = np.sort(np.delete(exact, 4))[-5]
            assert set(np.flatnonzero(exact >= best)) - {4} <= set(kept.tolist())


def test_empty_tables_and_large_entries(spark):
    df = spark.createDataFrame([(0, [3e30, 1.0]), (100, [-3e30, 2.0]), (3, [0.25, 5.0])], "vec_id long, e array<double>").select("vec_id", I.whole_numbers(F.col("e"), 1024).alias("x"))
    assert I.exact_top(df.limit(0), df).count() == 0 and I.exact_top(df, df.limit(0)).count() == 0
    got = {(r.query_id, r.vec_id): r.score for r in I.exact_top(df.union(df), df).collect()}
    assert got[0, 100] == -(1 << 52) + 1024 * 2048 and got[3, 0] == (256 << 26) + 5120 * 1024
