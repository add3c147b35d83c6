"""Whitening against the eigenvectors of the whole covariance."""

import numpy as np
import pytest

from evidence_spark.llm import whitening as W
from evidence_spark.llm.queries import QUERIES


def brute(x, components=16):
    """n, exact sums, variances, components and total of the distinct rows of a list of lists of ints."""
    rows = sorted({tuple(r) for r in x})
    n, sums = len(rows), [sum(c) for c in zip(*rows, strict=True)]
    middle = [s // n for s in sums]
    a = np.array([[v - m for v, m in zip(r, middle, strict=True)] for r in rows], float)
    a -= a.mean(axis=0)
    values, vectors = np.linalg.eigh(a.T @ a / n)
    return n, sums, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum(), middle


def check(got, given, components=16):
    """``got``: rows of the query; ``given``: (vec_id, x)."""
    n, sums, values, vectors, total, middle = brute([x for _, x in given], components)
    k = int((values > 1e-9 * values[0]).sum())
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    sign = None
    for vec_id, x in given:
        rows = sorted(by_id.pop(vec_id), key=lambda r: r.component)
        rows = rows[:k] if len(rows) != k else rows
        assert [r.component for r in rows] == list(range(1, k + 1))
        assert {r.n for r in rows} == {n} and {r.deviation for r in rows} == {sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))}
        centred = np.array([v - m for v, m in zip(x, middle, strict=True)], float) - np.array([s - n * m for s, m in zip(sums, middle, strict=True)]) / n
        want = centred @ vectors[:, :k] / np.sqrt(values[:k])
        have = np.array([r.whitened for r in rows])
        if sign is None:
            sign = np.where(want * have < 0, -1, 1)
        assert np.allclose(have, want * sign, atol=1e-8, rtol=1e-8)
        assert np.allclose([r.explained for r in rows], values[:k] / total, rtol=1e-9)
        assert all(r.identity_error < 1e-9 for r in rows)
    assert not by_id


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    given = [(r.vec_id, [int(np.floor(64 * np.float64(c))) + 1_000_000 for c in r.embedding]) for r in table]
    got = QUERIES["op11_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), given)


def test_many_dimensions_end_early(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(400, 5)) * [90, 70, 50, 30, 20] @ rng.normal(size=(5, 90)) + rng.normal(size=(400, 90))).round().astype(int) + 10**9
    x[7] = x[3]
    given = [(i, r) for i, r in enumerate(x.tolist())]
    calls = []
    kept = W._added
    try:
        W._added = lambda *a: (calls.append(1), kept(*a))[1]
        df = spark.createDataFrame(given, "vec_id long, x array<long>")
        models = W.fit(df, 4)
    finally:
        W._added = kept
    assert len(calls) < 60
    check(W.whitened(df, models).collect(), given, 4)


def test_repeated_and_zero_variances():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    x = np.linalg.qr(rng.normal(size=(50, 12)))[0] * [5, 5, 5, 3, 3, 2, 2, 2, 1, 0, 0, 0] @ q

    def products(v, g):
        p, u = x @ v, x @ g
        return (x * x).sum(), p @ p, u.T @ p, x.T @ p

    values, vectors = W.bidiagonalise(products, 12, 12)
    assert np.allclose(values, [5, 5, 5, 3, 3, 2, 2, 2, 1, 0, 0, 0], atol=1e-10)
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-12) and np.allclose(np.linalg.norm(x @ vectors, axis=0), values, atol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None)]])
def test_too_little_to_whiten(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, n int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_whitening"](spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=3).astype(np.float32)]) for i in range(40)]
    rows += [(50, rows[0][1]), (50, rows[0][1]), (None, rows[1][1])]  # repeated vectors, rows and a null id
    odd = [(60, None), (61, [float("nan"), 1.0, 2.0]), (62, [None, 1.0, 2.0]), (63, [float("inf"), 1.0, 1.0]), (64, [])]
    spark.createDataFrame([(*r, 1, 0.5) for r in rows + odd], "vec_id long, embedding array<float>, component int, whitened double").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_whitening"](spark, str(tmp_path)).collect()
    assert sum(r.vec_id == 50 for r in got) == 6 and sum(r.vec_id is None for r in got) == 3 and len(got) == 3 * 43
    given = [(i, [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows[:40]]
    check([r for r in got if r.vec_id is not None and r.vec_id < 40], given)


def test_huge_entries_and_two_lengths(spark):
    df = spark.createDataFrame([(1, [3e30, 1.0]), (2, [-3e30, 2.0]), (3, [0.0, 5.0]), (4, [1.0, 2.0, 3.0]), (5, [2.0, 2.0, 3.0])], "vec_id long, e array<double>")
    from pyspark.sql import functions as F

    rows = df.select("vec_id", W.whole_numbers(F.col("e"), 64, 1_000_000).alias("x"))
    got = W.whitened(rows, W.fit(rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4, 5}
    assert {r.deviation for r in got if r.vec_id == 1} == {None} and {r.deviation for r in got if r.vec_id == 4} == {64 * 64}
