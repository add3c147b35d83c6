"""Similarity joins, matching and ranks over whole rectangles, against brute force."""

import math

import numpy as np
import pytest

from evidence_spark.operators import matching as M
from evidence_spark.operators import rollups as G
from evidence_spark.operators import tiles as L
from evidence_spark.operators import vectors as V

SCHEMA = "idx long, vector array<double>, extra string"


def unit_rows(seed, n, dim=6, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + 3 * rng.normal(size=(4, dim))[rng.integers(0, 4, n)]
    x[:copies] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[-1] = 0.0
    ids = rng.permutation(n * 1000)[:n]
    return {int(i): v for i, v in zip(ids, x)}


def frame(spark, rows):
    return spark.createDataFrame([*((i, v.tolist(), "x") for i, v in rows.items()), (None, None, "no vector")], SCHEMA)


def score(a, b):
    return float(np.round(np.clip(a @ b, -1.0, 1.0), 6))


@pytest.mark.parametrize("least", [0.95, 0.3, -0.2])
def test_pairs_of_one_table(spark, least):
    rows = unit_rows(1, 90, copies=30)
    got = {(r.left, r.right): r.similarity for r in L.similar_pairs(frame(spark, rows), least, bytes_=400).collect()}
    assert got == {(a, b): score(rows[a], rows[b]) for a in rows for b in rows if a < b and score(rows[a], rows[b]) >= least}


def test_pairs_of_two_tables_and_pruned_tiles(spark):
    a, b = unit_rows(2, 60), unit_rows(3, 70)
    df, dg = frame(spark, a), frame(spark, b)
    got = {(r.left, r.right): r.score for r in L.similar_between(df, dg, 0.8, bytes_=400).collect()}
    assert got == {(i, j): score(a[i], b[j]) for i in a for j in b if score(a[i], b[j]) >= 0.8}
    t = L.tiled(df, bytes_=400)
    assert t.count > 4 and L.tile_pairs(t, t, 0.97).count() < t.count ** 2 == L.tile_pairs(t, t, -1.0).count()
    assert L.similar_between(df.limit(0), dg, 0.1).count() == 0 and L.similar_between(df, dg.limit(0), 0.1).count() == 0 and L.similar_pairs(df.limit(0), 0.1).count() == 0


def brute_match(a, b, least):
    taken, out = set(), {}
    for i in sorted(a):
        free = [(score(a[i], b[j]), -j) for j in b if j not in taken]
        s, j = max(free, default=(0.0, None))
        if j is not None and s >= least:
            taken.add(-j)
            out[i] = (-j, s)
        else:
            out[i] = (None, s)
    return out


@pytest.mark.parametrize("page, least, n, m", [(1, 0.5, 20, 25), (3, -1.0, 30, 12), (8, 0.9, 25, 25), (4, 2.0, 5, 5)])
def test_matching_by_pages_equals_the_walk(spark, page, least, n, m):
    a, b = unit_rows(4, n, copies=n // 2), unit_rows(5, m, copies=m // 3)
    got = {r.left: (r.right, r.score) for r in M.match_vectors(frame(spark, a).where("idx is not null"), frame(spark, b), least, page, bytes_=600).collect()}
    assert got == brute_match(a, b, least)


def test_matching_without_rights(spark):
    a = frame(spark, unit_rows(4, 3)).where("idx is not null")
    assert {(r.right, r.score) for r in M.match_vectors(a, a.limit(0), 0.1).collect()} == {(None, 0.0)}
    assert M.match_vectors(a.limit(0), a, 0.1).count() == 0


def test_margins_of_the_rectangle(spark):
    a, b = (dict(enumerate(unit_rows(s, n).values())) for s, n in ((6, 23), (7, 31)))
    rows = lambda x: spark.createDataFrame([(m, i, v.tolist()) for m in (1, 2) for i, v in x.items()], "media_id long, idx long, vector array<double>")
    pairs = spark.createDataFrame([(m, i, j, score(a[i], b[j])) for m in (1, 2) for i in a for j in b], "media_id long, i long, j long, raw double")
    want = {(r.media_id, r.i, r.j): (r.margin, r.score) for r in V.margin_scores(pairs).collect() if round(r.score, 6) >= 0.6}
    got = {(r.media_id, r.i, r.j): (r.margin, r.score) for r in V.rectangle_margins(rows(a), rows(b), 0.6).collect()}
    assert got.keys() == want.keys() and 2 * len(a) * len(b) > len(got) > 50
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


@pytest.mark.parametrize("values", [
    [-3.5, -0.0, 0.0, 1e-320, 1e308, -1e308, 2.0, 2.0000000000000004, 2.0, -3.5], [1.0] * 7, [float("inf"), float("-inf"), 5.0, 5e-324], [0.1 * k for k in range(-40, 41)], [2.0], [1.0, 2.0, float("nan")],
    [1.7976931348623157e308, -1.7976931348623157e308, 1.7e308],
])
def test_ranks_of_all_doubles(spark, values):
    df = spark.createDataFrame([*((v,) for v in values), (None,)], "v double").repartition(3)
    fractions = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    order = sorted((v for v in values if not math.isnan(v))) + [v for v in values if math.isnan(v)]
    for cells in (65_536, 64):
        got = {r.fraction: r.value for r in G.nearest_ranks(df, "v", fractions, cells).collect()}
        assert [repr(got[f] + 0.0) for f in fractions] == [repr(order[round((len(order) - 1) * f)] + 0.0) for f in fractions]
    assert G.nearest_ranks(df.limit(0), "v", fractions).count() == 0 and G.nearest_rank(df.limit(0), "v", 0.5) is None
