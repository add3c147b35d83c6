import random

from pyspark.sql import functions as F

from evidence_spark.functions.similarity import ratio_of
from evidence_spark.operators import alignment as A
from evidence_spark.operators import records as P
from evidence_spark.operators import vectors as V


def best_path(n, m, blocks, gap, method="product"):
    """Full table of best costs; returns (cost, blocks on the path)."""
    cost, back = {(0, 0): 0.0}, {}
    for i in range(n + 1):
        for j in range(m + 1):
            if (i, j) not in cost:
                continue
            moves = [(0, 1, gap), (1, 0, gap)]
            for (bi, s, bj, t), score in blocks.items():
                if bi == i and bj == j:
                    moves.append((s, t, (1 - score) * s * t if method == "product" else -(score ** max(1, s + t - 1)) * (s + t)))
            for s, t, c in moves:
                to = (i + s, j + t)
                if to[0] <= n and to[1] <= m and cost[(i, j)] + c < cost.get(to, 1e18) - 1e-12:
                    cost[to] = cost[(i, j)] + c
                    back[to] = (i, j)
    at, used = (n, m), set()
    while at != (0, 0):
        p = back[at]
        if at[0] > p[0] and at[1] > p[1]:
            used.add((p[0], at[0] - p[0], p[1], at[1] - p[1]))
        at = p
    return cost[(n, m)], used


def lattice(rng, n, m):
    out = {}
    for i in range(n):
        mid = round(i * m / n)
        for j in range(max(0, mid - 5), min(m, mid + 6)):
            for s in (1, 2, 3):
                for t in range(1, 7 - s + 1):
                    if i + s <= n and j + t <= m and rng.random() < 0.5:
                        out[(i, s, j, t)] = round(rng.random(), 6)
    return out


def test_path_equals_the_full_table(spark):
    rng = random.Random(1)
    cases = [(12, 20), (25, 30), (3, 2), (18, 40)]
    rows, sizes, lat = [], [], {}
    for k, (n, m) in enumerate(cases):
        lat[k] = lattice(rng, n, m)
        rows += [(k, i, s, j, t, v) for (i, s, j, t), v in lat[k].items()]
        sizes.append((k, n, m))
    blocks = spark.createDataFrame(rows, "media_id long, i long, s long, j long, t long, score double")
    size = spark.createDataFrame(sizes, "media_id long, n long, m long")
    for method, gap in (("product", 0.3), ("split", -0.4)):
        for fold in (4, 4096):
            got = {}
            for r in A.align_monotonic(blocks, size, gap, method, fold_block=fold).collect():
                if r.t:
                    got.setdefault(r.media_id, set()).add((r.i, r.s, r.j, r.t))
            for k, (n, m) in enumerate(cases):
                _cost, want = best_path(n, m, lat[k], gap, method)
                assert got.get(k, set()) == want


def test_overlap_fusion_equals_the_loop(spark):
    structs = [(1, 0, "ann", "Part", 0.0, 10.0, "one two three four"), (1, 1, "bob", "Part", 10.0, 20.0, "five six 7"), (1, 2, "bob", "Part", 95.0, 99.0, "far away"), (1, 3, "ann", "Part", 22.0, 24.0, "near miss")]
    texts = [(1, 0, 0.0, 6.0, "one two three"), (1, 1, 6.0, 12.0, "four five"), (1, 2, 12.0, 20.0, "six 8")]
    s = spark.createDataFrame(structs, "media_id long, seq long, speaker string, chapter string, start_s double, end_s double, text string")
    t = spark.createDataFrame(texts, "media_id long, r_seq long, r_start_s double, r_end_s double, r_text string")
    got = {r.seq: r for r in P.fuse_overlap(s, t).collect()}
    squash = lambda x: "".join(c for c in x.lower() if c.isalnum())
    for _m, seq, _w, _c, a, b, text in structs:
        hit = [x for x in texts if x[3] > a and x[2] < b] or [x for x in texts if x[3] >= a - 3 and x[2] <= b + 3]
        joined = " ".join(x[4] for x in hit)
        cover = sum(max(0.0, min(b, x[3]) - max(a, x[2])) for x in hit) / (b - a)
        conf = round(0.55 * ratio_of(squash(text), squash(joined)) + 0.35 * cover + 0.10 * 0.5, 4) if hit else 0.0
        r = got[seq]
        assert abs(r.alignment_confidence - conf) < 1e-9 and list(r.matched_ids) == [x[1] for x in hit]
        assert r.text == (joined if conf >= 0.65 and joined else text)
    assert "no_time_match" in got[2].review_reasons and got[2].text_source == "structure_review_fallback"
    assert "numeric_conflict" in got[1].review_reasons


def test_tiles_equal_the_whole_rectangle(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(7, 5)), rng.normal(size=(9, 5))
    a, b = a / np.linalg.norm(a, axis=1)[:, None], b / np.linalg.norm(b, axis=1)[:, None]
    old, V.TILE = V.TILE, 3
    try:
        frame = lambda x: spark.createDataFrame([(1, i, [float(v) for v in r]) for i, r in enumerate(x)], "media_id long, idx long, vector array<double>")
        m = np.round(np.clip(a @ b.T, -1, 1), 6)
        base = V.rectangle_baselines(frame(a), frame(b), 4)
        for r in base.collect():
            line = m[r.idx] if r.side == "a" else m[:, r.idx]
            assert abs(r.baseline - np.sort(line)[::-1][:4].mean()) < 1e-9
        costs = np.sort((1 - m).ravel())
        got = V.rectangle_rank(frame(a), frame(b), 0.2, "raw_cost", name="gap").first().gap
        assert abs(got - costs[round((len(costs) - 1) * 0.2)]) < 1e-6
        rows, cols = np.array([np.sort(x)[::-1][:4].mean() for x in m]), np.array([np.sort(x)[::-1][:4].mean() for x in m.T])
        margin = np.sort((m - (rows[:, None] + cols[None, :]) / 2).ravel())
        got = V.rectangle_rank(frame(a), frame(b), 0.98, "margin", baselines=base, name="hi").first().hi
        assert abs(got - margin[round((len(margin) - 1) * 0.98)]) < 1e-6
    finally:
        V.TILE = old


def test_no_unit_is_used_twice_and_order_holds(spark):
    rng = random.Random(9)
    lat = lattice(rng, 15, 25)
    blocks = spark.createDataFrame([(1, *k, v) for k, v in lat.items()], "media_id long, i long, s long, j long, t long, score double")
    path = A.align_monotonic(blocks, spark.createDataFrame([(1, 15, 25)], "media_id long, n long, m long"), 0.25).orderBy("i", "j").collect()
    ends = (0, 0)
    for r in path:
        assert r.i >= ends[0] and r.j >= ends[1]
        ends = (r.i + r.s, r.j + r.t)
    assert sum(r.s for r in path) == 15
