"""What large rectangles, passages and pages send between tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidence_spark.operators import tiles as L
from evidence_spark.operators import vectors as V
from evidence_spark.plans import registry
from evidence_spark.plans import similar as S
from evidence_spark.sources import html as H


def unit(seed, n, dim=5):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_a_tile_is_sent_once_to_a_block(spark):
    tiles = spark.range(40).select(F.col("id").alias("tile"), F.lit("x").alias("vectors"))
    pairs = spark.range(40).select(F.col("id").alias("a")).crossJoin(spark.range(40).select(F.col("id").alias("b"))).withColumn("block", F.floor(F.col("a") / 5) * 41 + F.floor(F.col("b") / 5))
    rows = L.blocks(pairs, tiles, tiles).collect()
    assert len(rows) == 2 * 40 * 8 and sum(len(r.meets) for r in rows if r.is_right) == 1600
    x = unit(1, 60)
    got = L.similar_pairs(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "idx long, vector array<double>"), 0.2, bytes_=80).collect()
    m = np.round(np.clip(x @ x.T, -1, 1), 6)
    assert {(r.left, r.right) for r in got} == {(i, j) for i in range(60) for j in range(i + 1, 60) if m[i, j] >= 0.2}


def test_long_recordings_send_tiles_to_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 4)
    a, b = unit(2, 100), unit(3, 90)
    frame = lambda x: spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)], "media_id long, idx long, vector array<double>")
    rows = V._tile_pairs(frame(a), frame(b), ["media_id"])
    assert rows.count() <= (25 + 23) * V.SIDES < 25 * 23  # one row a pair before
    m = np.round(np.clip(a @ b.T, -1, 1), 6)
    top = {("a", i): v.mean() for i, v in enumerate(-np.sort(-m, axis=1)[:, :4])} | {("b", j): v.mean() for j, v in enumerate(-np.sort(-m.T, axis=1)[:, :4])}
    got = {(r.side, r.idx): r.baseline for r in V.rectangle_baselines(frame(a), frame(b)).collect()}
    assert got.keys() == top.keys() and all(got[k] == pytest.approx(top[k], abs=1e-9) for k in top)
    cost = np.sort(np.round(1 - m, 9).ravel())
    assert V.rectangle_rank(frame(a), frame(b), 0.2, "raw_cost").first().value == cost[round((len(cost) - 1) * 0.2)]


def test_only_grams_of_passages_are_kept(spark, tmp_path, monkeypatch):
    long = " ".join(f"word{n * 7919 % 1000}" for n in range(400))
    spark.createDataFrame([(1, "the planted passage"), (2, "short")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(7, long + " the planted passage " + long), (8, long), (9, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sizes = []
    keep = S.cut
    monkeypatch.setattr(S, "cut", lambda df: sizes.append((out := keep(df)).count()) or out)
    rows = registry.QUERIES["t2_block_ratio"](spark, str(tmp_path)).collect()
    assert [(r.item_id, r.doc_id) for r in rows] == [(1, 7)] and max(sizes) < 40


def test_blocks_without_a_name_do_not_meet_in_one_task(spark, monkeypatch):
    pages = spark.createDataFrame([(p, "".join(f"<p>plain {n}</p>" for n in range(20)) + "<p>Ann: hello</p><p>more</p>") for p in range(3)], "source_id long, html string")
    aliases = spark.createDataFrame([("ann", "Ann B")], "alias string, speaker string")
    want = {(p, s, n) for p in range(3) for s, n in (("unknown", 20), ("Ann B", 0))}
    rows = lambda: {(r.source_id, r.speaker, r.text.count("plain")) for r in H.turns_from_html(pages, aliases).collect()}
    assert rows() == want
    # without a broadcast they are dealt, too
    tasks, keep = [], H.cut

    def seen(df):
        if "named" in df.columns and "heading" in df.columns:
            tasks.append(df.where("named is null").select(F.spark_partition_id()).distinct().count())
        return keep(df)

    monkeypatch.setattr(H, "small", lambda df: df)
    monkeypatch.setattr(H, "cut", seen)
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert rows() == want and tasks == [4]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
