"""What is shuffled: ids and numbers of spans, not their texts or vectors; results against plain walks."""

import random
import re

from pyspark.sql import functions as F

from evidence_spark.functions.similarity import anchor_of
from evidence_spark.operators import alignment as A
from evidence_spark.operators import intervals as I
from evidence_spark.operators import vectors as V
from evidence_spark.session import cut


def exchanged(df):
    """The columns that each exchange of a plan is given."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [set(re.findall(r"(\w+)#", m)) for m in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def dealt(df):
    """The columns by which each exchange of a plan deals rows."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [set(re.findall(r"(\w+)#", m)) for m in re.findall(r"Arguments: hashpartitioning\((.*)\)", text)]


def near(spark, n=14):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "12", "not", "model"]
    units = [(1, i, 4.0 * i, 4.0 * i + 3, " ".join(rng.choices(words, k=6))) for i in range(n)]
    structs = [(1, i, 20.0 * i, 20.0 * i + 9, " ".join(rng.choices(words, k=12)), "a", "c") for i in range(3)]
    return (spark.createDataFrame(structs, "media_id long, seq long, start_s double, end_s double, text string, speaker string, chapter string"),
            spark.createDataFrame(units, "media_id long, unit_idx long, unit_start_s double, unit_end_s double, unit_text string"))


def prior(s, e, a, b):
    close = max(0.0, 1.0 - abs((s + e) / 2 - (a + b) / 2) / max(30.0, max(1.0, e - s) * 2))
    return round(0.55 * min(1.0, max(0.0, min(e, b) - max(s, a)) / max(1.0, e - s)) + 0.45 * close, 6)


def test_spans_are_the_best_and_only_their_texts_leave(spark):
    structs, units = near(spark)
    spans = I.candidate_spans(structs, units, pad=10.0, k=4)
    assert len([c for c in exchanged(spans) if "span_text" in c]) <= 1  # only the k best
    got = {(r["seq"], r["rank"]): (r["run_start"], r["unit_end"], r["lexical"]) for r in spans.collect()}
    us = [tuple(r) for r in units.orderBy("unit_idx").collect()]
    flat = lambda t: re.sub("[^a-z0-9]+", "", t.lower())
    for _, seq, s, e, text, *_ in structs.collect():
        found = []
        for i, u in enumerate(us):
            for n in range(1, min(6, len(us) - i) + 1):
                last = us[i + n - 1]
                if u[2] <= e + 10 and u[3] >= s - 10 and (n == 1 or last[2] <= e + 10):
                    score = anchor_of(flat(text), flat(" ".join(x[4] for x in us[i: i + n])))
                    found.append((-(0.65 * score + 0.35 * prior(s, e, u[2], last[3])), i, i + n, score))
        assert [got[seq, k + 1] for k in range(4)] == [x[1:] for x in sorted(found)[:4]]


def test_vectors_go_to_a_segment_once(spark):
    structs, units = near(spark)
    spans = cut(I.candidate_spans(structs.select("media_id", "seq", "start_s", "end_s", "text"), units))
    sv = V.hash_embed(structs.select("media_id", "seq", "text"), ["media_id", "seq"])
    uv = V.hash_embed(units.select("media_id", "unit_idx", F.col("unit_text").alias("text")), ["media_id", "unit_idx"])
    scored = A.score_candidates(spans, structs, sv, uv)
    assert not [c for c in dealt(scored) if "run_start" in c]
    tv, known = {r["seq"]: r["vector"] for r in sv.collect()}, {r["unit_idx"]: r["vector"] for r in uv.collect()}
    length = {r["unit_idx"]: len(r["unit_text"]) for r in units.collect()}
    for r in scored.collect():
        total = [sum(known[u][d] * length[u] for u in range(r["run_start"], r["unit_end"])) for d in range(128)]
        norm = sum(x * x for x in total) ** 0.5
        assert abs(r["semantic"] - max(0.0, min(1.0, sum(a * b for a, b in zip(tv[r["seq"]], total)) / norm))) < 2e-6


def test_words_are_hashed_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, "Rapid purchase, rapid"), (1, "fast"), (None, "fast"), (2, None)], "k long, text string")
    vectors = V.hash_embed(rows, ["k"])
    assert not [c for c in exchanged(vectors) if c & {"w", "text"}]
    got = {r["k"]: r["vector"] for r in vectors.collect()}
    plain = {r["k"]: r["vector"] for r in V.hash_embed(spark.createDataFrame([(1, "fast buy fast fast")], "k long, text string"), ["k"]).collect()}
    assert got[1] == plain[1] and not any(got[None]) and not any(got[2])


def test_blocks_meet_by_cells_with_each_vector_once(spark):
    rng = random.Random(9)
    vector = lambda: [float(rng.randint(-2, 3)) for _ in range(4)]
    a = [(1, i, 50.0 * i, 50.0 * i + rng.choice([20, 40]), vector()) for i in range(5)]
    b = [(1, j, 9.0 * j, 9.0 * j + rng.choice([5, 70]), vector()) for j in range(30)]
    got = A.block_scores(spark.createDataFrame(a, "media_id long, idx long, start_s double, end_s double, vector array<double>"),
                         spark.createDataFrame(b, "media_id long, idx long, unit_start_s double, unit_end_s double, vector array<double>"))
    assert not [c for c in exchanged(got) if c & {"iv", "jv"}]
    unit = lambda vs: (lambda v, n: [x / (n or 1.0) for x in v])([sum(c) for c in zip(*vs)], sum(sum(c) ** 2 for c in zip(*vs)) ** 0.5)
    want = {}
    for i in range(5):
        for s in range(1, min(3, 5 - i) + 1):
            for j in range(30):
                for t in range(1, min(6, 30 - j) + 1):
                    if s + t <= 7 and a[i][2] - 30 <= b[j][2] <= a[i + s - 1][3] + 30 and b[j + t - 1][3] <= a[i + s - 1][3] + 30:
                        want[i, s, j, t] = sum(x * y for x, y in zip(unit([r[4] for r in a[i: i + s]]), unit([r[4] for r in b[j: j + t]])))
    rows = got.collect()
    assert len(rows) == len(want) > 100 and all(abs(want[r["i"], r["s"], r["j"], r["t"]] - r["raw"]) < 1e-6 for r in rows)


def test_top_claims_are_made_once_for_all_views(spark, monkeypatch):
    from evidence_spark.operators import claims as C
    from evidence_spark.plans import extract as E
    from evidence_spark.plans.registry import QUERIES

    seen = spark.sparkContext.accumulator(0)
    docs = spark.createDataFrame([(k, f"s{k % 3}", f"s{k % 3}", "en", f"The model costs {k} dollars in the factory when it was sold with parts to the far markets.", k) for k in range(12)], "section_id long, source_id string, speaker string, family string, text string, published_at long")

    def counted(rows):
        for r in rows:
            seen.add(r.num_rows)
            yield r

    monkeypatch.setattr(E, "sections", lambda *_: docs.mapInArrow(counted, docs.schema))
    got = QUERIES["r1_top_claims"](spark, "").collect()
    assert seen.value == 12
    c = E.corpus_claims(docs)
    want = [(v, r.claim_id) for v in E._VIEWS for r in C.top_claims(c, v).collect()]
    assert want and sorted((r.view, r.claim_id) for r in got) == sorted(want)


def test_independence_deals_rows_once(spark):
    from evidence_spark.operators import rollups as G

    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", None), (1, None, "unknown"), (2, "unknown", ""), (2, None, None), (None, "a", "x"), (None, "a", "z")]
    got = G.independence(spark.createDataFrame(rows, "k long, s string, o string"), "k", ["s", "o"])
    text = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(dealt(got)) == 1 and "Expand" not in text
    assert sorted((str(r.k), r.independent_s_count, r.independent_o_count) for r in got.collect()) == [("1", 2, 2), ("2", 0, 0), ("None", 1, 2)]


def test_bad_lines_of_a_language_in_several_files(spark, tmp_path):
    import glob
    import os

    from evidence_spark.plans import sourced  # noqa: F401
    from evidence_spark.plans.registry import QUERIES
    from evidence_spark.session import checkpoint_folder

    rows = [(k, f"src{k % 4}", "en" if k % 10 else "de", f"text {k}") for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r.lang, r.line, r.kind) for r in QUERIES["s1_bad_lines"](spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for lang in ("de", "en"):
        for line, r in enumerate((r for r in rows if r[2] == lang), 1):
            if r[1] in ("src1", "src3"):
                want.append((lang, line, "cut" if r[1] == "src1" else "list"))
    assert got == sorted(want)
    folders = glob.glob(checkpoint_folder(spark).removeprefix("file:").rstrip("/") + "/**/lines-*", recursive=True)
    latest = max(folders, key=os.path.getmtime)
    assert len(glob.glob(f"{latest}/lang=en/*.txt")) > 1
