from difflib import SequenceMatcher

from pyspark.sql import functions as F

from evidence_spark.operators import claims as C
from evidence_spark.operators import evaluation as E
from evidence_spark.operators import gates as H
from evidence_spark.operators import rollups as G
from evidence_spark.operators import themes as K
from evidence_spark.operators import vectors as V


def test_claim_gate_is_shut_by_a_bad_merge_or_a_pending_row(spark):
    claims = spark.createDataFrame([(i, f"t{i}", float(i), float(i + 1)) for i in range(4)], "claim_id long, claim string, start_s double, end_s double")
    rows = [(0, "accept", None, "fully_supported"), (1, "merge_into", "canonical.0", "fully_supported"), (2, "merge_into", "3", "fully_supported"), (3, "", None, None)]
    d = spark.createDataFrame(rows, "claim_id long, decision string, merge_into string, entailment_label string").withColumn("canonical_claim", F.lit(None).cast("string"))
    issues = {(r.claim_id, r.issue) for r in H.claim_gate_violations(claims, d).collect()}
    assert issues == {(2, "merge_target_not_accepted"), (3, "invalid_decision")}
    accepted, rejected, members = H.apply_claim_gate(claims, d)
    a = accepted.collect()
    assert [(r.canonical_claim_id, r.start_s, r.end_s, r.n_parents) for r in a] == [("canonical.0", 0.0, 2.0, 2)]
    assert {(r.target_id, r.claim_id) for r in members.collect()} == {("0", 0), ("0", 1)}


def test_edges_turn_and_fall_with_their_claims(spark):
    edges = spark.createDataFrame([(1, "a", "b", "limits"), (2, "a", "x", "limits"), (3, "a", "b", "limits")], "relation_id long, source_id string, target_id string, relation_type string")
    mapping = spark.createDataFrame([("a", "a.split_02", 1), ("a", "a.split_01", 0), ("b", "b", 0)], "old_id string, new_id string, pos int")
    d = spark.createDataFrame([(1, "accept", "extends", False), (2, "accept", "extends", True), (3, "reject", None, True)], "relation_id long, decision string, final_relation_type string, direction_correct boolean")
    got = {r.relation_id: (r.source_id, r.target_id, r.relation_type, r.review_status) for r in H.remap_edges(edges, mapping, d).collect()}
    assert got == {1: ("b", "a.split_01", "extends", "accepted"), 2: (None, None, "limits", "rejected_parent_claim"), 3: (None, None, "limits", "rejected")}


def test_local_risks_need_a_parent(spark):
    c = spark.createDataFrame([("t1", "Costs fall 40% and do not rise", "opinion"), ("t2", "Plain words", "opinion")], "theme_claim_id string, statement string, claim_type string")
    p = spark.createDataFrame([("t1", "p1", "They fell 40% in a year", ["acme"]), ("t1", "p2", "it does not rise", []), ("t2", "p3", "never 5", [])], "theme_claim_id string, claim_id string, claim string, entity_risks array<string>")
    got = {(r.theme_claim_id, r.risk_type, r.risk_token, r.external_verification_required) for r in H.local_risk_queue(c, p).collect()}
    assert got == {("t1", "numeric", "40%", True), ("t1", "negation", "not", True)}


def test_claim_scores_equal_the_loop(spark):
    gold = [(0, 0, "growth needs cheap energy", "energy", 0.0, 10.0, ["numeric"]), (0, 1, "models fail without data", "data", 100.0, 110.0, []), (0, 2, "unseen idea", "none", 500.0, 510.0, [])]
    claims = [(0, 0, "growth needs cheap energy now", ["energy"], 2.0, 9.0, ["5"]), (0, 1, "models fail without more data", ["data"], 130.0, 140.0, []), (0, 2, "cheap energy", ["energy"], 0.0, 5.0, [])]
    g = spark.createDataFrame(gold, "media_id long, left long, gold_text string, g_theme string, g_start double, g_end double, expected_risks array<string>").withColumn(
        "speaker_requirement", F.lit("any")).withColumn("expected_speaker", F.lit(None).cast("string")).withColumn("category", F.lit("c"))
    c = spark.createDataFrame(claims, "media_id long, right long, claim string, themes array<string>, start_s double, end_s double, numeric_risks array<string>").withColumn(
        "entity_risks", F.array().cast("array<string>")).withColumn("negation_risks", F.array().cast("array<string>")).withColumn("speaker", F.lit("x")).withColumn("speaker_status", F.lit("unknown"))
    squash = lambda t: "".join(x for x in t.lower() if x.isalnum())

    def text(a, b):
        a, b = squash(a), squash(b)
        r = SequenceMatcher(None, a, b, autojunk=False).ratio()
        if a in b or b in a:
            return max(r, 0.92)
        ga, gb = {a[i:i + 5] for i in range(len(a) - 4)}, {b[i:i + 5] for i in range(len(b) - 4)}
        return max(r, len(ga & gb) / min(len(ga), len(gb)))

    def score(x, y):
        over = max(0, min(x[5], y[5]) - max(x[4], y[4]))
        time = min(1, over / max(1, max(x[5], y[5]) - min(x[4], y[4]))) if over > 0 else max(0, 1 - min(abs(y[4] - x[5]), abs(x[4] - y[5])) / 30)
        risk = (1.0 if y[6] else 0.0) if x[6] else 0.5
        return 0.35 * (x[3] in y[3]) + 0.25 * time + 0.25 * text(x[2], y[2]) + 0.15 * risk

    rows, metrics = E.evaluate_claims(g, c)
    got = {r.left: (r.right, r.score) for r in rows.collect()}
    used = set()
    for x in gold:
        best = max(((score(x, y), -y[1]) for y in claims if y[1] not in used), default=(0, 0))
        if best[0] >= 0.55:
            used.add(-best[1])
            assert got[x[1]] == (-best[1], round(best[0], 6))
        else:
            assert got[x[1]][0] is None
    total = metrics.where("category is null").first()
    assert (total.gold_count, total.matched_count, total.n_claims) == (3, 2, 3)
    assert abs(total.claim_recall - 0.666667) < 1e-6


def test_reviews_fold_by_precedence(spark):
    items = spark.createDataFrame([(1, "i1", "speaker_switch", 0, 0, 2), (1, "i1", "speaker_switch", 1, 1, 2), (1, "i2", "ordinary", 2, 0, 1)], "media_id long, item_id string, category string, seq long, pos int, n_segments int")
    rev = spark.createDataFrame([(1, 0, "correct", None, None, 0, 10, None), (1, 1, "boundary_adjustment", 12, 20, 0, 0, None), (1, 2, "wrong_content", None, None, 0, 5, None)],
                                "media_id long, seq long, verdict string, corrected_start long, corrected_end long, current_start long, current_end long, transition_owner string")
    labels, ranges = E.labels_from_reviews(items, rev)
    assert {r.item_id: r.status for r in labels.collect()} == {"i1": "correct_alignment", "i2": "should_fallback"}
    assert {(r.seq, r.role, r.char_start, r.char_end) for r in ranges.collect()} == {(0, "left_speaker_end", 0, 10), (1, "right_speaker_start", 12, 20)}


def test_alignment_scores(spark):
    units = spark.createDataFrame([(1, i, i * 10, i * 10 + 10) for i in range(6)], "media_id long, unit_idx long, u_start long, u_end long")
    labels = spark.createDataFrame([(1, "a", "correct_alignment", "speaker_switch"), (1, "b", "should_fallback", "ordinary")], "media_id long, item_id string, status string, category string")
    ranges = spark.createDataFrame([(1, "a", "left_speaker_end", "left", 0, 20), (1, "a", "right_speaker_start", "right", 20, 40)], "media_id long, item_id string, role string, side string, char_start long, char_end long")
    pred = spark.createDataFrame([(1, "a", "left", 0, False), (1, "a", "left", 1, False), (1, "a", "right", 2, False), (1, "b", "left", None, True)], "media_id long, item_id string, side string, unit_idx long, fallback boolean")
    r = E.evaluate_alignment(labels, ranges, pred, units).first()
    assert (r.character_precision, r.character_recall, r.unit_recall, r.fallback_f1) == (1.0, 0.75, 0.75, 1.0)
    assert (r.exact_boundary_accuracy, r.tolerance_boundary_accuracy, r.wrong_speaker_count, r.omission_rate) == (0.0, 1.0, 1, 0.25)


def test_golden_freeze_rules(spark):
    base = dict(selection_source=E.DRAFT, review_action="approve", system_output_hidden=True, expected_risks=["numeric"], supporting_time_range=[0.0, 1.0], epistemic_status="", **{c: "x" for c in E.REQUIRED})
    rows = [dict(base, gold_id=1), dict(base, gold_id=2, expected_risks=["未必"]), dict(base, gold_id=3, review_action="pending"), dict(base, gold_id=4, selection_source="new", expected_risks=[], supporting_time_range=[None, None], **{c: "" for c in E.REQUIRED})]
    schema = "gold_id long, selection_source string, review_action string, system_output_hidden boolean, expected_risks array<string>, supporting_time_range array<double>, epistemic_status string, " + ", ".join(f"{c} string" for c in E.REQUIRED)
    df = spark.createDataFrame([tuple(r[f.split()[0]] for f in schema.split(", ")) for r in rows], schema)
    _kept, bad = E.freeze_golden(df, 1, 5)
    assert {(r.gold_id, r.issue) for r in bad.collect()} == {("2", "invalid_risk"), ("3", "not_reviewed")}
    moved = E.migrate_golden(df)
    status = {r.gold_id: (r.review_action, r.epistemic_status) for r in moved.collect()}
    assert status[2][1] == "uncertain" and status[3][0] == "approve" and status[4][0] == "optional"
    kept, bad = E.freeze_golden(moved, 1, 5)
    assert bad.count() == 0 and kept.count() == 3
    assert E.freeze_golden(moved, 20, 25)[1].first().issue == "kept_3"


def test_candidate_sets(spark):
    schema = "media_id long, pos long, topic string, supporting_text string, start_s double, end_s double, signals array<string>"
    a = spark.createDataFrame([(1, 0, "x", "some long supporting words about energy", 0.0, 10.0, ["unless"]), (1, 1, "y", "other talk entirely different", 50.0, 60.0, [])], schema)
    b = spark.createDataFrame([(1, 0, "x", "some long supporting words about power", 5.0, 15.0, ["unless"]), (1, 1, "x", "zzz qqq", 900.0, 910.0, ["only if"])], schema)
    r = E.compare_candidates(a, b).first()
    assert (r.strict_matches, r.strict_recall, r.topic_time_recall, r.topic_time_precision, r.non_consensus_recall) == (1, 0.5, 0.5, 0.5, 0.5)
    assert [x.pos for x in E.omissions(a, b).collect()] == [1]


def test_nearest_rank_by_narrowing(spark):
    values = [float((i * 37) % 101) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for p in (0.02, 0.2, 0.5, 0.98):
        assert G.nearest_rank(df, "v", p, small=10) == sorted(values)[round((len(values) - 1) * p)]


def test_embedding_cache_and_model_hook(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "id long, text string")
    calls = V.Scorer("toy", "v2", 2, lambda texts: [[float(len(t)), 1.0] for t in texts])
    rows, new = V.embed(df, calls, batch_size=1)
    assert {r.id: list(r.vector) for r in rows.collect()} == {1: [3.0, 1.0], 2: [3.0, 1.0], 3: [1.0, 1.0]} and new.count() == 2
    assert V.embed(df, calls, cache=new)[1].count() == 0
    sim = V.score_pairs(spark.createDataFrame([("same words", "same words"), ("one", "two")], "left_text string, right_text string"), V.Scorer.hashed(degraded=True))
    assert {r.left_text: r.similarity for r in sim.collect()}["same words"] == 1.0


def test_judgments_and_queue_reasons(spark):
    c = spark.createDataFrame([("a", "opinion", 0.5, 0.5, 0.5, False)], "claim_id string, claim_type string, importance_score double, novelty_score double, non_consensus_score double, needs_verification boolean")
    v = spark.createDataFrame([("a", "fact", 1.4, -1.0, 0.3, True), ("zz", "nonsense", 0.1, 0.1, 0.1, False)], c.schema)
    r = K.apply_judgments(c, v).first()
    assert (r.claim_type, r.importance_score, r.novelty_score, r.needs_verification) == ("fact", 1.0, 0.0, True)
    assert {(x.claim_id, x.issue) for x in K.judgment_violations(c, v).collect()} == {("zz", "unknown_claim"), ("zz", "invalid_claim_type")}
    q = spark.createDataFrame([(1, ["9"], [], [], "unknown", False, 0.6, 0.7)], "claim_id long, numeric_risks array<string>, negation_risks array<string>, entity_risks array<string>, speaker_status string, exact_quote_allowed boolean, confidence double, importance_score double")
    r = C.verification_queue(q).first()
    assert list(r.reasons) == ["numeric_risk", "speaker_not_exact", "exact_quote_not_allowed", "low_source_confidence"] and r.priority == "high"
