"""Queries for themes, gates, evaluation and the batch form of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import text as X
from evidence_spark.operators import claims as C
from evidence_spark.operators import evaluation as E
from evidence_spark.operators import gates as H
from evidence_spark.operators import themes as K
from evidence_spark.operators import vectors as V
from evidence_spark.operators.scan import scan
from evidence_spark.plans import duck as D
from evidence_spark.plans.aligned import projected
from evidence_spark.plans.extract import CLAIMS_SQL, blocks, claims, decisions, records
from evidence_spark.plans.registry import query
from evidence_spark.plans.similar import _PROTO, proto_scores, prototypes
from evidence_spark.plans.tables import CUES_SQL, cues, joined, table
from evidence_spark.session import cut
from evidence_spark.streaming import feeds

# --- themes --------------------------------------------------------------------------------------

def clusters(spark, sf):
    """Themes of the corpus as clusters: one per (source, first theme) with its best claim."""
    c = claims(spark, sf).withColumn("frame", F.element_at("themes", 1)).withColumn("cluster_id", F.concat_ws("/", "source_id", F.element_at("themes", 1)))
    best = c.groupBy("cluster_id", "frame", F.col("source_id").alias("subtheme")).agg(F.max_by("claim", F.struct("importance_score", "claim_id")).alias("representative"))
    return best, c


@query("k1_theme_claims", f"""WITH {CLAIMS_SQL}, c AS (SELECT *, source_id || '/' || themes[1] AS cluster_id FROM claims), g AS (SELECT cluster_id, themes[1] AS frame, source_id AS subtheme, arg_max(claim, (importance_score, claim_id)) AS statement, count(*) AS n_members,
 count(DISTINCT family) AS n_families, min(published_at) AS first_seen_at, max(published_at) AS last_seen_at, bool_or(len(numeric_risks) > 0 OR len(negation_risks) > 0) AS need FROM c GROUP BY 1, 2, 3)
SELECT cluster_id, frame, CASE WHEN subtheme = 'src2' THEN 'judged' ELSE statement END AS statement, n_members, n_families, first_seen_at, last_seen_at, CASE WHEN need THEN 'needs_targeted_verification' ELSE 'official_text_only' END AS verification_status FROM g WHERE subtheme <> 'src1'""")
def _(spark, sf):
    best, c = clusters(spark, sf)
    verdicts = best.select("cluster_id", F.when(F.col("subtheme") == "src1", "unrelated").otherwise("fully_supported").alias("entailment_status"), F.when(F.col("subtheme") == "src2", "judged").alias("statement"))
    return K.theme_claims(best, c, verdicts).select("cluster_id", "frame", "statement", "n_members", "n_families", "first_seen_at", "last_seen_at", "verification_status")


def theme_vectors(spark, sf):
    p = prototypes(spark, sf)
    return p.select(F.col("label").cast("long").alias("idx"), F.concat(F.lit("theme"), F.col("label").cast("string")).alias("theme_claim_id"), F.concat(F.lit("f"), F.col("label").cast("string")).alias("frame"),
                    (F.col("label") % 3).cast("string").alias("subtheme"), "vector", (F.col("label") % 2 + 1).alias("n_families"))


def theme_edges(spark, sf):
    t = cut(theme_vectors(spark, sf))
    rules = t.where("idx < 4").select(F.col("frame").alias("frame_a"), F.concat(F.lit("f"), (F.col("idx") + 5).cast("string")).alias("frame_b"), F.lit("limits").alias("relation"))
    return t, K.theme_relations(t, rules, same=0.05, any_=0.2)


# rules name frames 0 to 3 with 5 to 8; other pairs are unrelated until judged
_EDGES = f"""WITH {_PROTO}, edges AS (SELECT 'theme' || a.label AS source_id, 'theme' || b.label AS target_id, round(greatest(0, list_dot_product(a.pv, b.pv)), 6) AS similarity FROM proto a JOIN proto b ON b.label = a.label + 5 AND a.label < 4)"""


@query("k2_theme_relations", f"{_EDGES} SELECT source_id, target_id, 'limits' AS relation_type, 0.78::DOUBLE AS confidence, similarity FROM edges")
def _(spark, sf):
    return theme_edges(spark, sf)[1]


@query("k3_syntheses", f"""{_EDGES}, links AS (SELECT source_id AS id, target_id AS other FROM edges UNION SELECT target_id, source_id FROM edges), t AS (SELECT 'theme' || label AS id, 'f' || label AS frame, (label % 2 + 1)::BIGINT AS fam, (SELECT count(*) FROM links WHERE links.id = 'theme' || label) AS c FROM proto),
spec AS (SELECT * FROM (VALUES ('low', 'f0'), ('low', 'f1'), ('low', 'f2'), ('mixed', 'f3'), ('mixed', 'f7'), ('thin', 'f9'), ('thin', 'zz')) AS x(slug, frame))
SELECT slug, count(*) AS n_support, max(fam) AS n_families, sum(c)::BIGINT AS n_counter, string_agg(id, '|' ORDER BY id) AS supporting_ids, round(least(0.82, 0.48 + 0.045 * count(*) + 0.08 * max(fam)), 6)::DOUBLE AS confidence, 'synthesis' AS epistemic_status
FROM t JOIN spec USING (frame) GROUP BY slug HAVING count(*) >= 2""")
def _(spark, sf):
    t, r = theme_edges(spark, sf)
    return K.syntheses(t, cut(r), {"low": ["f0", "f1", "f2"], "mixed": ["f3", "f7"], "thin": ["f9", "zz"]}).withColumn("supporting_ids", joined(F.col("supporting_ids")))


@query("k4_apply_judgments", f"""WITH {CLAIMS_SQL}, v AS (SELECT doc_id, quality, toxic FROM labels) SELECT claim_id, CASE WHEN v.doc_id IS NOT NULL THEN 'fact' ELSE claim_type END AS claim_type,
 round(CASE WHEN v.doc_id IS NOT NULL THEN CASE WHEN quality = 1 THEN 1.0 ELSE 0.25 END ELSE importance_score END, 4) AS importance_score, (len(numeric_risks) > 0 OR len(negation_risks) > 0 OR coalesce(toxic = 1, false)) AS needs_verification, v.doc_id IS NOT NULL AS judged
FROM claims c LEFT JOIN v ON v.doc_id = c.section_id""")
def _(spark, sf):
    c = claims(spark, sf)
    v = c.select("claim_id", F.col("section_id").alias("doc_id")).join(table(spark, sf, "labels"), "doc_id").select(
        "claim_id", F.lit("fact").alias("claim_type"), F.when(F.col("quality") == 1, 1.7).otherwise(0.25).alias("importance_score"), F.lit(0.5).alias("novelty_score"), F.lit(-1.0).alias("non_consensus_score"), (F.col("toxic") == 1).alias("needs_verification"))
    return K.apply_judgments(c, v).select("claim_id", "claim_type", "importance_score", "needs_verification", "judged")


@query("k4_accept_boundary", """SELECT doc_id AS row_id, round((0.5 + 0.1 * toxic + 0.6) / 2, 6) AS score FROM labels JOIN documents USING (doc_id) WHERE quality = 1""")
def _(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return K.accept_boundary(rows.select(F.col("doc_id").alias("row_id"), (0.5 + 0.1 * F.col("toxic")).alias("score")), rows.select(F.col("doc_id").alias("row_id"), (F.col("quality") == 1).alias("relevant"), F.lit(0.6).alias("relevance_score")))


@query("r5_representative_positions", f"""WITH {CLAIMS_SQL}, m AS (SELECT speaker AS person, unnest(themes) AS subtheme, claim_id, claim_type, importance_score AS rel FROM claims), g AS (SELECT person, subtheme, count(DISTINCT claim_type) AS n_theme_claims, max(rel) AS mr, arg_max(claim_id, (rel, claim_id)) AS representative_claim_id FROM m WHERE person IN ('src1', 'src2', 'src3') GROUP BY 1, 2)
SELECT person, subtheme, n_theme_claims, representative_claim_id FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n_theme_claims DESC, mr DESC, subtheme) AS r FROM g) WHERE r <= 2""")
def _(spark, sf):
    m = claims(spark, sf).select(F.col("speaker").alias("person"), F.explode("themes").alias("subtheme"), F.col("claim_type").alias("theme_claim_id"), "claim_id", F.col("importance_score").alias("relevance"), F.col("importance_score").alias("similarity"))
    return K.representative_positions(m, {"src1": 2, "src2": 2, "src3": 2}).select("person", "subtheme", "n_theme_claims", "representative_claim_id")


@query("r6_review_queue", """WITH t AS (SELECT doc_id, 0 AS p FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 1 FROM labels WHERE quality = 0), b AS (SELECT doc_id, min(p) AS p FROM t GROUP BY 1),
q AS (SELECT d.doc_id AS record_id, coalesce(p, 2) AS priority FROM documents d LEFT JOIN b USING (doc_id) WHERE n_chars > 5000 OR p IS NOT NULL)
SELECT record_id, priority::INT AS priority, row_number() OVER (ORDER BY priority, record_id) <= 30 AS recommended FROM q""")
def _(spark, sf):
    lab = table(spark, sf, "labels")
    tags = lab.where("toxic = 1").select(F.col("doc_id").alias("record_id"), F.lit("risk").alias("tag")).unionByName(lab.where("quality = 0").select(F.col("doc_id").alias("record_id"), F.lit("low").alias("tag")))
    rec = table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"), F.col("doc_id").alias("seq"), (F.col("n_chars") > 5000).alias("needs_review"))
    return K.review_queue(rec, tags, ["risk", "low"]).select("record_id", "priority", "recommended")


# --- gates ---------------------------------------------------------------------------------------

def gate_claims(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id")
    return table(spark, sf, "documents").join(lab, "doc_id").select(F.col("doc_id").alias("claim_id"), F.col("text").alias("claim"), F.col("n_chars").cast("double").alias("start_s"), (F.col("n_chars") + F.col("doc_id")).cast("double").alias("end_s"))


def gate_decisions(spark, sf):
    """Merges go to the first accepted claim of the table."""
    d = decisions(spark, sf)
    first = d.where("decision = 'accept'").agg(F.min("claim_id")).first()[0]
    return d.withColumn("merge_into", F.when(F.col("decision") == "merge_into", F.lit(f"canonical.{first}"))).withColumn("canonical_claim", F.lit(""))


_GATE = """WITH d AS (SELECT doc_id, quality, toxic, n_chars, text FROM labels JOIN documents USING (doc_id)), f AS (SELECT min(doc_id) AS first FROM d WHERE quality = 1 AND toxic = 0),
m AS (SELECT CASE WHEN toxic = 1 THEN first ELSE doc_id END AS target, doc_id, n_chars FROM d, f WHERE quality = 1)"""


@query("h1_decision_template", """SELECT doc_id AS claim_id, 'claim' AS record_type, '' AS decision FROM labels""")
def _(spark, sf):
    return H.decision_template(gate_claims(spark, sf), "claim", "claim_id", ["start_s", "claim_id"]).select("claim_id", "record_type", "decision")


@query("h2_apply_claim_gate", _GATE + """, s AS (SELECT target, min(n_chars)::DOUBLE AS start_s, max(n_chars + doc_id)::DOUBLE AS end_s, count(*) AS n_parents FROM m GROUP BY 1)
SELECT 'canonical.' || target AS canonical_claim_id, text AS canonical_claim, start_s, end_s, n_parents FROM s JOIN d ON d.doc_id = s.target""")
def _(spark, sf):
    a, _r, _m = H.apply_claim_gate(gate_claims(spark, sf), gate_decisions(spark, sf))
    return a.select("canonical_claim_id", "canonical_claim", "start_s", "end_s", "n_parents")


@query("h2_claim_gate_violations", """SELECT doc_id AS claim_id, 'missing' AS issue FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    every = table(spark, sf, "documents").select(F.col("doc_id").alias("claim_id"))
    return H.claim_gate_violations(every, gate_decisions(spark, sf))


def theme_review(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    c = d.select(F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("theme_claim_id"), F.col("text").alias("statement"), F.col("n_chars").alias("first_seen_at"), (F.col("n_chars") + 5).alias("last_seen_at"), "quality", "toxic", "lang", "doc_id")
    first = c.where("quality = 1 and toxic = 0 and lang = 'en'").agg(F.min("doc_id")).first()[0]
    good = F.col("quality") == 1
    action = F.when(~good, "reject").when(F.col("toxic") == 1, "merge").when(F.col("lang") == "en", "accept").otherwise("split")
    dec = c.select(
        "theme_claim_id", action.alias("decision"), F.col("statement").alias("final_statement"), F.array(F.lit("one"), F.lit("two")).alias("split_statements"), F.lit(f"t{first}").alias("merge_into"),
        F.lit("fully_supported").alias("entailment_status"), F.lit("reviewer").alias("reviewer"), *[F.lit(True).alias(f) for f in H.FLAGS])
    return c, dec


_THEME = """WITH d AS (SELECT 't' || doc_id AS id, doc_id, n_chars, quality, toxic, lang, text FROM labels JOIN documents USING (doc_id)), f AS (SELECT 't' || min(doc_id) AS first FROM d WHERE quality = 1 AND toxic = 0 AND lang = 'en'),
map AS (SELECT id AS old_id, CASE WHEN toxic = 1 THEN first WHEN lang = 'en' THEN id ELSE id || '.split_01' END AS new_id, 0 AS pos FROM d, f WHERE quality = 1 UNION ALL SELECT id, id || '.split_02', 1 FROM d WHERE quality = 1 AND toxic = 0 AND lang <> 'en')"""


@query("h3_apply_theme_gate", _THEME + """, n AS (SELECT new_id, count(*) - 1 AS n_merged, min(n_chars) AS first_seen_at, max(n_chars) + 5 AS last_seen_at FROM map JOIN d ON d.id = old_id GROUP BY 1)
SELECT new_id AS theme_claim_id, n_merged, first_seen_at, last_seen_at FROM n""")
def _(spark, sf):
    c, dec = theme_review(spark, sf)
    return H.apply_theme_gate(c, dec)[0].select("theme_claim_id", "n_merged", "first_seen_at", "last_seen_at")


@query("h3_theme_gate_violations", _THEME + """ SELECT id AS theme_claim_id, 'flag_not_true' AS issue FROM d WHERE quality = 1 AND toxic = 0 AND lang = 'de'""")
def _(spark, sf):
    c, dec = theme_review(spark, sf)
    dec = dec.join(c.select("theme_claim_id", "lang"), "theme_claim_id").withColumn("conditions_preserved", F.col("lang") != "de").drop("lang")
    return H.theme_gate_violations(c, dec)


@query("h3_accept_insights", _THEME + """, s AS (SELECT DISTINCT lang, new_id FROM d JOIN map ON map.old_id = d.id), g AS (SELECT lang, count(DISTINCT new_id) AS n FROM s GROUP BY 1), l AS (SELECT DISTINCT lang FROM d)
SELECT lang AS insight_id, coalesce(n, 0) AS n_support, CASE WHEN lang = 'es' THEN 'reject' WHEN coalesce(n, 0) < 2 THEN 'lacks_support' ELSE 'provisionally_accepted' END AS review_status FROM l LEFT JOIN g USING (lang)""")
def _(spark, sf):
    c, dec = theme_review(spark, sf)
    mapping = H.apply_theme_gate(c, dec)[2]
    ins = c.select(F.col("lang").alias("insight_id")).distinct()
    d = ins.select("insight_id", F.when(F.col("insight_id") == "es", "reject").otherwise("accept").alias("decision"))
    return H.accept_insights(ins, c.select(F.col("lang").alias("insight_id"), "theme_claim_id"), mapping, d).select("insight_id", "n_support", "review_status")


@query("j10_remap_edges", _THEME + """, first AS (SELECT old_id, arg_min(new_id, (pos, new_id)) AS new_id FROM map GROUP BY 1), e AS (SELECT doc_id AS relation_id, 't' || doc_id AS s, 't' || (doc_id + 1) AS t, toxic FROM labels),
j AS (SELECT e.*, a.new_id AS ns, b.new_id AS nt FROM e LEFT JOIN first a ON a.old_id = s LEFT JOIN first b ON b.old_id = t)
SELECT relation_id, CASE WHEN ns IS NULL OR nt IS NULL THEN 'rejected_parent_claim' ELSE 'accepted' END AS review_status, CASE WHEN ns IS NOT NULL AND nt IS NOT NULL THEN CASE WHEN toxic = 1 THEN nt ELSE ns END END AS source_id,
 CASE WHEN ns IS NOT NULL AND nt IS NOT NULL THEN CASE WHEN toxic = 1 THEN ns ELSE nt END END AS target_id FROM j""")
def _(spark, sf):
    c, dec = theme_review(spark, sf)
    mapping = H.apply_theme_gate(c, dec)[2]
    lab = table(spark, sf, "labels")
    edges = lab.select(F.col("doc_id").alias("relation_id"), F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("source_id"), F.concat(F.lit("t"), (F.col("doc_id") + 1).cast("string")).alias("target_id"), F.lit("limits").alias("relation_type"))
    d = lab.select(F.col("doc_id").alias("relation_id"), F.lit("accept").alias("decision"), F.lit("extends").alias("final_relation_type"), (F.col("toxic") == 0).alias("direction_correct"))
    return H.remap_edges(edges, mapping, d).select("relation_id", "review_status", "source_id", "target_id")


def risk_queue(spark, sf):
    best, c = clusters(spark, sf)
    themes = best.select(F.col("cluster_id").alias("theme_claim_id"), F.col("representative").alias("statement"), F.lit("opinion").alias("claim_type"))
    parents = c.select(F.col("cluster_id").alias("theme_claim_id"), "claim_id", "claim", "entity_risks")
    return themes, parents, H.local_risk_queue(themes, parents)


@query("h4_local_risk_queue")
def _(spark, sf):
    return risk_queue(spark, sf)[2]


@query("h5_queue_reduction", """WITH o AS (SELECT doc_id AS queue_id, source AS theme FROM documents JOIN labels USING (doc_id)), n AS (SELECT doc_id AS queue_id, source AS theme FROM documents JOIN labels USING (doc_id) WHERE toxic = 1),
k AS (SELECT (SELECT count(DISTINCT queue_id) FROM o) AS o, (SELECT count(DISTINCT queue_id) FROM n) AS n, (SELECT count(DISTINCT queue_id) FROM o WHERE theme IN (SELECT theme FROM n)) AS c, (SELECT count(DISTINCT queue_id) FROM n WHERE theme IN (SELECT theme FROM o)) AS r)
SELECT o AS original_count, n AS local_count, o - c AS false_positive_count, greatest(0, c - r) AS collapsed_duplicate_count, greatest(0, o - n) AS total_reduction, round(greatest(0, o - n) / greatest(1, o)::DOUBLE, 6) AS reduction_rate FROM k""")
def _(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("queue_id"), F.col("source").alias("theme_claim_id"), "toxic")
    return H.queue_reduction(d, d.where("toxic = 1"))


@query("h6_readiness", """WITH d AS (SELECT source, lang, quality, toxic, doc_id FROM documents JOIN labels USING (doc_id)), i AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'insufficient_evidence' ELSE 'verified' END AS ext, source < 'src15' AS hedged FROM d)
SELECT 0::BIGINT AS contradicted, count(*) FILTER (ext = 'insufficient_evidence' AND NOT hedged) AS unqualified_unchecked, count(*) FILTER (ext = 'insufficient_evidence' AND hedged) AS qualified_unchecked, 0::BIGINT AS source_rejected, 'needs_external_verification' AS factual_readiness FROM i""")
def _(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    themes = d.select(F.col("source").alias("theme_claim_id")).distinct().select("theme_claim_id", F.lit("plain").alias("statement"), F.when(F.col("theme_claim_id") < "src15", "hypothesis").otherwise("fact").alias("epistemic_status"))
    q = d.select(F.col("doc_id").alias("queue_id"), F.col("source").alias("theme_claim_id"))
    v = d.select(F.col("doc_id").alias("queue_id"), F.when(F.col("quality") == 1, "verified").otherwise("corrected").alias("source_fidelity_status"), F.when(F.col("toxic") == 1, "insufficient_evidence").otherwise("verified").alias("external_fact_status"))
    return H.readiness(themes, q, v)[1]


# --- evaluation ------------------------------------------------------------------------------------

def gold_and_claims(spark, sf):
    """Gold passages and the documents in which they are planted, on one time line by position."""
    b = table(spark, sf, "benchmark")
    gold = b.select(F.lit(0).alias("media_id"), F.col("item_id").alias("left"), F.col("text").alias("gold_text"), F.element_at(F.array_union(X.tag_topics("text"), F.array(F.lit("none"))), 1).alias("g_theme"),
                    (F.col("item_id") * 100.0).alias("g_start"), (F.col("item_id") * 100.0 + 20).alias("g_end"), F.array(F.lit("numeric")).alias("expected_risks"), F.lit("exact").alias("speaker_requirement"),
                    F.lit(None).cast("string").alias("expected_speaker"), F.when(F.length("text") > 200, "long").otherwise("short").alias("category"))
    c = C.atomic_seeds(table(spark, sf, "conversations").select(F.lit(0).alias("media_id"), F.concat_ws(".", "conv_id", "turn").alias("record_id"), "text", (F.col("conv_id") * 100.0).alias("start_s"), (F.col("conv_id") * 100.0 + 30).alias("end_s")))
    b2 = b.select(F.lit(0).alias("media_id"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("record_id"), F.col("text").alias("claim"), X.tag_topics("text").alias("themes"), (F.col("item_id") * 100.0 + 5).alias("start_s"), (F.col("item_id") * 100.0 + 25).alias("end_s"), X.numbers("text").alias("numeric_risks"), X.entities("text").alias("entity_risks"), X.negations("text").alias("negation_risks"))
    rows = c.select("media_id", F.concat_ws("/", "seed_id").alias("record_id"), "claim", F.array("topic").alias("themes"), "start_s", "end_s", "numeric_risks", "entity_risks", "negation_risks").unionByName(b2)
    rows = rows.withColumn("speaker", F.lit(None).cast("string")).withColumn("speaker_status", F.lit("section_inferred"))
    return gold, scan(rows, ["media_id"], ["start_s", "record_id"], sums_before={"right": F.lit(1).cast("long")}, block=F.floor(F.col("start_s") / 10000))


@query("e1_claim_matches")
def _(spark, sf):
    rows, _m = E.evaluate_claims(*gold_and_claims(spark, sf))
    return rows.select("left", "right", "score", "theme_match", "exact_attribution_met", "category")


@query("e1_claim_metrics")
def _(spark, sf):
    return E.evaluate_claims(*gold_and_claims(spark, sf))[1]


@query("e2_evaluate_alignment")
def _(spark, sf):
    r, u = projected(spark, sf)
    r = cut(r)
    own = u.select("media_id", "unit_idx", F.col("char_start").alias("u_start"), F.col("char_end").alias("u_end"))
    pred = r.select("media_id", F.col("idx").alias("item_id"), F.lit("left").alias("side"), F.explode_outer("unit_ids").alias("unit_idx"), (F.col("text_source") != "secondary").alias("fallback"))
    # the label of a segment: the characters its own units would take if the path were shifted by one
    ranges = r.where("char_start is not null").select("media_id", F.col("idx").alias("item_id"), F.lit("segment_text").alias("role"), F.lit("left").alias("side"), F.col("char_start"), (F.col("char_end") + 20).alias("char_end"))
    labels = r.select("media_id", F.col("idx").alias("item_id"), F.when(F.col("speaker") == "system", "should_fallback").otherwise("correct_alignment").alias("status"), F.when(F.col("speaker") == "user", "speaker_switch").otherwise("ordinary").alias("category"))
    return E.evaluate_alignment(labels, ranges, pred, own)


@query("e3_golden_items")
def _(spark, sf):
    c = scan(cues(spark, sf), ["media_id"], ["seq"], sums_before={"raw_start": F.length("text") + 1}).withColumn("raw_end", F.col("raw_start") + F.length("text"))
    c = cut(c)
    sel = c.select("media_id", F.floor(F.col("seq") / 2).alias("item_id"), F.when(F.col("speaker") == "user", "ordinary").otherwise("ordinary").alias("category"), "seq")
    marks = c.select("media_id", F.col("seq").alias("cue_seq"), F.col("start_s").alias("cue_start_s"), "raw_start", "raw_end")
    return E.golden_items(sel, c.select("media_id", "seq", "start_s", "end_s"), marks, c.select("media_id", F.col("seq").alias("unit_idx"), "raw_start", "raw_end")).withColumn("segments", joined(F.col("segments").cast("array<string>")))


@query("e4_labels_from_reviews", f"""WITH {CUES_SQL}, r AS (SELECT media_id, seq // 2 AS item_id, CASE length(text) % 4 WHEN 0 THEN 'correct' WHEN 1 THEN 'wrong_content' WHEN 2 THEN 'uncertain' ELSE 'should_fallback' END AS v FROM cues)
SELECT media_id, item_id, CASE WHEN bool_or(v = 'uncertain') THEN 'uncertain' WHEN bool_or(v = 'should_fallback') OR NOT bool_or(v = 'correct') THEN 'should_fallback' ELSE 'correct_alignment' END AS status FROM r GROUP BY 1, 2""")
def _(spark, sf):
    c = cues(spark, sf)
    items = c.select("media_id", F.floor(F.col("seq") / 2).alias("item_id"), F.lit("ordinary").alias("category"), "seq", (F.col("seq") % 2).alias("pos"), F.lit(2).alias("n_segments"))
    n = F.length("text") % 4
    none = F.lit(None).cast("long")
    rev = c.select("media_id", "seq", F.when(n == 0, "correct").when(n == 1, "wrong_content").when(n == 2, "uncertain").otherwise("should_fallback").alias("verdict"), none.alias("corrected_start"), none.alias("corrected_end"),
                   F.lit(0).cast("long").alias("current_start"), F.length("text").cast("long").alias("current_end"), F.lit(None).cast("string").alias("transition_owner"))
    return E.labels_from_reviews(items, rev)[0].select("media_id", "item_id", "status")


@query("e5_compare_candidates")
def _(spark, sf):
    b = cut(C.block_candidates(blocks(spark, sf)).withColumnRenamed("block_pos", "pos"))
    # the second mode sees the blocks with a speaker, two seconds later
    other = b.where("speaker is not null").withColumn("start_s", F.col("start_s") + 2)
    return E.compare_candidates(b, other)


@query("e6_freeze_golden", """SELECT doc_id AS gold_id, CASE WHEN quality = 1 THEN 'approve' ELSE 'edit' END AS review_action FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'""")
def _(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    r = d.select(F.col("doc_id").alias("gold_id"), F.when(F.col("lang") == "en", E.DRAFT).otherwise("expansion").alias("selection_source"), F.when(F.col("quality") == 1, "approve").otherwise("edit").alias("review_action"), F.lit(True).alias("system_output_hidden"),
                 F.array(F.lit("numeric")).alias("expected_risks"), F.array(F.lit(0.0), F.lit(1.0)).alias("supporting_time_range"), F.lit("").alias("epistemic_status"), *[F.lit("x").alias(c) for c in E.REQUIRED])
    return E.freeze_golden(E.migrate_golden(r))[0].select("gold_id", "review_action")


# --- batch form of the streams -------------------------------------------------------------------------

@query("st2_topic_sessions", """WITH e AS (SELECT user_id AS media_id, ts AS tm, event_type AS topic, length(event_type) AS n FROM events), p AS (SELECT *, CASE WHEN tm - lag(tm) OVER w < INTERVAL 90 MINUTE THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY media_id, topic ORDER BY tm)),
s AS (SELECT *, sum(new) OVER (PARTITION BY media_id, topic ORDER BY tm) AS sid FROM p) SELECT media_id, topic, count(*) AS n_rows, sum(n)::BIGINT AS n_chars FROM s GROUP BY media_id, topic, sid""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("media_id"), F.col("ts").alias("at"), F.col("event_type").alias("text"))
    pack = {t: [rf"^{t}$"] for t in ("view", "click", "error", "signup", "purchase")}
    return feeds.topic_session_feed(e, gap="90 minutes", topics=pack).select("media_id", "topic", "n_rows", "n_chars")


@query("st3_event_counts", """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def _(spark, sf):
    return feeds.event_counts(table(spark, sf, "events"))


@query("st3_sliding_event_counts", """WITH s AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL (30 * k) MINUTE AS window_start, event_type FROM events, (SELECT unnest([0, 1]) AS k)) SELECT window_start, event_type, count(*) AS n FROM s GROUP BY 1, 2""")
def _(spark, sf):
    return feeds.event_counts(table(spark, sf, "events"), size="1 hour", slide="30 minutes")
