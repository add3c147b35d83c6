"""Queries for records, claims, roll-ups, lookups, queues, sets and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators import claims as C
from evidence_spark.operators import quality as Q
from evidence_spark.operators import records as P
from evidence_spark.operators import rollups as G
from evidence_spark.operators import sequence as S
from evidence_spark.operators.corpus import corpus_claims
from evidence_spark.plans import duck as D
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import CUES_SQL, cues, joined, table
from evidence_spark.session import cut

# --- corpus claims as the common base ---------------------------------------------------------


def sections(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("section_id"), F.col("source").alias("source_id"), F.col("lang").alias("family"), F.col("source").alias("speaker"), "text",
                    F.col("n_chars").alias("published_at"))


def claims(spark, sf):
    return corpus_claims(sections(spark, sf))


_CUT = f"string_split(regexp_replace(text, '([.!?]){D.WS}+([A-Z0-9\"“‘])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
_NUM = f"list_sort(list_distinct({D.found('claim', R.CORPUS_NUMBER)}))"
_NEG = f"list_sort(list_distinct({D.found('claim', R.CORPUS_NEGATION)}))"
_ENT = f"list_sort(list_distinct({D.found('claim', R.MODEL)}))"
CLAIMS_SQL = f"""raw AS (SELECT doc_id AS section_id, source AS source_id, lang AS family, source AS speaker, n_chars AS published_at, unnest({_CUT}) AS s, generate_subscripts({_CUT}, 1) AS pos FROM documents),
cut AS (SELECT *, {D.strip('s')} AS claim FROM raw), typed AS (SELECT *, {D.keywords('claim')} AS themes, {D.corpus_type('claim')} AS claim_type FROM cut WHERE length(claim) >= 45),
claims AS (SELECT section_id || '.claim_' || printf('%04d', pos) AS claim_id, section_id, source_id, family, speaker, published_at, claim, claim_type, themes,
  {_NUM} AS numeric_risks, {_NEG} AS negation_risks, {_ENT} AS entity_risks,
  round(least(0.96::DOUBLE, 0.42::DOUBLE + least(0.2::DOUBLE, 0.03::DOUBLE * len(themes)) + CASE WHEN {D.has('claim', R.CORPUS_NUMBER)} THEN 0.1 ELSE 0 END::DOUBLE
    + CASE WHEN claim_type IN ('prediction', 'causal_claim', 'failure_mode', 'conditional_conclusion', 'institutional_claim') THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN length(claim) >= 120 THEN 0.06 ELSE 0 END::DOUBLE), 4) AS importance_score,
  CASE WHEN {D.has('lower(claim)', R.CORPUS_ROUTE_CHANGE)} THEN 0.72 ELSE 0.52 END::DOUBLE AS novelty_score,
  CASE WHEN {D.has('lower(claim)', R.CORPUS_NON_CONSENSUS)} THEN 0.78 ELSE 0.25 END::DOUBLE AS non_consensus_score FROM typed WHERE len(themes) > 0)"""


@query("corpus_claims", f"WITH {CLAIMS_SQL} SELECT claim_id, speaker, family, claim_type, {D.joined('themes')} AS themes, round(importance_score, 4) AS importance_score, novelty_score, non_consensus_score, {D.joined('numeric_risks')} AS numeric_risks FROM claims")
def _(spark, sf):
    return claims(spark, sf).select("claim_id", "speaker", "family", "claim_type", joined(F.col("themes")).alias("themes"), "importance_score", "novelty_score",
                                    "non_consensus_score", joined(F.col("numeric_risks")).alias("numeric_risks"))


@query("g14_run_summary", f"""WITH {CLAIMS_SQL} SELECT speaker, count(*) AS n_claims, count(*) FILTER (len(numeric_risks) > 0) AS numeric_risk_count, count(*) FILTER (len(entity_risks) > 0) AS entity_risk_count,
  count(*) FILTER (len(negation_risks) > 0) AS negation_risk_count, count(*) FILTER (len(numeric_risks) > 0 OR len(negation_risks) > 0) AS needs_verification_count, 1.0::DOUBLE AS traceability_rate, round(avg(importance_score), 4) AS mean_importance FROM claims GROUP BY speaker""")
def _(spark, sf):
    return G.run_summary(claims(spark, sf), ["speaker"])


@query("p7_trend_candidates", f"WITH {CLAIMS_SQL} SELECT claim_id FROM claims WHERE importance_score >= 0.62 OR non_consensus_score >= 0.45")
def _(spark, sf):
    return C.trend_candidates(claims(spark, sf)).select("claim_id")


@query("p8_eligible_claims", f"WITH {CLAIMS_SQL} SELECT claim_id FROM claims WHERE source_id NOT IN ('src3', 'src4')")
def _(spark, sf):
    return C.eligible_claims(claims(spark, sf).withColumn("source_ids", F.array("source_id")), ["src3", "src4"]).select("claim_id")


_VIEWS = {
    "judge": ("true", 32), "non_consensus": ("non_consensus_score >= 0.45", 15),
    "failures": ("claim_type IN ('failure_mode', 'engineering_constraint', 'conditional_conclusion')", 20),
    "quantitative": (D.has("claim", R.CORPUS_NUMBER), 20), "usable": ("NOT (len(numeric_risks) > 0 OR len(negation_risks) > 0)", 20),
}


@query("r1_top_claims", f"WITH {CLAIMS_SQL} " + " UNION ALL ".join(
    f"(SELECT '{v}' AS view, claim_id, round(importance_score, 4) AS importance_score FROM claims WHERE {w} ORDER BY importance_score DESC, novelty_score DESC, claim_id LIMIT {n})" for v, (w, n) in _VIEWS.items()))
def _(spark, sf):
    # what the views need is worked out once, not once a view
    c = cut(claims(spark, sf).select("claim_id", "importance_score", "novelty_score", "non_consensus_score", "claim_type", "value_types", "needs_verification", "confidence"))
    out = None
    for v in _VIEWS:
        part = C.top_claims(c, v).select(F.lit(v).alias("view"), "claim_id", "importance_score")
        out = part if out is None else out.unionByName(part)
    return out


@query("t16_verification_queue", f"""WITH {CLAIMS_SQL}, r AS (SELECT claim_id, importance_score, list_filter([CASE WHEN len(numeric_risks) > 0 THEN 'numeric_risk' END, CASE WHEN len(negation_risks) > 0 THEN 'negation_risk' END,
  CASE WHEN len(entity_risks) > 0 THEN 'entity_risk' END, CASE WHEN family <> 'en' THEN 'speaker_not_exact' END, CASE WHEN family <> 'en' THEN 'exact_quote_not_allowed' END], lambda x: x IS NOT NULL) AS reasons FROM claims)
SELECT claim_id, {D.joined('reasons')} AS reasons, CASE WHEN list_has_any(reasons, ['numeric_risk', 'negation_risk', 'entity_risk']) AND importance_score >= 0.65 THEN 'high' WHEN importance_score >= 0.6 THEN 'medium' ELSE 'low' END AS priority FROM r WHERE len(reasons) > 0""")
def _(spark, sf):
    c = claims(spark, sf).withColumn("exact_quote_allowed", F.col("family") == "en").withColumn(
        "speaker_status", F.when(F.col("family") == "en", "source_provided").otherwise("section_inferred"))
    return C.verification_queue(c).select("claim_id", joined(F.col("reasons")).alias("reasons"), "priority")


@query("g3_dedup_claims", f"""WITH {CLAIMS_SQL} SELECT arg_max(claim_id, (importance_score, -published_at, claim_id)) AS claim_id, count(*) AS merged_candidate_count, min(published_at) AS start_s, max(published_at) AS end_s
FROM claims GROUP BY {D.norm('claim')}, themes[1]""")
def _(spark, sf):
    c = claims(spark, sf).withColumn("start_s", F.col("published_at")).withColumn("end_s", F.col("published_at"))
    best, _ = C.dedup_claims(c)
    return best.select("claim_id", "merged_candidate_count", "start_s", "end_s")


@query("g3_dedup_members", f"""WITH {CLAIMS_SQL} SELECT claim_id, first_value(claim_id) OVER (PARTITION BY {D.norm('claim')}, themes[1] ORDER BY importance_score DESC, published_at, claim_id DESC) AS canonical_id FROM claims""")
def _(spark, sf):
    c = claims(spark, sf).withColumn("start_s", F.col("published_at")).withColumn("end_s", F.col("published_at"))
    return C.dedup_claims(c)[1].select("claim_id", "canonical_id")


@query("g5_theme_assignments", f"WITH {CLAIMS_SQL} SELECT claim_id, unnest(themes) AS theme_id, 0.97::DOUBLE AS confidence FROM claims")
def _(spark, sf):
    return C.theme_assignments(claims(spark, sf).withColumn("media_id", F.col("source_id"))).select("claim_id", "theme_id", "confidence")


@query("g6_person_positions", f"""WITH {CLAIMS_SQL}, best AS (SELECT speaker, string_agg(claim, ' || ' ORDER BY rank) AS top FROM (SELECT speaker, claim, row_number() OVER (PARTITION BY speaker ORDER BY importance_score DESC, claim_id) AS rank FROM claims) WHERE rank <= 8 GROUP BY speaker),
freq AS (SELECT speaker, string_agg(theme, '|' ORDER BY n DESC, theme) AS themes FROM (SELECT speaker, theme, count(*) AS n FROM (SELECT speaker, unnest(themes) AS theme FROM claims) GROUP BY 1, 2) GROUP BY speaker)
SELECT c.speaker, count(*) AS n_claims, min(published_at) AS first_seen_at, max(published_at) AS last_seen_at, count(DISTINCT family) AS n_families, any_value(top) AS top, any_value(f.themes) AS themes
FROM claims c JOIN best USING (speaker) JOIN freq f USING (speaker) GROUP BY c.speaker""")
def _(spark, sf):
    p = C.person_positions(claims(spark, sf))
    return p.select("speaker", "n_claims", "first_seen_at", "last_seen_at", "n_families", F.array_join("representative_claims", " || ").alias("top"), joined(F.col("themes")).alias("themes"))


@query("g7_theme_trends", f"""WITH {CLAIMS_SQL}, t AS (SELECT unnest(themes) AS theme, * FROM claims), g AS (SELECT theme, count(*) AS n_claims, count(DISTINCT speaker) AS n_speakers, count(DISTINCT family) AS n_families, min(published_at) AS first_seen_at, max(published_at) AS last_seen_at FROM t GROUP BY theme)
SELECT *, CASE WHEN n_families >= 2 THEN 'cross_source_pattern' WHEN n_claims >= 3 AND n_speakers = 1 THEN 'repeated_speaker_position' ELSE 'single_source_signal' END AS insight_type, round(least(0.9, 0.48 + 0.08 * least(n_claims, 4) + 0.08 * least(n_families, 2))::DOUBLE, 3) AS confidence FROM g""")
def _(spark, sf):
    return C.theme_trends(claims(spark, sf))


SPECS = {"articles": ["the ", "der "], "numbers": ["1", "2"], "rare": ["zzz"], "links": ["http", "www."]}
_SPEC_SQL = "CASE " + " ".join(f"WHEN slug = '{k}' THEN " + " OR ".join(f"contains(lower(claim), '{t}')" for t in v) for k, v in SPECS.items()) + " END"


@query("g8_keyword_syntheses", f"""WITH {CLAIMS_SQL}, s AS (SELECT unnest({list(SPECS)}) AS slug), m AS (SELECT slug, c.*, row_number() OVER (PARTITION BY slug ORDER BY importance_score DESC, claim_id) AS rank FROM claims c, s WHERE {_SPEC_SQL})
SELECT slug, count(*) AS n_claims, count(DISTINCT family) AS n_families, count(DISTINCT speaker) AS n_speakers, string_agg(claim_id, '|' ORDER BY rank) AS claim_ids, round(least(0.88, 0.5 + 0.04 * least(count(*), 6) + 0.08 * least(count(DISTINCT family), 2))::DOUBLE, 3) AS confidence FROM m WHERE rank <= 12 GROUP BY slug""")
def _(spark, sf):
    return C.keyword_syntheses(claims(spark, sf), SPECS).withColumn("claim_ids", joined(F.col("claim_ids")))


@query("g9_independence", """SELECT l_partkey AS claim_id, count(DISTINCT o_custkey) AS independent_speaker_count, count(DISTINCT c_mktsegment) AS independent_organization_count, count(DISTINCT n_name) AS independent_family_count, count(DISTINCT r_name) AS independent_domain_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY l_partkey""")
def _(spark, sf):
    t = lambda n: table(spark, sf, n)
    # the lines, by far the most rows, are joined last
    c = (t("customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "c_mktsegment", "n_name", "r_name"))
    o = t("orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    s = t("lineitem").select("l_partkey", "l_orderkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    s = s.select(F.col("l_partkey").alias("claim_id"), F.col("o_custkey").alias("speaker"), F.col("c_mktsegment").alias("organization"), F.col("n_name").alias("family"), F.col("r_name").alias("domain"))
    return G.independence(s, "claim_id", ["speaker", "organization", "family", "domain"])


@query("g9_evidence_types", f"""WITH {CLAIMS_SQL}, k AS (SELECT speaker, list_filter([CASE WHEN claim_type = 'personal_experience' THEN 'personal_experience' END, CASE WHEN claim_type IN ('opinion', 'prediction', 'causal_claim', 'normative_claim', 'strategic_advice', 'open_question') THEN 'speaker_opinion' END,
  CASE WHEN len(numeric_risks) > 0 THEN 'quantitative_data' END], lambda x: x IS NOT NULL) AS kinds FROM claims) SELECT DISTINCT speaker, unnest(CASE WHEN len(kinds) > 0 THEN kinds ELSE ['speaker_opinion'] END) AS evidence_type FROM k""")
def _(spark, sf):
    return G.evidence_types(claims(spark, sf).withColumn("has_numbers", F.size("numeric_risks") > 0), "speaker")


def exact_clusters(spark, sf):
    s = sections(spark, sf).withColumn("h", F.md5(X.norm_text("text")))
    g = s.groupBy("h").agg(F.min("section_id").alias("cluster_id"), F.count("*").alias("n")).where("n > 1")
    return s.join(g, "h").select("section_id", "cluster_id")


@query("g10_merge_evidence", f"""WITH h AS (SELECT *, md5({D.norm('text')}) AS h FROM documents), g AS (SELECT h, min(doc_id) AS cluster_id FROM h GROUP BY h HAVING count(*) > 1),
e AS (SELECT d.*, coalesce(cluster_id::VARCHAR, 'section.' || doc_id) AS content_id FROM h d LEFT JOIN g USING (h))
SELECT content_id, arg_max(doc_id, (length(text), -doc_id)) || '.evidence' AS canonical_evidence_id, count(*) AS n_evidence, count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_families FROM e GROUP BY content_id""")
def _(spark, sf):
    e = sections(spark, sf).withColumn("evidence_id", F.concat(F.col("section_id").cast("string"), F.lit(".evidence")))
    return C.merge_evidence(e, exact_clusters(spark, sf))[0]


@query("g11_corpus_metrics", f"""WITH {CLAIMS_SQL}, n AS (SELECT section_id, count(*) AS n FROM claims GROUP BY 1), h AS (SELECT *, md5({D.norm('text')}) AS h FROM documents), g AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
s AS (SELECT d.source AS source_id, CASE WHEN g.h IS NOT NULL THEN 'exact_duplicate' END AS kind, coalesce(n.n, 0) AS n_claims FROM h d LEFT JOIN g USING (h) LEFT JOIN n ON n.section_id = d.doc_id)
SELECT source_id, count(*) AS n_sections, 1.0::DOUBLE AS speaker_coverage, count(*) FILTER (kind = 'exact_duplicate') AS exact_duplicate_sections, 0::BIGINT AS near_duplicate_sections, sum(n_claims)::BIGINT AS n_claims, count(*) FILTER (n_claims = 0) AS unsupported_sections FROM s GROUP BY ROLLUP (source_id)""")
def _(spark, sf):
    n = claims(spark, sf).groupBy("section_id").agg(F.count("*").alias("n_claims"))
    s = sections(spark, sf).join(exact_clusters(spark, sf), "section_id", "left").join(n, "section_id", "left")
    s = s.withColumn("duplicate_kind", F.when(F.col("cluster_id").isNotNull(), "exact_duplicate")).withColumn("n_claims", F.coalesce("n_claims", F.lit(0)))
    return G.corpus_metrics(s)


def decisions(spark, sf):
    """Labels as review decisions: quality accepts, toxicity tags a risk; the time comes from the text length."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return d.select(
        F.col("doc_id").alias("claim_id"), F.when(good & toxic, "merge_into").when(good, "accept").when(toxic, "reject_incorrect").otherwise("reject_low_value").alias("decision"),
        F.when(good, "fully_supported").otherwise("overgeneralized").alias("entailment_label"),
        F.when(F.col("lang") == "en", "preserved").when(F.col("lang") == "de", "missing").otherwise("not_applicable").alias("condition_preservation"),
        F.when(toxic, F.array(F.lit("numeric"))).when(F.col("lang") == "fr", F.array(F.lit("entity"))).otherwise(F.array().cast("array<string>")).alias("verification_tags"),
        (F.col("n_chars") / 100.0).alias("review_seconds"), F.lit("reviewer").alias("reviewer"))


@query("g13_gate_metrics", """WITH d AS (SELECT CASE WHEN quality = 1 AND toxic = 1 THEN 'merge_into' WHEN quality = 1 THEN 'accept' WHEN toxic = 1 THEN 'reject_incorrect' ELSE 'reject_low_value' END AS decision, quality, toxic, lang, n_chars / 100.0 AS secs FROM labels JOIN documents USING (doc_id))
SELECT count(*) AS reviewed, count(*) FILTER (quality = 1) AS accepted, round(count(*) FILTER (quality = 1) / count(*)::DOUBLE, 6) AS acceptance_rate, round(count(*) FILTER (quality = 1) / count(*)::DOUBLE, 6) AS actual_precision,
 round(count(*) FILTER (decision = 'reject_low_value') / count(*)::DOUBLE, 6) AS low_value_rate, round(count(*) FILTER (decision = 'reject_incorrect') / count(*)::DOUBLE, 6) AS incorrect_rate, 0.0::DOUBLE AS duplicate_rate,
 round(count(*) FILTER (decision = 'merge_into') / count(*)::DOUBLE, 6) AS merge_rate, round(count(*) FILTER (quality = 1) / count(*)::DOUBLE, 6) AS entailment_accuracy,
 round(count(*) FILTER (lang = 'en') / greatest(1, count(*) FILTER (lang IN ('en', 'de')))::DOUBLE, 6) AS condition_preservation_accuracy, count(*) FILTER (quality = 1 AND toxic = 1) AS p0,
 count(*) FILTER (quality = 1 AND toxic = 0 AND lang = 'fr') AS p1, count(*) FILTER (quality = 1 AND toxic = 0 AND lang <> 'fr') AS p2, round(sum(secs)::DOUBLE / count(*), 3) AS average_review_seconds,
 round(count(*) FILTER (quality = 1) / greatest(1, count(*) FILTER (decision = 'accept'))::DOUBLE, 6) AS candidates_per_canonical FROM d""")
def _(spark, sf):
    return G.gate_metrics(decisions(spark, sf))


@query("g15_nearest_rank", " UNION ALL ".join(f"SELECT {p} AS fraction, l_extendedprice AS value FROM (SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice) AS rn, count(*) OVER () AS n FROM lineitem) WHERE rn = round_even((n - 1) * {p}, 0) + 1" for p in (0.02, 0.2, 0.5, 0.98)).replace("SELECT 0.", "SELECT 0.").replace(" AS fraction", "::DOUBLE AS fraction"))
def _(spark, sf):
    return G.nearest_ranks(table(spark, sf, "lineitem"), "l_extendedprice", (0.02, 0.2, 0.5, 0.98))


@query("g15_nearest_rank_per_key", """SELECT l_suppkey, l_extendedprice AS value FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE rn = round_even((n - 1) * 0.2, 0) + 1""")
def _(spark, sf):
    return G.nearest_rank_per(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", 0.2, "value", 1000.0)


@query("g16_set_prf", """WITH p AS (SELECT DISTINCT lang, source FROM documents JOIN labels USING (doc_id) WHERE quality = 1), g AS (SELECT DISTINCT lang, source FROM documents JOIN labels USING (doc_id) WHERE toxic = 0),
j AS (SELECT p.lang AS a, g.lang AS b, coalesce(p.lang, g.lang) AS lang FROM p FULL JOIN g ON p.lang = g.lang AND p.source = g.source),
c AS (SELECT lang, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS overlap, count(a) AS predicted, count(b) AS gold FROM j GROUP BY lang),
s AS (SELECT *, CASE WHEN predicted > 0 THEN overlap / predicted::DOUBLE WHEN gold = 0 THEN 1 ELSE 0 END AS p, CASE WHEN gold > 0 THEN overlap / gold::DOUBLE WHEN predicted = 0 THEN 1 ELSE 0 END AS r FROM c)
SELECT lang, overlap, predicted, gold, round(p, 6) AS "precision", round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM s""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id")
    return G.set_prf(d.where("quality = 1"), d.where("toxic = 0"), ["source"], ["lang"])


@query("g16_range_prf", """WITH c AS (SELECT conv_id, turn, length(text) AS n FROM conversations), a AS (SELECT conv_id, unnest(range(n // 4, n)) AS pt FROM c), b AS (SELECT conv_id, unnest(range(0, n // 2)) AS pt FROM c),
pa AS (SELECT DISTINCT * FROM a), pb AS (SELECT DISTINCT * FROM b), k AS (SELECT (SELECT count(*) FROM pa JOIN pb USING (conv_id, pt)) AS overlap, (SELECT count(*) FROM pa) AS predicted, (SELECT count(*) FROM pb) AS gold)
SELECT overlap, predicted, gold, round(overlap / predicted::DOUBLE, 6) AS "precision", round(overlap / gold::DOUBLE, 6) AS recall, round(2 * (overlap / predicted::DOUBLE) * (overlap / gold::DOUBLE) / (overlap / predicted::DOUBLE + overlap / gold::DOUBLE), 6) AS f1 FROM k""")
def _(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", F.length("text").alias("n"))
    a = c.select("conv_id", F.floor(F.col("n") / 4).alias("char_start"), F.col("n").cast("long").alias("char_end"))
    b = c.select("conv_id", F.lit(0).cast("long").alias("char_start"), F.floor(F.col("n") / 2).alias("char_end"))
    return G.range_prf(a, b, ["conv_id"])


# --- records and seeds --------------------------------------------------------------------------

def records(spark, sf):
    c = cues(spark, sf).withColumn("media_url", F.concat(F.lit("https://example.org/watch?v="), F.col("media_id")))
    status = F.when(F.col("speaker") == "assistant", "source_provided").when(F.col("speaker") == "user", "section_inferred")
    c = c.withColumn("speaker_status", status).withColumn("segment_id", F.concat_ws(".", "media_id", "seq")).withColumn("text_source", F.col("speaker"))
    return P.canonical_records(c, "high_quality_structure_mode")


REC_SQL = f"""{CUES_SQL}, rec AS (SELECT *, media_id || '.' || seq AS record_id, CASE speaker WHEN 'assistant' THEN 'source_provided' WHEN 'user' THEN 'section_inferred' ELSE 'source_provided' END AS speaker_status FROM cues)"""


@query("p1_canonical_records", f"""WITH {REC_SQL} SELECT record_id, speaker_status, CASE speaker_status WHEN 'source_provided' THEN 1.0 ELSE 0.0 END::DOUBLE AS speaker_confidence,
  CASE speaker_status WHEN 'source_provided' THEN 'segment' ELSE 'section' END AS attribution_scope, speaker_status = 'source_provided' AS exact_quote_allowed, 'https://example.org/watch?v=' || media_id || '&t=' || floor(start_s)::BIGINT || 's' AS source_url, speaker AS provider FROM rec""")
def _(spark, sf):
    return records(spark, sf).select("record_id", "speaker_status", "speaker_confidence", "attribution_scope", "exact_quote_allowed", "source_url", "provider")


@query("p2_canonical_leftovers", f"""WITH {CUES_SQL} SELECT media_id || '.' || seq AS record_id, 'unknown' AS speaker_status, 0.0::DOUBLE AS speaker_confidence, false AS exact_quote_allowed, true AS needs_verification FROM cues WHERE length({D.norm('text')}) >= 80""")
def _(spark, sf):
    c = cues(spark, sf).withColumn("media_url", F.lit("https://example.org/v")).withColumn("record_id", F.concat_ws(".", "media_id", "seq"))
    return P.canonical_leftovers(c, "dual_text_trend_mode").select("record_id", "speaker_status", "speaker_confidence", "exact_quote_allowed", "needs_verification")


@query("p6_single_source_records", f"""WITH {CUES_SQL} SELECT media_id, seq, NULL::DOUBLE AS alignment_confidence, speaker = 'system' AS speaker_needs_review, CASE WHEN speaker = 'system' THEN 'unknown_needs_review' ELSE 'source_provided' END AS speaker_status,
  CASE WHEN speaker = 'system' THEN 'speaker_attribution_pending' ELSE '' END AS speaker_review_reasons, 'text_timeline_only' AS structure_status, CASE WHEN text <> '' THEN 'readable' ELSE 'empty' END AS text_status FROM cues""")
def _(spark, sf):
    c = cues(spark, sf).withColumn("speaker", F.when(F.col("speaker") != "system", F.col("speaker")))
    r = P.single_source_records(c, "text_single")
    return r.select("media_id", "seq", "alignment_confidence", "speaker_needs_review", "speaker_status", joined(F.col("speaker_review_reasons")).alias("speaker_review_reasons"), "structure_status", "text_status")


def doc_records(spark, sf):
    return table(spark, sf, "documents").select(F.col("source").alias("media_id"), F.col("doc_id").cast("string").alias("record_id"), "text", F.lit(0.0).alias("start_s"), F.col("n_chars").cast("double").alias("end_s"))


_VALUABLE = " OR ".join(D.has("claim", p) for p in (R.NUMBER, R.VALUE_SIGNAL, R.CAUSAL, R.COMPARISON)) + f" OR ({D.has('claim', R.FUTURE)} AND {D.has('claim', R.ATOMIC_FUTURE_TERMS)})"


@query("t12_atomic_seeds", f"""WITH s AS (SELECT source AS media_id, doc_id::VARCHAR AS record_id, text, unnest({D.sentences('text')}) AS claim, generate_subscripts({D.sentences('text')}, 1) - 1 AS sent_no FROM documents),
v AS (SELECT *, {D.topics('claim')} AS own, {D.topics('text')} AS whole FROM s WHERE length(claim) >= 35 AND ({_VALUABLE})),
t AS (SELECT *, unnest(CASE WHEN len(own) > 0 THEN own ELSE whole END) AS topic FROM v)
SELECT record_id, topic, sent_no::BIGINT AS sent_no, {D.atomic_novelty('claim')} AS novelty_type, {D.joined(D.numbers('claim'))} AS numeric_risks, 'atomic_' || substr(sha256(concat_ws('|', media_id, record_id, claim, topic)), 1, 16) AS seed_id FROM t
QUALIFY row_number() OVER (PARTITION BY media_id, record_id, topic, {D.norm('claim')} ORDER BY sent_no) = 1""")
def _(spark, sf):
    s = C.atomic_seeds(doc_records(spark, sf))
    return s.select("record_id", "topic", F.col("sent_no").cast("long").alias("sent_no"), "novelty_type", joined(F.col("numeric_risks")).alias("numeric_risks"), "seed_id")


def blocks(spark, sf):
    return S.topic_blocks(records(spark, sf), X.tag_topics("text"))


@query("t13_block_candidates")
def _(spark, sf):
    b = C.block_candidates(blocks(spark, sf))
    return b.select("media_id", "topic", "block_pos", "claim", "start_s", "end_s", joined(F.col("record_ids")).alias("record_ids"), "speaker", "speaker_status", "source_agreement", "novelty_type", "needs_verification", "seed_id")


@query("t13_session_candidates", f"""WITH {REC_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY media_id ORDER BY seq) - 1 AS pos FROM rec WHERE length({D.strip('text')}) > 0), t AS (SELECT *, unnest({D.topics('text')}) AS topic FROM r),
g AS (SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND start_s - lag(end_s) OVER w <= 90 THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY media_id, topic ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY media_id, topic ORDER BY pos) AS session FROM g),
b AS (SELECT media_id, topic, session, string_agg(nullif({D.strip('text')}, ''), ' ' ORDER BY pos) AS txt, round(min(start_s), 3) AS start_s, round(max(end_s), 3) AS end_s, string_agg(record_id, '|' ORDER BY pos) AS record_ids,
  CASE WHEN count(DISTINCT speaker) = 1 THEN min(speaker) END AS speaker, CASE WHEN bool_or(speaker_status = 'section_inferred') THEN 'section_inferred' ELSE 'source_provided' END AS speaker_status FROM i GROUP BY 1, 2, 3)
SELECT media_id, topic, start_s, end_s, record_ids, speaker, speaker_status, md5(txt) AS text_md5, CASE WHEN {D.has('txt', R.FAILURE)} THEN 'failure_mode' WHEN {D.has('txt', R.BOUNDARY)} THEN 'boundary_condition' WHEN topic = 'scaling_law' THEN 'scaling_law' ELSE 'mechanism' END AS novelty_type,
  (len({D.numbers('txt')}) > 0 OR len({D.negations('txt')}) > 0) AS needs_verification FROM b""")
def _(spark, sf):
    s = S.topic_sessions(records(spark, sf), X.tag_topics("text")).withColumnRenamed("session", "block_pos")
    b = C.block_candidates(s)
    return b.select("media_id", "topic", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), joined(F.col("record_ids")).alias("record_ids"), "speaker", "speaker_status",
                    F.md5("supporting_text").alias("text_md5"), "novelty_type", "needs_verification")


def seeds(spark, sf):
    return C.union_seeds(C.block_candidates(blocks(spark, sf)), C.atomic_seeds(records(spark, sf).withColumn("record_id", F.col("record_id"))))


@query("o1_union_seeds")
def _(spark, sf):
    return seeds(spark, sf).select("media_id", "seed_id", "topic", "claim", "extraction_pass", joined(F.col("record_ids")).alias("record_ids"))


@query("g4_bundle_evidence", f"""WITH {REC_SQL}, sd AS (SELECT media_id, seq // 3 AS seed, list(record_id ORDER BY seq DESC) AS ids FROM rec GROUP BY 1, 2), x AS (SELECT media_id, seed, unnest(ids) AS record_id, generate_subscripts(ids, 1) AS pos FROM sd),
j AS (SELECT x.*, text, speaker, speaker_status, start_s, end_s FROM x JOIN rec r USING (media_id, record_id)), b AS (SELECT media_id, seed, string_agg(nullif({D.strip('text')}, ''), ' ' ORDER BY pos) AS source_text, string_agg(record_id, '|' ORDER BY pos) AS source_record_ids,
 CASE WHEN count(DISTINCT speaker) = 1 THEN min(speaker) END AS speaker, CASE WHEN bool_and(speaker_status = 'source_provided') THEN 'source_provided' ELSE 'section_inferred' END AS speaker_status, bool_and(speaker_status = 'source_provided') AS exact_quote_allowed, round(min(start_s), 3) AS start_s, round(max(end_s), 3) AS end_s,
 array_to_string(list_sort(list(DISTINCT speaker)), ',') AS provider FROM j GROUP BY 1, 2)
SELECT *, CASE WHEN NOT exact_quote_allowed OR len({D.numbers('source_text')}) > 0 OR len({D.negations('source_text')}) > 0 OR len({D.models('source_text')}) > 0 OR len({D.entities('source_text')}) > 0 THEN 'needs_review' ELSE 'unreviewed' END AS verification_status FROM b""")
def _(spark, sf):
    r = records(spark, sf)
    sd = r.groupBy("media_id", F.floor(F.col("seq") / 3).alias("seed_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "record_id")), asc=False), lambda x: x["record_id"]).alias("record_ids"))
    e = C.bundle_evidence(sd, r)
    return e.select("media_id", F.col("seed_id").alias("seed"), "source_text", joined(F.col("source_record_ids")).alias("source_record_ids"), "speaker", "speaker_status", "exact_quote_allowed",
                    F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), "provider", "verification_status")


def talk_claims(spark, sf):
    s = seeds(spark, sf)
    return C.claims_from_seeds(s, C.bundle_evidence(s, records(spark, sf)))


@query("talk_claims")
def _(spark, sf):
    return talk_claims(spark, sf).select("claim_id", "media_id", "claim", "claim_type", joined(F.col("value_types")).alias("value_types"), joined(F.col("themes")).alias("themes"), "speaker_status", "importance_score", "needs_verification")


@query("g1_chapter_rollup", f"""WITH {CUES_SQL} SELECT media_id, seq // 3 AS chapter, round(min(start_s), 3) AS start_s, round(max(end_s), 3) AS end_s, arg_min(speaker, seq) AS speaker FROM cues GROUP BY 1, 2""")
def _(spark, sf):
    out = G.chapter_rollup(cues(spark, sf).withColumn("chapter", F.floor(F.col("seq") / 3)))
    return out.select("media_id", "chapter", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), "speaker")


@query("g2_speaker_rollup", f"""WITH {REC_SQL}, c AS (SELECT media_id, speaker, speaker_status, count(*) AS n FROM rec GROUP BY 1, 2, 3) SELECT media_id, speaker, string_agg(speaker_status || '=' || n, '|' ORDER BY speaker_status) AS statuses, sum(n)::BIGINT AS n_records FROM c GROUP BY 1, 2""")
def _(spark, sf):
    out = G.speaker_rollup(records(spark, sf))
    return out.select("media_id", "speaker", joined(F.transform(F.map_entries("statuses"), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias("statuses"), "n_records")


# --- lookups, coverage and queues ---------------------------------------------------------------

@query("j6_expand_ids", f"""WITH {CLAIMS_SQL}, x AS (SELECT claim_id, [section_id + 1, section_id, -1] AS ids FROM claims), e AS (SELECT claim_id, unnest(ids) AS doc_id, generate_subscripts(ids, 1) - 1 AS pos FROM x)
SELECT claim_id, string_agg(source, '|' ORDER BY pos) AS sources FROM e JOIN documents USING (doc_id) GROUP BY claim_id""")
def _(spark, sf):
    c = claims(spark, sf).select("claim_id", F.array(F.col("section_id") + 1, F.col("section_id"), F.lit(-1).cast("long")).alias("ids"))
    rows = C.expand_ids(c, "ids", table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return C.collect_ids(rows, ["claim_id"], "source", "sources").select("claim_id", joined(F.col("sources")).alias("sources"))


@query("j8_topic_time_cover", """WITH e AS (SELECT event_id AS claim_id, user_id AS media_id, event_type AS topic, epoch_us(ts) / 1e6 AS start_s, epoch_us(ts) / 1e6 + value AS end_s FROM events),
a AS (SELECT * FROM e WHERE topic <> 'error'), b AS (SELECT * FROM e WHERE end_s - start_s < 20 AND topic <> 'view')
SELECT claim_id, EXISTS (SELECT 1 FROM b WHERE b.media_id = a.media_id AND b.topic = a.topic AND b.claim_id <> a.claim_id AND (least(a.end_s, b.end_s) >= greatest(a.start_s, b.start_s) OR abs((a.start_s + a.end_s) / 2 - (b.start_s + b.end_s) / 2) <= 90)) OR
  EXISTS (SELECT 1 FROM b WHERE b.claim_id = a.claim_id) AS covered FROM a""")
def _(spark, sf):
    from evidence_spark.functions.keys import epoch

    e = table(spark, sf, "events").select(F.col("event_id").alias("claim_id"), F.col("user_id").alias("media_id"), F.col("event_type").alias("topic"), epoch("ts").alias("start_s"), "value")
    e = e.withColumn("end_s", F.col("start_s") + F.col("value"))
    return C.topic_time_cover(e.where("topic <> 'error'"), e.where((F.col("end_s") - F.col("start_s") < 20) & (F.col("topic") != "view"))).select("claim_id", "covered")


@query("j9_unallocated", f"""WITH {CUES_SQL} SELECT media_id, seq AS unit_idx FROM cues WHERE seq % 3 = 0""")
def _(spark, sf):
    c = cues(spark, sf)
    used = c.groupBy("media_id", F.floor(F.col("seq") / 3).alias("g")).agg(F.collect_list(F.when(F.col("seq") % 3 != 0, F.col("seq"))).alias("unit_ids"))
    return C.unallocated(c.select("media_id", F.col("seq").alias("unit_idx")), used)


@query("j11_propagate_queue", """WITH q AS (SELECT doc_id AS queue_id, doc_id AS claim_id, CASE WHEN toxic = 1 THEN 'P0' ELSE 'P1' END AS priority FROM labels), tp AS (SELECT DISTINCT source AS theme_claim_id, doc_id AS claim_id FROM documents),
ic AS (SELECT DISTINCT lang AS insight_id, source AS theme_claim_id FROM documents WHERE lang <> 'en'), j AS (SELECT q.*, tp.theme_claim_id, insight_id FROM q JOIN tp USING (claim_id) LEFT JOIN ic USING (theme_claim_id)),
g AS (SELECT queue_id, claim_id, priority, count(DISTINCT theme_claim_id) AS n_theme_claims, count(DISTINCT insight_id) AS n_insights FROM j GROUP BY 1, 2, 3)
SELECT *, CASE WHEN n_insights > 0 AND priority = 'P0' THEN 'high' ELSE 'medium' END AS conclusion_impact FROM g WHERE n_insights > 0 OR priority = 'P0'""")
def _(spark, sf):
    d = table(spark, sf, "documents")
    q = table(spark, sf, "labels").select(F.col("doc_id").alias("queue_id"), F.col("doc_id").alias("claim_id"), F.when(F.col("toxic") == 1, "P0").otherwise("P1").alias("priority"))
    tp = d.select(F.col("source").alias("theme_claim_id"), F.col("doc_id").alias("claim_id"))
    ic = d.where("lang <> 'en'").select(F.col("lang").alias("insight_id"), F.col("source").alias("theme_claim_id")).distinct()
    return C.propagate_queue(q, tp, ic)


@query("t17_risk_spans", f"""WITH {CLAIMS_SQL}, t AS (SELECT claim_id, claim, unnest(list_distinct(list_concat(list_concat(numeric_risks, negation_risks), entity_risks))) AS term FROM claims), p AS (SELECT *, instr(lower(claim), lower(term)) AS p FROM t)
SELECT claim_id, term, p - 1 AS char_start, p - 1 + length(term) AS char_end, substr(claim, greatest(1, p - 120), p + length(term) - 1 + 120 - greatest(1, p - 120) + 1) AS excerpt FROM p WHERE p > 0""")
def _(spark, sf):
    c = claims(spark, sf).withColumn("terms", F.array_distinct(F.concat("numeric_risks", "negation_risks", "entity_risks")))
    out = C.risk_spans(c, "claim", "terms", around=120)
    return out.select("claim_id", "term", F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"), "excerpt")


# --- sets and contracts -------------------------------------------------------------------------

@query("o2_check_exact_set", """WITH g AS (SELECT doc_id FROM labels UNION ALL SELECT doc_id + 7 FROM labels WHERE toxic = 1), c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1), j AS (SELECT coalesce(d.doc_id, c.doc_id) AS doc_id, d.doc_id AS e, n FROM documents d FULL JOIN c ON c.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN e IS NULL THEN 'extra' WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS issue FROM j WHERE e IS NULL OR n IS NULL OR n > 1""")
def _(spark, sf):
    lab = table(spark, sf, "labels")
    got = lab.select("doc_id").unionByName(lab.where("toxic = 1").select((F.col("doc_id") + 7).alias("doc_id")))
    return Q.check_exact_set(table(spark, sf, "documents"), got, "doc_id")


@query("o3_compare_sets", f"""WITH w AS (SELECT DISTINCT 'd' AS side, unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS word FROM documents UNION SELECT DISTINCT 'c', unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) FROM conversations)
SELECT word, CASE WHEN count(*) = 2 THEN 'both' WHEN min(side) = 'd' THEN 'left' ELSE 'right' END AS side FROM w GROUP BY word""")
def _(spark, sf):
    words = lambda t: table(spark, sf, t).select(F.explode(X.matches(F.lower("text"), "[a-z]{4,}")).alias("word"))
    return Q.compare_sets(words("documents"), words("conversations"), "word")


CONTRACT = {"text": {"required": True, "pattern": "^[A-Z]"}, "lang": {"enum": ["en", "fr", "de"]}, "n_chars": {"min": 100, "max": 9000}}


@query("q1_check_contract", """WITH v AS (SELECT 'text' AS "column", 'pattern' AS rule, doc_id FROM documents WHERE NOT regexp_matches(text, '^[A-Z]') UNION ALL SELECT 'lang', 'enum', doc_id FROM documents WHERE lang NOT IN ('en', 'fr', 'de')
 UNION ALL SELECT 'n_chars', 'min', doc_id FROM documents WHERE n_chars < 100 UNION ALL SELECT 'n_chars', 'max', doc_id FROM documents WHERE n_chars > 9000)
SELECT "column", rule, count(*) AS n_violations, array_to_string(list_sort(list(doc_id))[1:5], '|') AS examples FROM v GROUP BY 1, 2""")
def _(spark, sf):
    out = Q.check_contract(table(spark, sf, "documents"), CONTRACT, "doc_id")
    return out.withColumn("examples", joined(F.col("examples").cast("array<string>")))


@query("q2_check_integrity", """SELECT 'ends_before_start' AS rule, doc_id::VARCHAR AS ref FROM documents WHERE n_chars < 200 UNION ALL SELECT 'missing_link', doc_id::VARCHAR FROM documents WHERE lang = 'de'
 UNION ALL SELECT 'orphan_reference', l.doc_id::VARCHAR FROM labels l WHERE toxic = 1 AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id + 7)""")
def _(spark, sf):
    e = table(spark, sf, "documents").select(F.col("doc_id").alias("evidence_id"), F.lit(200).alias("start_s"), F.col("n_chars").alias("end_s"), F.when(F.col("lang") != "de", "https://example.org").alias("source_url"))
    c = table(spark, sf, "labels").select(F.col("doc_id").alias("claim_id"), F.array(F.when(F.col("toxic") == 1, F.col("doc_id") + 7).otherwise(F.col("doc_id"))).alias("evidence_ids"))
    return Q.check_integrity(e, c)
