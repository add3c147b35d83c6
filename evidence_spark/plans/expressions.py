"""Queries for expressions: text, tokens, conflicts, topics, claim types, scores, keys and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import keys as K
from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators.scan import scan
from evidence_spark.plans import duck as D
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import CUES_SQL, cues, joined, sentence_rows, table

SENT_SQL = f"""
sent AS (
  SELECT doc_id, source, lang, unnest({D.sentences('text')}) AS sentence,
    generate_subscripts({D.sentences('text')}, 1) - 1 AS sent_no FROM documents)"""


def doc_sentences(spark, sf, min_chars=1):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    return sentence_rows(d, "text", min_chars).drop("text")


def turn_pairs(spark, sf):
    """Each turn with the one before it in the same recording."""
    c = cues(spark, sf)
    return scan(c, ["media_id"], ["seq"], lags={"prev": F.col("text")}).where(F.col("prev").isNotNull())


PAIRS_SQL = f"""WITH {CUES_SQL}, pairs AS (
  SELECT * FROM (SELECT *, lag(text) OVER (PARTITION BY media_id ORDER BY seq) AS prev FROM cues) WHERE prev IS NOT NULL)"""


@query("t1_norm_text", f"SELECT doc_id, length({D.norm('text')}) AS n_norm, md5({D.norm('text')}) AS norm_md5 FROM documents")
def _(spark, sf):
    n = X.norm_text("text")
    return table(spark, sf, "documents").select("doc_id", F.length(n).cast("long").alias("n_norm"), F.md5(n).alias("norm_md5"))


def _grams_sql(c, n):
    return f"list_distinct(list_transform(range(1, length({c}) - {n - 2}), lambda i: substr({c}, i, {n})))"


@query("t3_gram_overlap", f"""{PAIRS_SQL}, g AS (
  SELECT media_id, seq, {_grams_sql('na', 8)} AS a, {_grams_sql('nb', 8)} AS b, {_grams_sql('na', 5)} AS a5, {_grams_sql('nb', 5)} AS b5
  FROM (SELECT media_id, seq, {D.norm('prev')} AS na, {D.norm('text')} AS nb FROM pairs))
SELECT media_id, seq, round(len(list_intersect(a, b)) / greatest(1, least(len(a), len(b)))::DOUBLE, 6) AS share8,
  round(len(list_intersect(a, b)) / greatest(1, len(a))::DOUBLE, 6) AS left8,
  round(len(list_intersect(a5, b5)) / greatest(1, least(len(a5), len(b5)))::DOUBLE, 6) AS share5 FROM g""")
def _(spark, sf):
    p = turn_pairs(spark, sf).select(
        "media_id", "seq", X.grams("prev", 8).alias("a"), X.grams("text", 8).alias("b"),
        X.grams("prev", 5).alias("a5"), X.grams("text", 5).alias("b5"))
    return p.select(
        "media_id", "seq",
        F.round(X.gram_share(F.col("a"), F.col("b")), 6).alias("share8"),
        F.round(X.gram_share(F.col("a"), F.col("b"), "left"), 6).alias("left8"),
        F.round(X.gram_share(F.col("a5"), F.col("b5")), 6).alias("share5"))


@query("t4_token_sets", f"""SELECT doc_id, {D.joined(D.numbers('text'))} AS numbers, {D.joined(D.models('text'))} AS models,
  {D.joined(D.negations('text'))} AS negations, md5({D.joined(D.entities('text'))}) AS entities_md5,
  {D.joined(D.fused_numbers('text'))} AS fused_numbers, {D.joined(D.fused_models('text'))} AS fused_models,
  {D.joined(D.fused_negations('text'))} AS fused_negations FROM documents""")
def _(spark, sf):
    t, f = X.token_sets("text"), X.token_sets("text", "fused")
    return table(spark, sf, "documents").select("doc_id", t.alias("t"), f.alias("f")).select(
        "doc_id", joined(F.col("t.numbers")).alias("numbers"), joined(F.col("t.models")).alias("models"),
        joined(F.col("t.negations")).alias("negations"), F.md5(joined(F.col("t.entities"))).alias("entities_md5"),
        joined(F.col("f.numbers")).alias("fused_numbers"), joined(F.col("f.models")).alias("fused_models"),
        joined(F.col("f.negations")).alias("fused_negations"))


_TERMS = (f"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(speaker, {D.re2(R.FUSED_WORD)}), lambda x: lower(x)), "
          f"lambda x: length(x) >= 3 AND x NOT IN {D.in_list(R.FUSED_STOPWORDS)})))")


@query("t5_conflicts_structured", f"""{PAIRS_SQL}, k AS (
  SELECT media_id, seq, {D.fused_numbers('prev')} AS na, {D.fused_numbers('text')} AS nb, {D.fused_models('prev')} AS ma,
    {D.fused_models('text')} AS mb, {D.fused_negations('prev')} AS ga, {D.fused_negations('text')} AS gb,
    list_filter({_TERMS}, lambda w: contains({D.norm('prev')}, w) <> contains({D.norm('text')}, w)) AS terms FROM pairs)
SELECT media_id, seq, concat_ws('|', CASE WHEN len(na) > 0 AND len(nb) > 0 AND na <> nb THEN 'numeric_conflict' END,
  CASE WHEN ma <> mb THEN 'model_name_conflict' END, CASE WHEN ga <> gb THEN 'negation_conflict' END,
  CASE WHEN len(terms) > 0 THEN 'protected_term_conflict' END) AS conflicts, {D.joined('terms')} AS terms FROM k""")
def _(spark, sf):
    p = turn_pairs(spark, sf).select("media_id", "seq", X.conflicts_structured("prev", "text", "speaker").alias("c"))
    return p.select("media_id", "seq", joined(F.col("c.type")).alias("conflicts"),
                    joined(F.flatten(F.col("c.terms"))).alias("terms"))


@query("t6_conflicts_text", f"""{PAIRS_SQL}, k AS (
  SELECT media_id, seq, {D.numbers('prev')} AS na, {D.numbers('text')} AS nb, {D.models('prev')} AS ma, {D.models('text')} AS mb,
    {D.negations('prev')} AS ga, {D.negations('text')} AS gb, {D.entities('prev')} AS ea, {D.entities('text')} AS eb FROM pairs)
SELECT media_id, seq, concat_ws('|', CASE WHEN na <> nb THEN 'numeric_conflict' END, CASE WHEN ga <> gb THEN 'negation_conflict' END,
  CASE WHEN ma <> mb THEN 'model_name_conflict' END,
  CASE WHEN len(ea) > 0 AND len(eb) > 0 AND ea <> eb THEN 'entity_conflict' END) AS conflicts FROM k""")
def _(spark, sf):
    p = turn_pairs(spark, sf).select("media_id", "seq", X.conflicts_text("prev", "text").alias("c"))
    return p.select("media_id", "seq", joined(F.col("c.type")).alias("conflicts"))


@query("t7_risk_summary", f"""SELECT conv_id, turn, {D.joined(D.numbers('text'))} AS numeric_risks,
  {D.joined(f"list_sort(list_distinct(list_concat({D.models('text')}, {D.entities('text')})))")} AS entity_risks,
  {D.joined(D.negations('text'))} AS negation_risks FROM conversations""")
def _(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", X.risk_summary("text").alias("r"))
    return c.select("conv_id", "turn", *[joined(F.col("r." + k)).alias(k) for k in ("numeric_risks", "entity_risks", "negation_risks")])


@query("t8_tag_topics", f"""SELECT doc_id, {D.joined(D.topics('text'))} AS topics, {D.joined(D.keywords('text'))} AS themes FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", joined(X.tag_topics("text")).alias("topics"),
                                                joined(X.tag_keywords("text")).alias("themes"))


@query("t9_claim_type", f"""WITH {SENT_SQL}, n AS (SELECT *, {D.atomic_novelty('sentence')} AS nov FROM sent WHERE length(sentence) >= 35)
SELECT doc_id, sent_no, nov AS novelty, {D.claim_type('sentence', 'nov')} AS claim_type, {D.corpus_type('sentence')} AS corpus_type FROM n""")
def _(spark, sf):
    s = doc_sentences(spark, sf, 35).withColumn("novelty", X.atomic_novelty("sentence"))
    return s.select("doc_id", F.col("sent_no").cast("long").alias("sent_no"), "novelty",
                    X.claim_type("sentence", "novelty").alias("claim_type"),
                    X.claim_type("sentence", pack="corpus").alias("corpus_type"))


_VT = """list_sort(list_filter(['trend_signal', 'practical_implication', CASE WHEN n_sig > 0 THEN 'non_consensus' END,
  CASE WHEN n_num > 0 THEN 'quantitative_signal' END, CASE WHEN nov = 'failure_mode' THEN 'failure_case' END,
  CASE WHEN nov IN ('failure_mode', 'boundary_condition') THEN 'boundary_condition' END,
  CASE WHEN nov = 'boundary_condition' THEN 'hidden_assumption' END,
  CASE WHEN agr IN ('mixed', 'conflict') THEN 'cross_source_connection' END], lambda x: x IS NOT NULL))"""
_VT_BASE = f"""WITH {SENT_SQL}, n AS (SELECT doc_id, sent_no, sentence, {D.atomic_novelty('sentence')} AS nov, len({D.lowset(D.found('sentence', R.NON_CONSENSUS))}) AS n_sig,
  len({D.numbers('sentence')}) AS n_num, CASE WHEN lang = 'en' THEN 'mixed' ELSE 'single_source' END AS agr FROM sent WHERE length(sentence) >= 35)"""


def _valued(spark, sf):
    return doc_sentences(spark, sf, 35).select(
        "doc_id", F.col("sent_no").cast("long").alias("sent_no"), "sentence", X.atomic_novelty("sentence").alias("nov"),
        F.size(X.signals("sentence")).alias("n_sig"), F.size(X.numbers("sentence")).alias("n_num"),
        F.when(F.col("lang") == "en", "mixed").otherwise("single_source").alias("agr"))


@query("t10_value_types", f"{_VT_BASE} SELECT doc_id, sent_no, {D.joined(_VT)} AS value_types FROM n")
def _(spark, sf):
    return _valued(spark, sf).select("doc_id", "sent_no", joined(X.value_types("nov", "n_sig", "n_num", "agr")).alias("value_types"))


_NC = "least(1.0, 0.18 + 0.18 * n_sig + CASE WHEN nov = 'failure_mode' THEN 0.18 ELSE 0 END)::DOUBLE"


@query("t11_scores", f"""{_VT_BASE}, z AS (SELECT *, {_NC} AS nc FROM n)
SELECT doc_id, sent_no, CASE agr WHEN 'mixed' THEN 0.72 ELSE 0.65 END::DOUBLE AS confidence,
  round(least(1.0::DOUBLE, 0.35::DOUBLE + 0.28::DOUBLE * nc + CASE WHEN nov IN ('failure_mode', 'boundary_condition', 'scaling_law') THEN 0.15 ELSE 0 END::DOUBLE), 4) AS novelty_score,
  round(least(1.0::DOUBLE, 0.52::DOUBLE + CASE WHEN n_num > 0 THEN 0.1 ELSE 0 END::DOUBLE + CASE WHEN nov IN ('failure_mode', 'boundary_condition') THEN 0.12 ELSE 0 END::DOUBLE + 0.16::DOUBLE * nc), 4) AS importance_score,
  round(nc, 4) AS non_consensus_score,
  round(least(0.96::DOUBLE, 0.42::DOUBLE + least(0.2::DOUBLE, 0.03::DOUBLE * len({D.keywords('sentence')})) + CASE WHEN {D.has('sentence', R.CORPUS_NUMBER)} THEN 0.1 ELSE 0 END::DOUBLE
    + CASE WHEN {D.corpus_type('sentence')} IN ('prediction', 'causal_claim', 'failure_mode', 'conditional_conclusion', 'institutional_claim') THEN 0.12 ELSE 0 END::DOUBLE
    + CASE WHEN length(sentence) >= 120 THEN 0.06 ELSE 0 END::DOUBLE), 4) AS corpus_importance FROM z""")
def _(spark, sf):
    s = _valued(spark, sf)
    s = s.select("doc_id", "sent_no", X.score_struct("nov", "n_sig", "n_num", "agr").alias("s"),
                 X.corpus_importance("sentence", X.claim_type("sentence", pack="corpus"), X.tag_keywords("sentence")).alias("corpus_importance"))
    return s.select("doc_id", "sent_no", "s.confidence", *[F.round("s." + c, 4).alias(c) for c in
                    ("novelty_score", "importance_score", "non_consensus_score")], "corpus_importance")


_STAMP = """CASE WHEN floor(start_s) >= 3600 THEN printf('%02d:%02d:%02d', (floor(start_s)::BIGINT // 3600), (floor(start_s)::BIGINT % 3600) // 60, floor(start_s)::BIGINT % 60)
  ELSE printf('%02d:%02d', floor(start_s)::BIGINT // 60, floor(start_s)::BIGINT % 60) END"""


@query("t14_time_stamps", f"""WITH {CUES_SQL} SELECT media_id, seq, {_STAMP} AS stamp, floor(start_s)::DOUBLE AS seconds FROM cues""")
def _(spark, sf):
    c = cues(spark, sf).withColumn("stamp", K.to_stamp("start_s"))
    return c.select("media_id", "seq", "stamp", K.to_seconds("stamp").alias("seconds"))


@query("t15_stable_id", """SELECT doc_id, 'ev_' || substr(sha256(concat_ws('|', source, doc_id, text)), 1, 16) AS evidence_id FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.stable_id("ev", "source", "doc_id", "text").alias("evidence_id"))


@query("t18_is_hedged", f"""WITH {SENT_SQL} SELECT doc_id, count(*) AS n_sentences,
  count(*) FILTER (regexp_matches(lower(sentence), {D.quote(R.HEDGE)})) AS n_hedged FROM sent GROUP BY doc_id""")
def _(spark, sf):
    return doc_sentences(spark, sf).groupBy("doc_id").agg(
        F.count("*").alias("n_sentences"), F.count_if(X.is_hedged("sentence")).alias("n_hedged"))


@query("p3_is_meaningful", f"""SELECT conv_id, turn, (len(regexp_extract_all(text, '[A-Za-z]{{4,}}')) >= 10 OR {D.has('text', R.TECHNICAL)}) AS meaningful FROM conversations""")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.is_meaningful("text").alias("meaningful"))


_SQ = f"{D.strip('regexp_replace(text, $q$' + D.WS + '+$q$, $q$ $q$, $q$g$q$)')}"


@query("p4_evidence_rows", f"""WITH {CUES_SQL}, q AS (SELECT *, {_SQ} AS t FROM cues),
h AS (SELECT *, substr(t, 1, 360) AS head FROM q)
SELECT media_id, seq, {_STAMP} AS stamp, 'https://example.org/watch?v=' || media_id || '&t=' || floor(start_s)::BIGINT || 's' AS url,
  CASE WHEN length(t) <= 360 THEN t ELSE regexp_replace(CASE WHEN contains(head, ' ') THEN regexp_replace(head, '(?s) [^ ]*$', '') ELSE head END, '[.,;:!? ]+$', '') || '…' END AS quote,
  CASE WHEN speaker = 'unknown' THEN 0.0 ELSE 0.75 END::DOUBLE AS speaker_confidence, true AS needs_review FROM h""")
def _(spark, sf):
    from evidence_spark.operators.records import evidence_rows

    c = cues(spark, sf).withColumn("media_url", F.concat(F.lit("https://example.org/watch?v="), F.col("media_id")))
    return evidence_rows(c).select("media_id", "seq", "stamp", "url", "quote", "speaker_confidence", "needs_review")


@query("p5_agreement_band", """SELECT doc_id, CASE WHEN lang IS NULL AND source IS NOT NULL THEN 'source_b_only'
  WHEN s IS NULL THEN 'single_source' WHEN s >= 0.85 THEN 'high' WHEN s >= 0.65 THEN 'medium' ELSE 'low' END AS agreement
FROM (SELECT d.*, CASE WHEN l.doc_id IS NULL THEN NULL ELSE 0.6 + 0.3 * l.quality - 0.1 * l.toxic END AS s FROM documents d LEFT JOIN labels l USING (doc_id))""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    s = F.lit(0.6) + 0.3 * F.col("quality") - 0.1 * F.col("toxic")
    return d.select("doc_id", X.agreement_band(s, F.col("lang").isNotNull(), F.col("source").isNotNull()).alias("agreement"))


@query("s10_media_key", r"""SELECT page_id, 'web_' || regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), ':.*$', '') || '_' ||
  CASE WHEN slug = '' THEN 'page' ELSE slug END AS media_key FROM (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages)""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", K.media_key("url").alias("media_key"))


@query("s13_redact", r"""SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url,
  md5(regexp_replace(regexp_replace(html, '(?i)(https?://[^\s\]\[()<>"''?#]*)[?#][^\s\]\[()<>"'']*', '\1', 'g'), '(?i)\b(token|secret|password|api[_-]?key|authorization)=([^\s&]+)', '\1=<redacted>', 'g')) AS html_md5 FROM pages""")
def _(spark, sf):
    p = K.redact(table(spark, sf, "pages"))
    return p.select("page_id", "url", F.md5("html").alias("html_md5"))


_BEST = f"""list_sort(list_transform({D.sentences('text')}, lambda s, i: struct_pack(a := {D.has('s', R.NON_CONSENSUS)}::INT, b := {D.has('s', R.BOUNDARY)}::INT,
  n := len({D.found('s', R.NUMBER)}), l := length(s), p := -i, s := s)), 'DESC')[1].s"""


@query("r7_best_sentence", f"SELECT conv_id, turn, coalesce({_BEST}, {D.strip('text')}) AS best FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.best_sentence("text").alias("best"))
