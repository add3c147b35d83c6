"""Queries for sequence and interval operators over time lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import keys as K
from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators import intervals as I
from evidence_spark.operators import sequence as S
from evidence_spark.plans import duck as D
from evidence_spark.plans.expressions import SENT_SQL  # noqa: F401
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import COARSE_SQL, CUES_SQL, coarse, cues, joined, table

DAY = 86400


def log_cues(spark, sf):
    """Log events as cues: one recording per user, one chapter per day."""
    e = table(spark, sf, "events")
    at = K.epoch("ts")
    return e.select(F.col("user_id").alias("media_id"), F.col("event_id").alias("seq"), at.alias("start_s"),
                    F.col("event_type").alias("text"), F.floor(at / DAY).alias("day"), "value")


EVENTS_SQL = """ev AS (SELECT user_id AS media_id, event_id AS seq, epoch_us(ts) / 1e6 AS start_s, event_type AS text,
  floor(epoch_us(ts) / 1e6 / 86400)::BIGINT AS day, value FROM events)"""
ORDER = ["start_s", "seq"]


def _cell():
    return F.floor(F.col("start_s") / DAY)


@query("w1_close_intervals", f"""WITH {EVENTS_SQL}, n AS (SELECT *, lead(start_s) OVER w AS nx, lead(day) OVER w AS nd FROM ev WINDOW w AS (PARTITION BY media_id ORDER BY start_s, seq))
SELECT media_id, seq, round(start_s, 3) AS start_s, round(CASE WHEN nd = day THEN nx ELSE (day + 1) * 86400 END, 3) AS end_s, false AS bad_interval FROM n""")
def _(spark, sf):
    out = S.close_intervals(log_cues(spark, sf), (F.col("day") + 1) * DAY, order=ORDER, within="day", block=_cell())
    return out.select("media_id", "seq", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), "bad_interval")


@query("w2_collapse_repeats", f"""WITH {EVENTS_SQL}, p AS (SELECT *, lag(text) OVER (PARTITION BY media_id ORDER BY start_s, seq) AS prev FROM ev),
i AS (SELECT *, sum(CASE WHEN prev = text THEN 0 ELSE 1 END) OVER (PARTITION BY media_id ORDER BY start_s, seq) AS island FROM p)
SELECT media_id, island::BIGINT AS island, round(min(start_s), 3) AS start_s, round(max(start_s + value), 3) AS end_s, any_value(text) AS text, count(*) AS n_rows FROM i GROUP BY media_id, island""")
def _(spark, sf):
    c = log_cues(spark, sf).withColumn("end_s", F.col("start_s") + F.col("value")).withColumn("speaker", F.lit("unknown"))
    out = S.collapse_repeats(c, order=ORDER, block=_cell())
    return out.select("media_id", F.col("island").cast("long").alias("island"), F.round("start_s", 3).alias("start_s"),
                      F.round("end_s", 3).alias("end_s"), "text", "n_rows")


@query("w3_dedup_rolling")
def _(spark, sf):
    return S.dedup_rolling(rolling(spark, sf)).select("media_id", "seq", "speaker", "novel")


def rolling(spark, sf):
    """Captions that roll: each cue repeats the last words of the turn before it."""
    from evidence_spark.operators.scan import scan

    c = scan(cues(spark, sf), ["media_id"], ["seq"], lags={"_p": F.substring("text", -40, 40)})
    return c.withColumn("text", F.concat_ws(" ", "_p", "text")).drop("_p")


@query("w4_chunk_cues")
def _(spark, sf):
    c = cues(spark, sf)
    return S.chunk_cues(c).select("media_id", "chunk", "start_s", "end_s", "speaker", "n_cues", F.length("text").alias("n_chars"))


@query("w5_carry_speaker", f"""WITH {EVENTS_SQL}, h AS (SELECT *, sum(CASE WHEN text = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY media_id ORDER BY start_s, seq) AS section_no,
  CASE WHEN text IN ('click', 'view') THEN text END AS spk FROM ev)
SELECT media_id, seq, section_no::BIGINT AS section_no, last_value(spk IGNORE NULLS) OVER (PARTITION BY media_id, section_no ORDER BY start_s, seq ROWS UNBOUNDED PRECEDING) AS carried FROM h""")
def _(spark, sf):
    c = log_cues(spark, sf).withColumn("speaker", F.when(F.col("text").isin("click", "view"), F.col("text")))
    out = S.carry_speaker(c, F.col("text") == "error", keys=["media_id"], order=ORDER, block=_cell())
    return out.select("media_id", "seq", F.col("section_no").cast("long").alias("section_no"), "carried")


def units(spark, sf):
    c = cues(spark, sf)
    return S.unit_offsets(S.semantic_units(c), c)


@query("w6_semantic_units")
def _(spark, sf):
    return S.semantic_units(cues(spark, sf)).select("media_id", "seq", "unit_no", "unit_text", "local_start", "local_end", "unit_type",
                                                    "boundary_start", "boundary_end")


@query("w7_unit_offsets", f"""WITH {CUES_SQL}, base AS (SELECT *, sum(length(text) + 1) OVER (PARTITION BY media_id ORDER BY seq) - length(text) - 1 AS off FROM cues),
u AS (SELECT media_id, seq, off, start_s, end_s, text, unnest({D.sentences('text')}) AS s, generate_subscripts({D.sentences('text')}, 1) - 1 AS unit_no FROM base),
t AS (SELECT *, length(s) AS n FROM u)
SELECT media_id, seq, unit_no::BIGINT AS unit_no, (row_number() OVER w - 1)::BIGINT AS unit_idx, off::BIGINT AS char_start, (off + n)::BIGINT AS char_end,
  round(start_s + (end_s - start_s) * (n / greatest(1, length(text))::DOUBLE), 2) AS unit_end_s
FROM t WINDOW w AS (PARTITION BY media_id ORDER BY seq, unit_no)""")
def _(spark, sf):
    c = cues(spark, sf)
    u = c.select("*", F.posexplode(X.sentences("text")).alias("unit_no", "unit_text")).withColumn("local_start", F.lit(0)).withColumn(
        "local_end", F.length("unit_text"))
    out = S.unit_offsets(u, c)
    return out.select("media_id", "seq", F.col("unit_no").cast("long").alias("unit_no"), F.col("unit_idx").cast("long").alias("unit_idx"),
                      F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"),
                      F.round("unit_end_s", 2).alias("unit_end_s"))


@query("w8_topic_blocks")
def _(spark, sf):
    b = S.topic_blocks(cues(spark, sf), X.tag_topics("text"))
    return b.select("media_id", "topic", "block_pos", "pos", "seq", "start_s", "end_s")


@query("w8_topic_sessions", f"""WITH {CUES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY media_id ORDER BY seq) - 1 AS pos FROM cues WHERE length({D.strip('text')}) > 0),
t AS (SELECT *, unnest({D.topics('text')}) AS topic FROM r),
g AS (SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND start_s - lag(end_s) OVER w <= 90 THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY media_id, topic ORDER BY pos))
SELECT media_id, topic, seq, (sum(new) OVER (PARTITION BY media_id, topic ORDER BY pos))::BIGINT AS session FROM g""")
def _(spark, sf):
    return S.topic_sessions(cues(spark, sf), X.tag_topics("text")).select("media_id", "topic", "seq", F.col("session").cast("long").alias("session"))


@query("w9_local_context", f"""WITH {CUES_SQL}, c AS (SELECT media_id, seq, text, substr(text, 11, 40) AS claim, coalesce(right(lag(text) OVER w, 600), '') AS previous_turn,
  coalesce(left(lead(text) OVER w, 600), '') AS next_turn FROM cues WINDOW w AS (PARTITION BY media_id ORDER BY seq)),
a AS (SELECT *, instr(lower(text), lower(claim)) AS found FROM c)
SELECT media_id, seq, previous_turn, next_turn, CASE WHEN found > 0 THEN substr(text, greatest(1, found - 500), found + length(claim) + 500 - greatest(1, found - 500)) ELSE substr(text, 1, 1000) END AS current_turn FROM a""")
def _(spark, sf):
    c = cues(spark, sf)
    claims = c.select("media_id", "seq", F.substring("text", 11, 40).alias("claim"))
    return S.local_context(claims, c).select("media_id", "seq", "previous_turn", "next_turn", "current_turn")


def right_side(spark, sf):
    return coarse(spark, sf).select("media_id", F.col("seq").alias("r_seq"), F.col("start_s").alias("r_start_s"), F.col("end_s").alias("r_end_s"), F.col("text").alias("r_text"))


J1_SQL = f"""WITH {CUES_SQL}, {COARSE_SQL}, near AS (
  SELECT l.media_id, l.seq, l.speaker, l.start_s, l.end_s, r.seq AS r_seq, r.start_s AS r_start_s, r.end_s AS r_end_s, r.text AS r_text, l.text,
    (r.end_s > l.start_s AND r.start_s < l.end_s) AS strict
  FROM cues l JOIN coarse r ON l.media_id = r.media_id AND r.end_s >= l.start_s - 3 AND r.start_s <= l.end_s + 3),
pairs AS (SELECT * FROM near n WHERE strict OR NOT EXISTS (SELECT 1 FROM near m WHERE m.media_id = n.media_id AND m.seq = n.seq AND m.strict))"""


@query("j1_interval_join", J1_SQL + " SELECT media_id, seq, r_seq, strict FROM pairs")
def _(spark, sf):
    return I.interval_join(cues(spark, sf), right_side(spark, sf)).select("media_id", "seq", "r_seq", "strict")


@query("j2_overlap_coverage", J1_SQL + """, cut AS (SELECT media_id, seq, start_s, end_s, r_seq, r_start_s, greatest(start_s, r_start_s) AS lo, least(end_s, r_end_s) AS hi FROM pairs),
w AS (SELECT *, max(CASE WHEN hi > lo THEN hi END) OVER (PARTITION BY media_id, seq ORDER BY lo, hi, r_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM cut)
SELECT media_id, seq, round(CASE WHEN max(end_s - start_s) > 0 THEN least(1, greatest(0, sum(CASE WHEN hi > lo THEN greatest(0, hi - greatest(lo, coalesce(seen, lo))) ELSE 0 END) / max(end_s - start_s)))
  ELSE max(CASE WHEN r_start_s = start_s THEN 1.0 ELSE 0.0 END) END, 6) AS coverage FROM w GROUP BY media_id, seq""")
def _(spark, sf):
    pairs = I.interval_join(cues(spark, sf), right_side(spark, sf))
    return I.overlap_coverage(pairs).select("media_id", "seq", F.round("coverage", 6).alias("coverage"))


def chapters(spark, sf):
    """Three turns make a chapter; the first of them names its speaker."""
    c = cues(spark, sf).withColumn("chapter_no", F.floor(F.col("seq") / 3))
    return c.groupBy("media_id", "chapter_no").agg((F.min("start_s") + 1.5).alias("c_start_s"), (F.max("end_s") + 1.5).alias("c_end_s"),
                                                   F.min_by("speaker", "seq").alias("c_speaker"))


CHAPTER_SQL = """chapters AS (SELECT media_id, seq // 3 AS chapter_no, min(start_s) + 1.5 AS c_start_s, max(end_s) + 1.5 AS c_end_s, arg_min(speaker, seq) AS c_speaker FROM cues GROUP BY media_id, seq // 3)"""
ASSIGN_SQL = f"""WITH {CUES_SQL}, {CHAPTER_SQL}, best AS (
  SELECT c.*, chapter_no, c_start_s, c_end_s, c_speaker FROM cues c LEFT JOIN chapters h ON c.media_id = h.media_id AND c_end_s > start_s AND c_start_s < end_s
  QUALIFY row_number() OVER (PARTITION BY c.media_id, c.seq ORDER BY least(end_s, c_end_s) - greatest(start_s, c_start_s) DESC, chapter_no) = 1)"""


@query("j3_assign_interval", ASSIGN_SQL + " SELECT media_id, seq, chapter_no FROM best")
def _(spark, sf):
    return I.assign_interval(cues(spark, sf), chapters(spark, sf)).select("media_id", "seq", "chapter_no")


@query("j4_infer_speaker", ASSIGN_SQL + f""", s AS (SELECT *, CASE WHEN c_speaker IS NULL THEN 'unknown' WHEN (abs(start_s - c_start_s) <= 8 OR abs(end_s - c_end_s) <= 8)
  AND (len(regexp_extract_all(text, '[A-Za-z]{{4,}}')) < 12 OR {D.has('text', R.TRANSITION)}) THEN 'boundary_uncertain' ELSE 'section_inferred' END AS speaker_status FROM best)
SELECT media_id, seq, c_speaker AS speaker, speaker_status, CASE speaker_status WHEN 'unknown' THEN 0.0 WHEN 'boundary_uncertain' THEN 0.45 ELSE 0.82 END::DOUBLE AS speaker_confidence FROM s""")
def _(spark, sf):
    return I.infer_speaker(cues(spark, sf), chapters(spark, sf)).select("media_id", "seq", "speaker", "speaker_status", "speaker_confidence")


def fused_base(spark, sf):
    pairs = I.interval_join(cues(spark, sf), right_side(spark, sf))
    ids = pairs.groupBy("media_id", "seq").agg(F.array_sort(F.collect_list("r_seq")).alias("matched_ids"))
    return cues(spark, sf).join(ids, ["media_id", "seq"], "left").withColumn(
        "matched_ids", F.coalesce("matched_ids", F.array().cast("array<bigint>"))).withColumn("review_reasons", X.empty())


FUSED_SQL = J1_SQL + """, ids AS (SELECT media_id, seq, list(r_seq ORDER BY r_seq) AS matched_ids FROM pairs GROUP BY media_id, seq),
fused AS (SELECT c.*, coalesce(matched_ids, []) AS matched_ids FROM cues c LEFT JOIN ids USING (media_id, seq)),
nb AS (SELECT *, lead(speaker) OVER w AS n_speaker, lead(matched_ids) OVER w AS n_ids, lead(text) OVER w AS n_text, lag(speaker) OVER w AS p_speaker, lag(matched_ids) OVER w AS p_ids FROM fused WINDOW w AS (PARTITION BY media_id ORDER BY seq))"""


@query("w10_adjacent_diagnostics", FUSED_SQL + f""" SELECT media_id, count(*) AS n_pairs, round(avg(CASE WHEN {D.norm('text')} = {D.norm('n_text')} AND {D.norm('text')} <> '' THEN 1.0 ELSE 0.0 END), 4) AS exact_rate,
  count(*) FILTER (speaker <> n_speaker AND list_has_any(matched_ids, n_ids)) AS cross_speaker_boundaries FROM nb WHERE n_text IS NOT NULL GROUP BY media_id""")
def _(spark, sf):
    out = S.adjacent_diagnostics(fused_base(spark, sf), partial=False)
    return out.select("media_id", "n_pairs", "exact_rate", "cross_speaker_boundaries")


@query("w10_partial_rate")
def _(spark, sf):
    return S.adjacent_diagnostics(fused_base(spark, sf)).select("media_id", "n_pairs", "partial_rate")


@query("w11_speaker_boundaries", FUSED_SQL + """ SELECT media_id, seq, (coalesce(speaker <> n_speaker AND list_has_any(matched_ids, n_ids), false) OR coalesce(speaker <> p_speaker AND list_has_any(matched_ids, p_ids), false)) AS flagged FROM nb""")
def _(spark, sf):
    return S.flag_speaker_boundaries(fused_base(spark, sf)).select("media_id", "seq", (F.size("review_reasons") > 0).alias("flagged"))


@query("w12_flag_reuse", FUSED_SQL + """, use AS (SELECT media_id, seq, speaker, unnest(matched_ids) AS id FROM fused), shared AS (SELECT media_id, id FROM use GROUP BY media_id, id HAVING count(DISTINCT speaker) > 1)
SELECT f.media_id, f.seq, count(s.id) AS n_reused FROM fused f LEFT JOIN use u USING (media_id, seq) LEFT JOIN shared s ON s.media_id = u.media_id AND s.id = u.id GROUP BY f.media_id, f.seq""")
def _(spark, sf):
    return S.flag_reuse(fused_base(spark, sf)).select("media_id", "seq", F.col("n_reused").cast("long").alias("n_reused"))


@query("w13_target_window", f"""WITH {CUES_SQL}, items AS (SELECT media_id, seq AS item_id, start_s + 400 * (seq % 2) AS start_s, end_s + 400 * (seq % 2) AS end_s FROM cues),
near AS (SELECT i.media_id, i.item_id, c.seq AS cue_seq, false AS fallback FROM items i JOIN cues c ON c.media_id = i.media_id AND c.start_s BETWEEN i.start_s - 45 AND i.end_s + 45)
SELECT * FROM near UNION ALL SELECT i.media_id, i.item_id, arg_min(c.seq, (abs(c.start_s - i.start_s), c.start_s, c.seq)) AS cue_seq, true AS fallback FROM items i JOIN cues c ON c.media_id = i.media_id
WHERE NOT EXISTS (SELECT 1 FROM near n WHERE n.media_id = i.media_id AND n.item_id = i.item_id) GROUP BY i.media_id, i.item_id""")
def _(spark, sf):
    c = cues(spark, sf)
    shift = 400 * (F.col("seq") % 2)
    items = c.select("media_id", F.col("seq").alias("item_id"), (F.col("start_s") + shift).alias("start_s"), (F.col("end_s") + shift).alias("end_s"))
    return S.target_window(items, c.select("media_id", F.col("seq").alias("cue_seq"), F.col("start_s").alias("cue_start_s")))


@query("j5_candidate_spans")
def _(spark, sf):
    s = coarse(spark, sf).select("media_id", "seq", "start_s", "end_s", "text")
    u = units(spark, sf).select("media_id", "unit_idx", "unit_start_s", "unit_end_s", "unit_text", "char_start", "char_end")
    return I.candidate_spans(s, u).select("media_id", "seq", "rank", "run_start", "unit_end", "lexical", "time_prior", F.round("prelim", 6).alias("prelim"))


@query("j13_units_in_ranges", f"""WITH {CUES_SQL}, u AS (SELECT media_id, seq, (sum(length(text) + 1) OVER w - length(text) - 1)::BIGINT AS u_start, (sum(length(text) + 1) OVER w - 1)::BIGINT AS u_end FROM cues WINDOW w AS (PARTITION BY media_id ORDER BY seq)),
r AS (SELECT media_id, seq // 2 AS range_no, min(u_start) + 7 AS char_start, max(u_end) + 7 AS char_end FROM u GROUP BY media_id, seq // 2)
SELECT r.media_id, range_no, seq FROM r JOIN u ON u.media_id = r.media_id AND u_end > char_start AND u_start < char_end""")
def _(spark, sf):
    from evidence_spark.operators.scan import scan

    c = scan(cues(spark, sf), ["media_id"], ["seq"], sums_before={"u_start": F.length("text") + 1}).withColumn("u_end", F.col("u_start") + F.length("text"))
    u = c.select("media_id", "seq", "u_start", "u_end")
    r = u.groupBy("media_id", F.floor(F.col("seq") / 2).alias("range_no")).agg((F.min("u_start") + 7).alias("char_start"), (F.max("u_end") + 7).alias("char_end"))
    return I.units_in_ranges(r, u).select("media_id", "range_no", "seq")
