"""Queries for sources: texts derived from the test tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import keys as K
from evidence_spark.functions import text as X
from evidence_spark.operators import sequence as S
from evidence_spark.plans import duck as D
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import CUES_SQL, cues, joined, table
from evidence_spark.sources import html as H
from evidence_spark.sources import tables as B
from evidence_spark.sources import transcripts as P


def _render(spark, sf, line, sep="\n"):
    """One text per recording, written from its turns."""
    c = cues(spark, sf).withColumn("flat", X.squeeze("text"))
    rows = c.select("media_id", "seq", line(c).alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda r: r["line"]), sep)
    return rows.groupBy("media_id").agg(text.alias("content"))


FLAT = D.strip(f"regexp_replace(text, $q${D.WS}+$q$, ' ', 'g')")


@query("s3_cues_from_markdown", f"""WITH {CUES_SQL} SELECT media_id, seq, floor(start_s)::DOUBLE AS start_s, floor(end_s)::DOUBLE + 1 AS end_s, speaker, 'Part ' || (seq // 2) AS section, {FLAT} AS text FROM cues""")
def _(spark, sf):
    docs = _render(spark, sf, lambda c: F.concat(
        F.lit("## ["), K.to_stamp("start_s"), F.lit("-"), K.to_stamp(F.floor("end_s") + 1), F.lit("] "), F.col("speaker"), F.lit(" | Part "),
        F.floor(F.col("seq") / 2).cast("string"), F.lit("\n\n"), F.col("flat"), F.lit("\n")))
    return P.cues_from_markdown(docs).select("media_id", F.col("seq").cast("long").alias("seq"), "start_s", "end_s", "speaker", "section", "text")


@query("s4_cues_from_captions", f"""WITH {CUES_SQL}, f AS (SELECT media_id, seq, floor(start_s) AS s, floor(end_s) + 1 AS e, speaker, {FLAT} AS text FROM cues),
p AS (SELECT *, CASE WHEN lag(text) OVER w = text AND lag(speaker) OVER w = speaker THEN 0 ELSE 1 END AS new FROM f WINDOW w AS (PARTITION BY media_id ORDER BY seq)),
i AS (SELECT *, sum(new) OVER (PARTITION BY media_id ORDER BY seq) AS island FROM p)
SELECT media_id, island::BIGINT AS seq, min(s)::DOUBLE AS start_s, max(e)::DOUBLE AS end_s, any_value(speaker) AS speaker, any_value(text) AS text FROM i GROUP BY media_id, island""")
def _(spark, sf):
    stamp = lambda c: F.concat(F.when(F.floor(c) < 3600, F.lit("00:")).otherwise(F.lit("")), K.to_stamp(c), F.lit(".000"))
    docs = _render(spark, sf, lambda c: F.concat(
        stamp(F.col("start_s")), F.lit(" --> "), stamp(F.floor("end_s") + 1), F.lit("\n<v "), F.col("speaker"), F.lit("><c>"),
        F.regexp_replace(F.regexp_replace("flat", "&", "&amp;"), "<", "&lt;"), F.lit("</c></v>\n")))
    docs = docs.withColumn("content", F.concat(F.lit("WEBVTT\n\n"), "content"))
    out = P.cues_from_captions(docs)
    return out.select("media_id", F.col("seq").cast("long").alias("seq"), "start_s", "end_s", "speaker", "text")


@query("s5_turns_from_chaptered_text", f"""WITH {CUES_SQL}, ch AS (SELECT media_id, seq // 3 AS ch, floor(max(end_s)) + 1 AS ce FROM cues GROUP BY 1, 2)
SELECT c.media_id, seq + 1 AS seq, speaker, floor(start_s)::DOUBLE AS start_s, CASE WHEN lead(seq // 3) OVER w = seq // 3 THEN lead(floor(start_s)) OVER w ELSE ce END::DOUBLE AS end_s,
  seq // 3 + 1 AS chapter_index, 'Title ' || (seq // 3) AS chapter, {FLAT} AS text
FROM cues c JOIN ch ON ch.media_id = c.media_id AND ch.ch = seq // 3 WINDOW w AS (PARTITION BY c.media_id ORDER BY seq)""")
def _(spark, sf):
    c = cues(spark, sf)
    minute = lambda s: F.concat(F.floor(s / 60).cast("long").cast("string"), F.lit(":"), F.lpad((F.floor(s) % 60).cast("long").cast("string"), 2, "0"))
    ch = c.groupBy("media_id", F.floor(F.col("seq") / 3).alias("ch")).agg(F.floor(F.min("start_s")).alias("cs"), (F.floor(F.max("end_s")) + 1).alias("ce"))
    rows = c.withColumn("ch", F.floor(F.col("seq") / 3)).join(ch, ["media_id", "ch"]).withColumn("flat", X.squeeze("text"))
    head = F.when(F.col("seq") % 3 == 0, F.concat(minute(F.col("cs")), F.lit(" - "), minute(F.col("ce")), F.lit("\n#### Title "), F.col("ch").cast("string"), F.lit("\n\n"))).otherwise("")
    rows = rows.select("media_id", "seq", F.concat(head, F.col("speaker"), minute(F.col("start_s")), F.lit("\nJump\n"), F.col("flat"), F.lit("\n")).alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda r: r["line"]), "\n")
    out = P.turns_from_chaptered_text(rows.groupBy("media_id").agg(text.alias("content")), ["Jump"], [])
    return out.select("media_id", "seq", "speaker", "start_s", "end_s", F.col("chapter_index").cast("long").alias("chapter_index"), "chapter", "text")


def linked_docs(spark, sf):
    return _render(spark, sf, lambda c: F.concat(
        F.lit("[["), K.to_stamp("start_s"), F.lit("]](https://example.org/v?t="), F.floor("start_s").cast("string"), F.lit(")\n\n"), F.col("flat"), F.lit("\n")))


@query("s6_cues_from_linked_text", f"""WITH {CUES_SQL} SELECT media_id, seq, floor(start_s)::DOUBLE AS start_s, coalesce(lead(floor(start_s)) OVER w, ceil(max(end_s) OVER (PARTITION BY media_id)))::DOUBLE AS end_s, {FLAT} AS text
FROM cues WINDOW w AS (PARTITION BY media_id ORDER BY seq)""")
def _(spark, sf):
    durations = cues(spark, sf).groupBy("media_id").agg(F.ceil(F.max("end_s")).cast("double").alias("duration_s"))
    out = P.cues_from_linked_text(linked_docs(spark, sf), durations)
    return out.select("media_id", F.col("seq").cast("long").alias("seq"), "start_s", "end_s", "text")


@query("s7_index_sections", f"""WITH {CUES_SQL}, s AS (SELECT *, 'len' || (length(text) % 4) AS section FROM cues), f AS (SELECT media_id, section, min(seq) AS first FROM s GROUP BY 1, 2)
SELECT s.media_id, s.seq, CASE WHEN speaker <> 'system' THEN speaker END AS speaker, r.rank AS chapter_index FROM s JOIN (SELECT *, row_number() OVER (PARTITION BY media_id ORDER BY first) AS rank FROM f) r USING (media_id, section)""")
def _(spark, sf):
    c = cues(spark, sf).withColumn("section", F.concat(F.lit("len"), (F.length("text") % 4).cast("string")))
    c = c.withColumn("speaker", F.when(F.col("speaker") == "system", "Unknown").otherwise(F.col("speaker")))
    return P.index_sections(c).select("media_id", "seq", "speaker", F.col("chapter_index").cast("long").alias("chapter_index"))


def page_turns(spark, sf):
    pages = table(spark, sf, "pages").withColumnRenamed("page_id", "source_id")
    aliases = table(spark, sf, "conversations").select(F.col("role").alias("alias"), F.col("role").alias("speaker")).distinct()
    return H.turns_from_html(pages, aliases)


@query("s8_turns_from_html")
def _(spark, sf):
    return page_turns(spark, sf)


@query("s8_html_blocks", r"""WITH b AS (SELECT page_id AS source_id, unnest(regexp_extract_all(html, '(?is)<(?:h2\b[^>]*>.*?</h2>|h3\b[^>]*>.*?</h3>|p\b[^>]*>.*?</p>)')) AS b FROM pages)
SELECT source_id, count(*) AS n_blocks, sum(length(b))::BIGINT AS n_chars FROM b WHERE trim(regexp_replace(regexp_replace(b, '(?s)<[^>]+>', '', 'g'), '\s+', ' ', 'g')) <> '' GROUP BY source_id""")
def _(spark, sf):
    pages = table(spark, sf, "pages").withColumnRenamed("page_id", "source_id")
    return H.html_blocks(pages).groupBy("source_id").agg(F.count("*").alias("n_blocks"), F.sum(F.col("char_end") - F.col("char_start")).alias("n_chars"))


@query("s9_map_raw_ranges")
def _(spark, sf):
    docs = linked_docs(spark, sf)
    raw = P.raw_cues(docs)
    seg = P.cues_from_linked_text(docs).select("media_id", F.col("seq").cast("long").alias("seq"), "text")
    units = S.semantic_units(seg).withColumnRenamed("text", "segment_text")
    out = P.map_raw_ranges(units, raw).join(docs, "media_id")
    # the mapped range must give the unit back
    same = F.substring(F.col("content"), F.col("raw_char_start") + 1, F.col("raw_char_end") - F.col("raw_char_start")) == F.col("unit_text")
    return out.select("media_id", "seq", "unit_no", "raw_char_start", "raw_char_end", "raw_mapping_exact", same.alias("same_text"))


def source_checks(spark, sf):
    """Each recording offers one provider per turn; the status follows from the text length."""
    providers = F.array(*[F.lit(p) for p in B.PRIORITY])
    n = F.length("text")
    status = F.when(n % 5 == 0, "ready").when(n % 5 == 1, "url_only").when(n % 5 == 2, "failed").otherwise("not_configured")
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("media_id"), F.element_at(providers, (F.col("turn") % 5 + 1).cast("int")).alias("provider"), status.alias("status"))


_CHECKS = """WITH k AS (SELECT conv_id AS media_id, turn % 5 + 1 AS prio, ['official_transcript', 'ulisten', 'usetranscribe', 'manual_markdown', 'youtube_export'][turn % 5 + 1] AS provider,
  CASE length(text) % 5 WHEN 0 THEN 'ready' WHEN 1 THEN 'url_only' WHEN 2 THEN 'failed' ELSE 'not_configured' END AS status FROM conversations)"""


@query("s11_select_source", _CHECKS + """ SELECT media_id, arg_min(provider, prio) FILTER (status = 'ready') AS provider,
  CASE WHEN bool_or(status = 'ready') THEN 'selected' WHEN bool_or(status = 'url_only') THEN 'url_only' ELSE 'unresolved' END AS resolution,
  CASE WHEN NOT bool_or(status = 'ready') THEN arg_min(provider, prio) FILTER (status = 'url_only') END AS url_provider FROM k GROUP BY media_id""")
def _(spark, sf):
    return B.select_source(source_checks(spark, sf))


@query("s12_resolve_mode", """WITH r AS (SELECT conv_id AS media_id, bool_or(length(text) % 3 = 0) AS s, bool_or(length(text) % 3 = 1) AS t, bool_or(length(text) % 3 = 2 AND length(text) % 2 = 0) AS o FROM conversations GROUP BY conv_id)
SELECT media_id, CASE WHEN s AND o THEN 'official_dual' WHEN s AND t THEN 'dual_source' WHEN o THEN 'official_single' WHEN t THEN 'text_single' WHEN s THEN 'structure_degraded' ELSE 'failed' END AS mode,
  CASE WHEN s THEN 'structure' WHEN o THEN 'official' WHEN t THEN 'text_timeline' END AS structure_source, CASE WHEN o THEN 'official' WHEN t THEN 'text' WHEN s THEN 'structure' END AS text_source,
  CASE WHEN o AND t THEN 'text' ELSE '' END AS unused FROM r""")
def _(spark, sf):
    n = F.length("text")
    role = F.when(n % 3 == 0, "structure").when(n % 3 == 1, "text").when(n % 2 == 0, "official").otherwise("none")
    src = table(spark, sf, "conversations").select(F.col("conv_id").alias("media_id"), role.alias("role"))
    out = B.resolve_mode(src)
    return out.select("media_id", "mode", "structure_source", "text_source", joined(F.col("unused")).alias("unused"))


def _incoming(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("source_id"), K.content_hash("text").alias("content_hash"))
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("source_id"), "toxic", "quality").join(d, "source_id")
    # a document labelled toxic was frozen with other content
    known = known.select("source_id", F.when(F.col("toxic") == 1, F.lit("old")).otherwise(F.col("content_hash")).alias("content_hash"))
    return d, known


@query("s14_ingest_increment", """SELECT d.doc_id AS source_id, CASE WHEN l.doc_id IS NULL THEN 'process' ELSE 'conflict' END AS outcome FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.toxic = 1""")
def _(spark, sf):
    d, known = _incoming(spark, sf)
    todo, bad = B.ingest_increment(d, known)
    return todo.select("source_id", F.lit("process").alias("outcome")).unionByName(bad.select("source_id", F.lit("conflict").alias("outcome")))


@query("s14_cursor", """SELECT max_by(doc_id, (n_chars, doc_id)) AS newest, min_by(doc_id, (n_chars, doc_id)) AS oldest, count(*) AS n_processed FROM documents""")
def _(spark, sf):
    return B.cursor(table(spark, sf, "documents"), "n_chars", "doc_id")


@query("s15_diff_snapshot", """SELECT d.doc_id::VARCHAR AS path, CASE WHEN l.toxic = 1 THEN 'changed' ELSE 'extra' END AS drift FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.toxic = 1""")
def _(spark, sf):
    d, known = _incoming(spark, sf)
    shape = lambda x: x.select(F.col("source_id").cast("string").alias("path"), F.col("content_hash").alias("sha256"))
    return B.diff_snapshot(shape(known), shape(d))
