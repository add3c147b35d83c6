"""Transcript texts to cues. ``docs`` has ``media_id, content``: one whole text per row.

A text is cut at its cue headers inside the row (a marker goes in front of every header and the text
is split there), so parsing needs no shuffle and a recording with many files is many rows.
"""

from __future__ import annotations

from html import unescape as plain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.functions.keys import to_seconds
from evidence_spark.functions.text import squeeze, strip
from evidence_spark.operators.scan import islands, scan
from evidence_spark.session import cut

# fixed values: stamps and header shapes
STAMP = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
RANGE = rf"(?:\[)?({STAMP})\s*(?:-|–|—|--> )\s*({STAMP})(?:\])?"
CAPTION_RANGE = r"(\d{1,2}:\d{2}(?::\d{2})?[.,]\d+)\s*-->\s*(\d{1,2}:\d{2}(?::\d{2})?[.,]\d+)"
VOICE = r"(?i)<v(?:\.[^ >]+)?\s+([^>]+)>"
TAG = r"<[^>]+>"
LINK_STAMP = r"\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?"
LINKED_SHAPES = [
    rf"(?i)^\s*(?:#{{1,6}}\s*)?(?:\[)?({LINK_STAMP})\s*(?:-|–|—|-->|to)\s*({LINK_STAMP})(?:\])?(?:\([^)]*\))?\s*(.*)$",
    rf"^\s*(?:#{{1,6}}\s*)?\[\[({LINK_STAMP})\]\](?:\([^)]*\))?\s*(?:[-–—|:])?()\s*(.*)$",
    rf"^\s*(?:#{{1,6}}\s*)?\[({LINK_STAMP})\](?:\([^)]*\))?\s*(?:[-–—|:])?()\s*(.*)$",
    rf"^\s*(?:#{{1,6}}\s*)?({LINK_STAMP})\s*(?:[-–—|:])?()\s*(.*)$",
]
CHAPTER_RANGE = r"^(\d{1,2}:\d{2}(?::\d{2})?)\s*-\s*(\d{1,2}:\d{2}(?::\d{2})?)$"
CHAPTER_HEADING = r"^####\s+(.+?)\s*$"
SPEAKER_STAMP = r"^(.+?)(\d{1,2}:\d{2}(?::\d{2})?)$"
REFERENCE_URL = r"\s*\((https?://[^)\s]+)\)\s*$"
RAW_CUE = r"^\s*\[\[(\d{1,2}:\d{2}(?::\d{2})?)\]\]\((https?://[^)]+)\)\s*$"

MARK = "\u0001"


def lines_of(c: Column) -> Column:
    return F.split(F.regexp_replace(c, "﻿", ""), r"\R")


def unescape(c: Column) -> Column:
    """HTML entities to characters (the standard library's table, in Arrow batches)."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: plain(v) if v is not None and "&" in v else v)

    return run(c)


def _trim_any(c: Column, chars: str) -> Column:
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def _chunks(lines: Column, is_header) -> Column:
    """Array of arrays: each header line with the lines after it; lines before the first header are dropped."""
    marked = F.array_join(F.transform(lines, lambda l: F.when(is_header(l), F.concat(F.lit(MARK), l)).otherwise(l)), "\n")
    pieces = F.split(marked, MARK)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: F.split(p, "\n"))


def _open_cues(cues: Column, last_end: Column, only_equal: bool = False) -> Column:
    """Close cues of one text inside the row by the next cue's start."""
    def close(c, i):
        nxt = F.get(cues, i + 1)
        if only_equal:
            end = F.when(c["end_s"] == c["start_s"], F.greatest(c["start_s"], F.coalesce(nxt["start_s"], c["start_s"] + 15.0))).otherwise(c["end_s"])
        else:
            end = F.coalesce(c["end_s"], nxt["start_s"], last_end)
        return c.withField("end_s", end)

    return F.transform(cues, close)


def _explode(docs: DataFrame, cues: Column, fields: list[str]) -> DataFrame:
    rows = docs.withColumn("_cues", cues).select("media_id", F.posexplode("_cues").alias("seq", "_c"))
    rows = rows.select("media_id", "seq", *[F.col("_c." + f).alias(f) for f in fields])
    return rows.withColumn("bad_interval", F.col("end_s").isNull() | (F.col("end_s") < F.col("start_s")))


def cues_from_markdown(docs: DataFrame) -> DataFrame:
    """``## [start-end] Speaker | Section`` headers own the lines below; ``[t] Speaker: text`` cues end at the next start."""
    body = F.filter(F.transform(lines_of(F.col("content")), strip), lambda l: l != "")
    bare = lambda l: strip(F.regexp_replace(l, "^[# ]+", ""))
    is_header = lambda l: bare(l).rlike(RANGE) | bare(l).rlike(rf"^(?:\[)?{STAMP}")

    def cue(chunk):
        head = bare(F.element_at(chunk, 1))
        ranged = head.rlike(RANGE)
        edge = r" \[\]|\-–—"
        full = rf"(?s)^(.*?){RANGE}(.*)$"
        after, before = _trim_any(F.regexp_extract(head, full, 4), edge), _trim_any(F.regexp_extract(head, full, 1), edge)
        named = F.coalesce(F.nullif(after, F.lit("")), F.nullif(before, F.lit("")), F.lit("unknown"))
        split_at = F.split(named, r"\|", 2)
        inline = rf"(?s)^(?:\[)?({STAMP})(?:\])?(.*)$"
        rest = _trim_any(F.regexp_extract(head, inline, 2), r" :\-|–—")
        talk = F.split(rest, ":", 2)
        has_colon = F.contains(rest, F.lit(":"))
        start = F.when(ranged, to_seconds(F.regexp_extract(head, RANGE, 1))).otherwise(to_seconds(F.regexp_extract(head, inline, 1)))
        end = F.when(ranged, to_seconds(F.regexp_extract(head, RANGE, 2))).otherwise(start)
        speaker = F.when(ranged, strip(F.element_at(split_at, 1))).when(has_colon, strip(F.element_at(talk, 1))).otherwise("unknown")
        own = F.when(ranged, F.lit("")).when(has_colon, strip(F.element_at(talk, 2))).otherwise(rest)
        lines = F.concat(F.array(own), F.slice(chunk, F.lit(2), F.size(chunk)))
        return F.struct(
            start.alias("start_s"), end.alias("end_s"), squeeze(F.array_join(lines, " ")).alias("text"),
            F.coalesce(F.nullif(speaker, F.lit("")), F.lit("unknown")).alias("speaker"),
            F.when(ranged & (F.size(split_at) > 1), F.nullif(strip(F.try_element_at(split_at, F.lit(2))), F.lit(""))).alias("section"))

    rows = docs.withColumn("_parsed", F.transform(_chunks(body, is_header), cue))
    rows = rows.withColumn("_kept", F.filter("_parsed", lambda c: c["text"] != ""))
    return _explode(rows, _open_cues(F.col("_kept"), F.lit(None).cast("double"), only_equal=True), ["start_s", "end_s", "text", "speaker", "section"])


def cues_from_captions(docs: DataFrame, collapse: bool = True) -> DataFrame:
    """VTT/SRT cues: a range line and the lines up to a blank one; voice tags name speakers, other tags go."""
    from evidence_spark.operators.sequence import collapse_repeats

    text = F.regexp_replace(F.regexp_replace(F.col("content"), "﻿", ""), r"\R", "\n")
    paragraphs = F.split(text, r"\n[\s&&[^\n]]*(?=\n)")
    rows = docs.select("media_id", F.posexplode(paragraphs).alias("seq", "_p"))
    rows = rows.withColumn("_lines", F.filter(F.split("_p", "\n"), lambda l: strip(l) != ""))
    rows = rows.withColumn("_at", F.array_position(F.transform("_lines", lambda l: l.rlike(CAPTION_RANGE)), True)).where("_at > 0")
    head = F.element_at("_lines", F.col("_at").cast("int"))
    raw = F.array_join(F.transform(F.slice("_lines", F.col("_at").cast("int") + 1, F.size("_lines")), strip), " ")
    rows = rows.withColumn("_head", head).withColumn("_raw", raw)
    voice = F.regexp_extract("_raw", VOICE, 1)
    rows = rows.select(
        "media_id", "seq", to_seconds(F.regexp_extract("_head", CAPTION_RANGE, 1)).alias("start_s"),
        to_seconds(F.regexp_extract("_head", CAPTION_RANGE, 2)).alias("end_s"),
        squeeze(unescape(F.regexp_replace("_raw", TAG, ""))).alias("text"),
        F.when(voice != "", unescape(strip(voice))).otherwise("unknown").alias("speaker")).where("text <> ''")
    if not collapse:
        return rows
    return collapse_repeats(rows).withColumnRenamed("island", "seq").drop("n_rows")


def cues_from_linked_text(docs: DataFrame, durations: DataFrame | None = None) -> DataFrame:
    """Text-only cues in four header shapes; end is explicit, else the next start, else the media duration.

    A cue that stays open has a NULL end and ``bad_interval``.
    """
    body = F.filter(F.transform(lines_of(F.col("content")), strip), lambda l: l != "")
    any_shape = lambda l: l.rlike("|".join(f"(?:{s})" for s in [LINKED_SHAPES[0].replace("(?i)", "(?i:", 1) + ")", *LINKED_SHAPES[1:]]))

    def part(l, group):
        out = F.lit(None).cast("string")
        for shape in reversed(LINKED_SHAPES):
            out = F.when(l.rlike(shape), F.regexp_extract(l, shape, group)).otherwise(out)
        return out

    def cue(chunk):
        head = F.element_at(chunk, 1)
        lines = F.concat(F.array(strip(part(head, 3))), F.filter(F.slice(chunk, F.lit(2), F.size(chunk)), lambda l: ~l.rlike("^#{1,3} ")))
        return F.struct(
            to_seconds(part(head, 1)).alias("start_s"), to_seconds(F.nullif(part(head, 2), F.lit(""))).alias("end_s"),
            strip(F.array_join(F.filter(lines, lambda l: l != ""), " ")).alias("text"), F.lit(None).cast("string").alias("speaker"))

    rows = docs.withColumn("_chunks", _chunks(body, any_shape))
    rows = rows.join(durations, "media_id", "left") if durations is not None else rows.withColumn("duration_s", F.lit(None).cast("double"))
    rows = rows.withColumn("_parsed", F.transform("_chunks", cue))
    return _explode(rows, _open_cues(F.col("_parsed"), F.col("duration_s")), ["start_s", "end_s", "text", "speaker"])


def turns_from_chaptered_text(docs: DataFrame, ui_lines: list[str], not_speakers: list[str]) -> DataFrame:
    """Chaptered turns: the n-th range line pairs with the n-th heading that has a range waiting.

    A line that ends in a time stamp starts a turn; its body lines are joined without a separator; the end is the
    next start in the chapter, else the chapter end. Empty bodies stay. ``ui_lines`` and ``not_speakers`` are page furniture.
    """
    rows = docs.select("media_id", F.posexplode(lines_of(F.col("content"))).alias("line_no", "raw")).withColumn("line", strip("raw"))
    keys, order = ["media_id"], ["line_no"]
    rows = rows.withColumn("is_range", F.col("line").rlike(CHAPTER_RANGE)).withColumn("is_heading", F.col("line").rlike(CHAPTER_HEADING))
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    rows = scan(rows, keys, order, sums={"n_range": one(F.col("is_range")), "n_head": one(F.col("is_heading"))})
    # headings beyond the ranges seen so far are plain lines; the deficit is the running maximum of that surplus
    surplus = F.when(F.col("is_heading"), F.greatest(F.lit(0), F.col("n_head") - F.col("n_range")))
    # chained scans read their input twice each, so cut here
    rows = cut(scan(rows, keys, order, maxes={"_before": surplus}).withColumn("_before", F.coalesce("_before", F.lit(0))))
    deficit = F.greatest(F.col("_before"), F.coalesce(surplus, F.lit(0)))
    rows = rows.withColumn("chapter_index", F.col("n_head") - deficit).withColumn("opens", F.col("is_heading") & (deficit == F.col("_before")))
    named = strip(F.regexp_extract("line", SPEAKER_STAMP, 1))
    is_turn = ~F.col("is_range") & ~F.col("opens") & F.col("line").rlike(SPEAKER_STAMP) & (named != "") & ~named.isin(*(not_speakers or [""])) & (F.col("chapter_index") > 0)
    rows = rows.withColumn("is_turn", is_turn)
    rows = islands(rows, keys, order, F.col("is_turn") | F.col("is_range"), "piece")
    furniture = F.col("line").isin("", *ui_lines) | F.col("is_heading") | F.col("is_turn")
    spoken = F.when(~furniture, F.struct("line_no", F.col("line").alias("t")))
    turns = rows.groupBy("media_id", "piece").agg(
        F.max(F.when(F.col("is_turn"), F.struct("line_no", "line"))).alias("_t"), F.max("chapter_index").alias("chapter_index"),
        F.array_join(F.transform(F.array_sort(F.collect_list(spoken)), lambda s: s["t"]), "").alias("text")).where("_t is not null")
    heads = rows.where("opens").select("media_id", "chapter_index", F.regexp_extract("line", CHAPTER_HEADING, 1).alias("_title"))
    ranges = rows.where("is_range").select("media_id", F.col("n_range").alias("chapter_index"),
                                           to_seconds(F.regexp_extract("line", CHAPTER_RANGE, 1)).alias("chapter_start_s"),
                                           to_seconds(F.regexp_extract("line", CHAPTER_RANGE, 2)).alias("chapter_end_s"))
    chapters = heads.join(ranges, ["media_id", "chapter_index"])
    full = turns.join(chapters, ["media_id", "chapter_index"]).select(
        "media_id", F.col("_t.line_no").alias("line_no"), strip(F.regexp_extract("_t.line", SPEAKER_STAMP, 1)).alias("speaker"),
        to_seconds(F.regexp_extract("_t.line", SPEAKER_STAMP, 2)).alias("start_s"), "text", "chapter_index",
        strip(F.regexp_replace("_title", REFERENCE_URL, "")).alias("chapter"), F.nullif(F.regexp_extract("_title", REFERENCE_URL, 1), F.lit("")).alias("reference_url"),
        "chapter_start_s", "chapter_end_s")
    full = scan(full, keys, order, sums={"seq": F.lit(1).cast("long")}, leads={"_n": F.struct("start_s", "chapter_index")})
    end = F.when(F.col("_n.chapter_index") == F.col("chapter_index"), F.col("_n.start_s")).otherwise(F.col("chapter_end_s"))
    return full.withColumn("end_s", end).withColumn("bad_interval", F.col("end_s") < F.col("start_s")).drop("_n", "line_no")


def index_sections(cues: DataFrame) -> DataFrame:
    """Number sections by first appearance; the literal speaker "unknown" becomes NULL."""
    first = cues.where("section is not null").groupBy("media_id", "section").agg(F.min("seq").alias("_first"))
    ranked = scan(first, ["media_id"], ["_first"], sums={"chapter_index": F.lit(1)}).drop("_first")
    speaker = F.when(F.lower("speaker") != "unknown", F.col("speaker"))
    return cues.withColumn("speaker", speaker).join(ranked, ["media_id", "section"], "left")


def raw_cues(docs: DataFrame) -> DataFrame:
    """Cue spans in the raw text: from one match to the next, the body trimmed of line ends."""
    pattern = "(?m)" + RAW_CUE
    # lengths of the text before each cue: split at the cues with everything kept
    parts = F.split(F.regexp_replace("content", pattern, MARK + "$0" + MARK), MARK)
    rows = docs.withColumn("_parts", parts)
    begin = F.aggregate("_parts", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    rows = rows.withColumn("_begin", begin).select("media_id", "_begin", F.col("_parts"), F.posexplode("_parts").alias("_i", "_head")).where("_i % 2 = 1")
    body = F.get(F.col("_parts"), F.col("_i") + 1)
    at = F.get(F.col("_begin"), F.col("_i") + 1)
    lead = F.length(body) - F.length(F.regexp_replace(body, r"^[\r\n]+", ""))
    kept = F.regexp_replace(F.regexp_replace(body, r"^[\r\n]+", ""), r"[\r\n]+$", "")
    return rows.select(
        "media_id", ((F.col("_i") - 1) / 2).cast("long").alias("seq"), to_seconds(F.regexp_extract("_head", pattern, 1)).alias("start_s"),
        F.get(F.col("_begin"), F.col("_i")).alias("raw_start"), (at + F.length(body)).alias("raw_end"),
        (at + lead).alias("text_start"), (at + lead + F.length(kept)).alias("text_end"), kept.alias("text"))


def map_raw_ranges(units: DataFrame, cues: DataFrame) -> DataFrame:
    """Units back to characters of the raw text, through the place of the segment text inside its cue.

    ``units`` has ``media_id, seq, segment_text, local_start, local_end``; ``cues`` comes from :func:`raw_cues`.
    """
    spans = cues.select("media_id", "seq", "text_start", F.col("text").alias("_cue_text"))
    rows = units.join(spans, ["media_id", "seq"])
    at = F.greatest(F.instr("_cue_text", F.col("segment_text")), F.lit(1)) - 1
    return rows.withColumn("raw_char_start", F.col("text_start") + at + F.col("local_start")).withColumn(
        "raw_char_end", F.col("text_start") + at + F.col("local_end")).withColumn(
        "raw_mapping_exact", F.instr("_cue_text", F.col("segment_text")) > 0).drop("_cue_text", "text_start")
