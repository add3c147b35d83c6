"""Projections between transcript rows, evidence rows and canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.functions import keys as K
from evidence_spark.functions import text as X
from evidence_spark.operators import lineage as L


def evidence_rows(chunks: DataFrame, url: str = "media_url") -> DataFrame:
    """Evidence with a time stamp, a deep link, a short quote and an honest speaker confidence."""
    known = F.col("speaker").isNotNull() & (F.lower("speaker") != "unknown") & (F.col("speaker") != "")
    conf = F.when(known, F.lit(0.75)).otherwise(F.lit(0.0))
    return chunks.select(
        "*", K.to_stamp("start_s").alias("stamp"), K.deep_link(url, "start_s").alias("url"),
        K.short_quote("text").alias("quote"), conf.alias("speaker_confidence"),
        F.when(known, F.lit("manual_label")).otherwise(F.lit("unknown")).alias("attribution_method"),
        (conf < 0.8).alias("needs_review"),
    )


def canonical_records(fused: DataFrame, mode: str, url: str = "media_url") -> DataFrame:
    """Fill ids, links, statuses, quote permission, source ranges and source hashes; the input keeps all its other columns.

    Optional columns that the input lacks count as NULL. Rows without ranges that know their place in a second source
    (``secondary_char_start``, ``secondary_char_end``) get that as a projected range.
    """
    have = set(fused.columns)
    get = lambda name, kind: F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
    speaker = get("speaker", "string")
    status = F.coalesce(get("speaker_status", "string"), F.when(speaker.isNotNull() & (speaker != ""), "source_provided").otherwise("unknown"))
    confidence = F.coalesce(get("speaker_confidence", "double"), F.when(status == "source_provided", 1.0).otherwise(0.0))
    clean = ~F.coalesce(get("needs_review", "boolean"), F.lit(False))
    if "conflicts" in have:
        clean = clean & (F.coalesce(F.size("conflicts"), F.lit(0)) <= 0)
    exact = F.coalesce(get("exact_quote_allowed", "boolean"), F.lit(False))
    if mode == "high_quality_structure_mode":
        exact = exact | ((status == "source_provided") & clean)
    scope = F.coalesce(get("attribution_scope", "string"), F.when(status == "source_provided", "segment").when(
        status == "section_inferred", "section").otherwise("unknown"))
    provider = F.coalesce(get("text_source", "string"), F.lit("unknown"))
    if "text_sources" in have:
        provider = F.coalesce(F.nullif(F.array_join("text_sources", ","), F.lit("")), provider)
    ids = [get(c, "string") for c in ("record_id", "segment_id")]
    projected = F.when(get("secondary_char_start", "long").isNotNull(), F.array(L.range_of(
        F.coalesce(get("text_source", "string"), F.lit("secondary_transcript")), get("secondary_char_start", "long"), get("secondary_char_end", "long"), F.lit(None), "semantic_projection")))
    ranges = F.coalesce(projected, L.no_ranges())
    if "source_ranges" in have:
        ranges = F.when(F.size("source_ranges") > 0, F.col("source_ranges")).otherwise(ranges)
    new = {
        "source_ranges": ranges, "source_hashes": F.coalesce(get("source_hashes", "map<string,string>"), F.create_map().cast("map<string,string>")),
        "record_id": F.coalesce(*ids), "text": F.coalesce("text", F.lit("")), "start_s": F.coalesce("start_s", F.lit(0.0)),
        "end_s": F.coalesce("end_s", F.lit(0.0)), "source_url": F.coalesce(get("source_url", "string"), K.deep_link(url, "start_s")),
        "provider": provider, "speaker_status": status, "speaker_confidence": confidence, "attribution_scope": scope,
        "exact_quote_allowed": exact, "from_meaningful_unmerged": F.lit(False), "mode": F.lit(mode),
    }
    return fused.select(*[F.col(c) for c in fused.columns if c not in new], *[v.alias(n) for n, v in new.items()])


def canonical_leftovers(units: DataFrame, mode: str, min_chars: int = 80, url: str = "media_url") -> DataFrame:
    """Unallocated units long enough to matter: never quotable, always to be verified."""
    rows = units.where(F.length(X.norm_text("text")) >= min_chars)
    out = canonical_records(rows, mode, url)
    known = {"speaker_status": "unknown", "attribution_scope": "unknown"}
    for name, value in known.items():
        out = out.withColumn(name, F.col(name) if name in units.columns else F.lit(value))
    return out.withColumn("speaker_confidence", F.coalesce(units["speaker_confidence"], F.lit(0.0)) if "speaker_confidence" in units.columns else F.lit(0.0)).withColumn(
        "exact_quote_allowed", F.lit(False)).withColumn("from_meaningful_unmerged", F.lit(True)).withColumn("needs_verification", F.lit(True))


def single_source_records(cues: DataFrame, mode: str) -> DataFrame:
    """Rows of a recording with one source: confidence is NULL, and text review is apart from speaker review.

    Modes: ``text_single``, ``official_single``, ``structure_degraded``.
    """
    known = F.col("speaker").isNotNull() & (F.col("speaker") != "")
    official, degraded = mode == "official_single", mode == "structure_degraded"
    reasons = X.strings(["secondary_source_missing"]) if degraded else X.empty()
    return cues.select(
        "*", F.lit(mode).alias("fusion_mode"), F.lit(None).cast("double").alias("alignment_confidence"),
        F.lit("single_source_degraded" if degraded else "single_source").alias("alignment_method"),
        reasons.alias("review_reasons"), F.lit(degraded).alias("needs_review"), X.empty().alias("conflict_types"),
        (~known).alias("speaker_needs_review"),
        F.when(known, "source_provided").otherwise("unknown_needs_review").alias("speaker_status"),
        F.when(known, X.empty()).otherwise(X.strings(["speaker_attribution_pending"])).alias("speaker_review_reasons"),
        F.when(F.col("text") != "", "readable").otherwise("empty").alias("text_status"),
        F.lit("source_provided" if official or degraded else "text_timeline_only").alias("structure_status"))


def fuse_overlap(structs: DataFrame, texts: DataFrame, tol: float = 3.0, keys: tuple[str, ...] = ("media_id",), accept: float = 0.65, auto: float = 0.85) -> DataFrame:
    """Give each structure segment the text of the intervals that overlap it.

    ``structs`` has ``seq, speaker, chapter, start_s, end_s, text``; ``texts`` has ``r_seq, r_start_s, r_end_s, r_text`` and maybe ``r_chapter``.
    Confidence is 0.55 similarity + 0.35 coverage + 0.10 chapter agreement; below ``accept`` the structure text stays.
    """
    from evidence_spark.functions.similarity import block_ratio
    from evidence_spark.operators.intervals import interval_join, overlap_coverage
    from evidence_spark.session import spread

    keys = list(keys)
    if "r_chapter" not in texts.columns:
        texts = texts.withColumn("r_chapter", F.lit(None).cast("string"))
    pairs = interval_join(structs.select(*keys, "seq", "start_s", "end_s", "chapter"), texts, tol, keys)
    cover = overlap_coverage(pairs, [*keys, "seq"])
    same = X.norm_text("r_chapter") == X.norm_text("chapter")
    parts = F.array_sort(F.collect_list(F.struct("r_start_s", "r_seq", X.strip("r_text").alias("t"))))
    matched = pairs.groupBy(*keys, "seq").agg(
        parts.alias("_parts"), F.count(F.nullif("r_chapter", F.lit(""))).alias("_named"),
        F.max(F.when(F.col("r_chapter") != "", same)).alias("_same"))
    matched = matched.join(cover, [*keys, "seq"]).select(
        *keys, "seq", F.array_join(F.filter(F.transform("_parts", lambda p: p["t"]), lambda t: t != ""), " ").alias("candidate_text"),
        F.transform("_parts", lambda p: p["r_seq"]).alias("matched_ids"), "coverage",
        F.when(F.col("_named") == 0, 0.5).when(F.col("_same"), 1.0).otherwise(0.0).alias("chapter_score"))
    rows = structs.join(matched, [*keys, "seq"], "left").withColumn("_any", F.col("matched_ids").isNotNull())
    rows = rows.withColumn("candidate_text", F.coalesce("candidate_text", F.lit("")))
    rows = spread(rows.withColumn("_a", X.norm_text("text")).withColumn("_b", X.norm_text("candidate_text")), *keys, "seq")
    rows = rows.withColumn("similarity", F.when(F.col("_any"), block_ratio(F.col("_a"), F.col("_b"))).otherwise(0.0))
    for c in ("coverage", "chapter_score"):
        rows = rows.withColumn(c, F.coalesce(c, F.lit(0.0)))
    rows = rows.withColumn("alignment_confidence", F.round(0.55 * F.col("similarity") + 0.35 * F.col("coverage") + 0.10 * F.col("chapter_score"), 4))
    found = F.col("candidate_text") != ""
    rows = rows.withColumn("conflicts", F.when(found, X.conflicts_structured("text", "candidate_text", "speaker", "chapter")).otherwise(F.array().cast(X.CONFLICT)))
    conf = F.col("alignment_confidence")
    band = F.when(~F.col("_any"), "no_time_match").when(conf < accept, "alignment_below_0.65").when(conf < auto, "alignment_between_0.65_and_0.85")
    rows = rows.withColumn("review_reasons", F.array_distinct(F.concat(
        F.array_compact(F.array(band, F.when(~found, F.lit("secondary_text_empty")))), F.transform("conflicts", lambda c: c["type"]))))
    take = (conf >= accept) & found
    return rows.select(
        *keys, "seq", "speaker", "chapter", "start_s", "end_s", F.when(take, F.col("candidate_text")).otherwise(F.col("text")).alias("text"),
        F.col("text").alias("structure_text"), F.nullif("candidate_text", F.lit("")).alias("secondary_text"),
        F.when(take, "secondary").otherwise("structure_review_fallback").alias("text_source"), "alignment_confidence",
        F.round("similarity", 4).alias("similarity"), F.round("coverage", 4).alias("coverage"), "chapter_score",
        (F.size("review_reasons") > 0).alias("needs_review"), "review_reasons", "conflicts",
        F.coalesce("matched_ids", F.array().cast(rows.schema["matched_ids"].dataType)).alias("matched_ids"))
