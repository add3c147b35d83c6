"""Claims: seeds from records, evidence bundles, de-duplication, relations, queues and ranked views.

Groups that can grow with the data (members of a claim, evidence of a cluster) stay rows of a member table
instead of arrays, so a popular claim never becomes one huge row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.functions import keys as K
from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators import lineage as L


def atomic_seeds(records: DataFrame, topics: Mapping[str, Sequence[str]] | None = None, min_chars: int = 35) -> DataFrame:
    """Sentences that carry a topic (their own, else the record's, else its chapter's) and a sign of value.

    ``records`` has ``media_id, record_id, text, start_s, end_s`` and maybe ``chapter, source_agreement, needs_verification``.
    """
    have = set(records.columns)
    chapter = F.col("chapter") if "chapter" in have else F.lit("")
    # the record's own topics are found once, below the explode, so no sentence reads its whole record again
    base = records.withColumn("_text", X.tag_topics("text", topics)).withColumn("_title", X.tag_topics(F.coalesce(chapter, F.lit("")), topics))
    base = base.withColumn("_own", F.when(F.size("_text") > 0, F.col("_text")).otherwise(F.col("_title"))).withColumn("_s", X.sentences("text")).drop("text", "_text", "_title")
    rows = base.select("*", F.posexplode("_s").alias("sent_no", "claim")).drop("_s").where((F.length("claim") >= min_chars) & X.is_valuable("claim"))
    rows = rows.withColumn("_tags", X.tag_topics("claim", topics))
    rows = rows.withColumn("_themes", F.when(F.size("_tags") > 0, F.col("_tags")).otherwise(F.col("_own"))).where(F.size("_themes") > 0)
    risks = X.risk_summary("claim")
    signal = F.filter(X.lowered(X.matches("claim", R.VALUE_SIGNAL)), lambda s: s.isin(*R.ATOMIC_SIGNALS))
    agreement = F.col("source_agreement") if "source_agreement" in have else F.lit(None).cast("string")
    doubtful = F.coalesce(F.col("needs_verification"), F.lit(False)) if "needs_verification" in have else F.lit(False)
    rows = rows.withColumn("_r", risks).select(
        "media_id", "record_id", "sent_no", "claim", "start_s", "end_s", F.explode("_themes").alias("topic"),
        X.atomic_novelty("claim").alias("novelty_type"), signal.alias("signals"), "_r.numeric_risks", "_r.entity_risks", "_r.negation_risks",
        F.coalesce(agreement, F.lit("single_source")).alias("source_agreement"),
        (doubtful | (F.size("_r.numeric_risks") > 0) | (F.size("_r.negation_risks") > 0)).alias("needs_verification"))
    first = rows.groupBy("media_id", "record_id", "topic", X.norm_text("claim").alias("_n")).agg(F.min("sent_no").alias("sent_no"))
    kept = rows.join(first.drop("_n"), ["media_id", "record_id", "topic", "sent_no"], "left_semi")
    return kept.withColumn("seed_id", K.stable_id("atomic", "media_id", "record_id", "claim", "topic")).withColumn(
        "record_ids", F.array("record_id")).withColumn("extraction_pass", F.lit("atomic"))


def block_candidates(blocks: DataFrame) -> DataFrame:
    """One candidate per topic block. ``blocks`` holds member rows (a block has few rows by its caps).

    Optional columns: ``speaker, speaker_status, speaker_confidence, source_agreement, exact_quote_allowed, n_conflicts``.
    """
    have = set(blocks.columns)
    opt = lambda name, default: F.col(name) if name in have else default
    rows = blocks.withColumn("_status", F.coalesce(opt("speaker_status", F.lit(None).cast("string")), F.lit("unknown")))
    rank = F.lit(0)
    for status, value in R.SPEAKER_RANK.items():
        rank = F.when(F.col("_status") == status, value).otherwise(rank)
    speaker = F.when(opt("speaker", F.lit(None).cast("string")) != "unknown", opt("speaker", F.lit(None).cast("string")))
    rows = rows.withColumn("_rank", rank).withColumn("_speaker", speaker).withColumn(
        "_agree", F.coalesce(opt("source_agreement", F.lit(None).cast("string")), F.lit("single_source"))).withColumn(
        "_exact", F.coalesce(opt("exact_quote_allowed", F.lit(False)), F.lit(False))).withColumn(
        "_bad", F.coalesce(opt("n_conflicts", F.lit(0)), F.lit(0))).withColumn("_conf", F.coalesce(opt("speaker_confidence", F.lit(0.0)), F.lit(0.0)))
    key = ["media_id", "topic", "block_pos"]
    text = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("pos", X.strip("text").alias("t")))), lambda r: r["t"]), lambda t: t != ""), " ")
    g = rows.groupBy(*key).agg(
        text.alias("supporting_text"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("record_id").cast("string").alias("id")))), lambda r: r["id"]).alias("record_ids"),
        F.min("_speaker").alias("_lo"), F.max("_speaker").alias("_hi"), F.min_by("_status", F.struct("_rank", "pos")).alias("speaker_status"),
        F.min("_conf").alias("speaker_confidence"), F.bool_and("_exact").alias("_exact"), F.sum("_bad").alias("n_conflicts"),
        F.min("_agree").alias("_agree_lo"), F.max("_agree").alias("_agree_hi"))
    g = g.withColumn("speaker", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")))
    agreement = F.when(F.col("n_conflicts") > 0, "conflict").when(F.col("_agree_lo") != F.col("_agree_hi"), "mixed").otherwise(F.col("_agree_lo"))
    g = g.withColumn("_r", X.risk_summary("supporting_text")).withColumn("claim", X.best_sentence("supporting_text"))
    doubtful = ((F.col("n_conflicts") > 0) | F.col("speaker_status").isin("boundary_uncertain", "unknown")
                | (F.size("_r.numeric_risks") > 0) | (F.size("_r.negation_risks") > 0))
    return g.select(
        "media_id", "topic", "block_pos", "claim", "supporting_text", "start_s", "end_s", "record_ids", "speaker", "speaker_status",
        "speaker_confidence", "_r.numeric_risks", "_r.entity_risks", "_r.negation_risks", agreement.alias("source_agreement"),
        X.signals("supporting_text").alias("signals"), X.block_novelty("supporting_text", "topic").alias("novelty_type"),
        (F.col("speaker").isNotNull() & F.col("_exact")).alias("exact_quote_allowed"), doubtful.alias("needs_verification"), "n_conflicts",
        F.concat(F.col("media_id").cast("string"), F.lit(".trend_"), F.substring(F.sha2(F.concat_ws(
            "|", F.col("media_id").cast("string"), "topic", F.col("start_s").cast("string"), F.col("end_s").cast("string"), "supporting_text"), 256), 1, 12)).alias("seed_id"),
        F.lit("topic_block").alias("extraction_pass"))


def union_seeds(blocks: DataFrame, atoms: DataFrame) -> DataFrame:
    """Block seeds, then atomic seeds; the first one per (normalised claim, topic, records) stays."""
    both = blocks.withColumn("_p", F.lit(0)).unionByName(atoms.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_n", F.sha2(X.norm_text("claim"), 256)).withColumn("_k", F.concat_ws("|", "record_ids"))
    order = F.struct("_p", "start_s", "seed_id")
    first = both.groupBy("media_id", "topic", "_n", "_k").agg(F.min(order).alias("_first"))
    return both.join(first, ["media_id", "topic", "_n", "_k"]).where(order == F.col("_first")).dropDuplicates(["media_id", "seed_id"]).drop("_p", "_n", "_k", "_first")


def expand_ids(df: DataFrame, ids: str, dim: DataFrame, dim_id: str, id_name: str = "ref_id") -> DataFrame:
    """One row per id of an array column that exists in ``dim``, with its position; missing ids are ignored."""
    rows = df.select(*[c for c in df.columns if c != ids], F.posexplode(ids).alias("ref_pos", id_name))
    return rows.join(dim.withColumnRenamed(dim_id, id_name), id_name)


def collect_ids(rows: DataFrame, key: Sequence[str], value: str, name: str) -> DataFrame:
    """Put looked-up values back into an array in the original id order."""
    return rows.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("ref_pos", F.col(value).alias("v")))), lambda r: r["v"]).alias(name))


def bundle_evidence(seeds: DataFrame, records: DataFrame) -> DataFrame:
    """Evidence of a seed: its records' text in order, with the weakest attribution and all risks.

    ``seeds`` has ``media_id, seed_id, record_ids``; ``records`` has ``media_id, record_id, text, speaker, speaker_status,
    speaker_confidence, exact_quote_allowed, provider, start_s, end_s`` and maybe ``n_conflicts, from_meaningful_unmerged, source_ranges,
    source_hashes``. The evidence has the ranges of its records in their order; without any it has one range that names the records only.
    """
    have = set(records.columns)
    opt = lambda n, d: F.coalesce(F.col(n), d) if n in have else d
    dim = records.select(
        F.col("media_id").alias("_m"), F.col("record_id").cast("string").alias("record_id"), X.strip("text").alias("t"), F.nullif("speaker", F.lit("")).alias("speaker"),
        F.coalesce("speaker_status", F.lit("unknown")).alias("st"), F.coalesce("speaker_confidence", F.lit(0.0)).alias("cf"),
        F.coalesce("exact_quote_allowed", F.lit(False)).alias("ex"), F.coalesce("provider", F.lit("unknown")).alias("pr"), "start_s", "end_s",
        opt("n_conflicts", F.lit(0)).alias("nc"), opt("from_meaningful_unmerged", F.lit(False)).alias("fm"),
        opt("source_ranges", L.no_ranges()).alias("sr"), opt("source_hashes", F.create_map().cast("map<string,string>")).alias("sh"))
    rows = expand_ids(seeds.select("media_id", "seed_id", "record_ids"), "record_ids", dim, "record_id", "record_id").where(F.col("_m") == F.col("media_id"))
    ordered = F.array_sort(F.collect_list(F.struct("ref_pos", "t", "record_id", "sr")))
    hashes = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.map_entries("sh")))))
    g = rows.groupBy("media_id", "seed_id").agg(
        ordered.alias("_o"), F.min("speaker").alias("_lo"), F.max("speaker").alias("_hi"),
        F.bool_and(F.col("st") == "source_provided").alias("_given"), F.bool_and(F.col("st").isin("source_provided", "section_inferred")).alias("_inferred"),
        F.bool_or(F.col("st") == "boundary_uncertain").alias("_edge"), F.min("cf").alias("speaker_confidence"), F.bool_and("ex").alias("exact_quote_allowed"),
        F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.array_join(F.array_sort(F.collect_set("pr")), ",").alias("provider"),
        F.sum("nc").alias("n_conflicts"), F.bool_or("fm").alias("from_meaningful_unmerged"), hashes.alias("_hashes"))
    g = g.withColumn("source_text", F.array_join(F.filter(F.transform("_o", lambda r: r["t"]), lambda t: t != ""), " ")).where("source_text <> ''")
    g = g.withColumn("source_record_ids", F.transform("_o", lambda r: r["record_id"])).withColumn("_r", X.risk_summary("source_text"))
    status = F.when(F.col("_given"), "source_provided").when(F.col("_inferred"), "section_inferred").when(F.col("_edge"), "boundary_uncertain").otherwise("unknown")
    risky = ((F.size("_r.numeric_risks") > 0) | (F.size("_r.entity_risks") > 0) | (F.size("_r.negation_risks") > 0) | (F.col("n_conflicts") > 0) | ~F.col("exact_quote_allowed"))
    ranges = F.flatten(F.transform("_o", lambda r: r["sr"]))
    unknown = F.array(L.range_of(F.lit("canonical_record"), F.lit(None), F.lit(None), F.lit(None), "record"))
    # sources of one name with different hashes keep all of them under numbered names
    name = lambda e, i: F.when(F.exists(F.slice("_hashes", 1, i), lambda x: x["key"] == e["key"]), F.concat(e["key"], F.lit("#"), i.cast("string"))).otherwise(e["key"])
    by_source = F.map_from_entries(F.transform("_hashes", lambda e, i: F.struct(name(e, i), e["value"])))
    return g.select(
        F.when(F.size(ranges) > 0, ranges).otherwise(unknown).alias("source_ranges"), by_source.alias("source_hashes"),
        "media_id", "seed_id", K.stable_id("ev", "media_id", F.concat_ws("|", "source_record_ids"), "source_text").alias("evidence_id"), "source_record_ids", "source_text",
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("speaker"), status.alias("speaker_status"), "speaker_confidence", "exact_quote_allowed",
        "start_s", "end_s", "provider", "_r.numeric_risks", "_r.entity_risks", "_r.negation_risks", "n_conflicts", "from_meaningful_unmerged",
        F.when(risky, "needs_review").otherwise("unreviewed").alias("verification_status"))


def claims_from_seeds(seeds: DataFrame, evidence: DataFrame) -> DataFrame:
    """Claim rows: type, value types, scores and risks of each seed that has evidence."""
    e = evidence.select("media_id", "seed_id", "evidence_id", "source_record_ids", F.col("speaker").alias("e_speaker"), F.col("speaker_status").alias("e_status"),
                        F.col("exact_quote_allowed").alias("e_exact"), F.col("start_s").alias("e_start"), F.col("end_s").alias("e_end"),
                        F.col("numeric_risks").alias("e_num"), F.col("entity_risks").alias("e_ent"), F.col("negation_risks").alias("e_neg"),
                        F.col("n_conflicts").alias("e_conf"), "from_meaningful_unmerged")
    s = seeds.select("media_id", "seed_id", "claim", "topic", "novelty_type", "signals", F.col("numeric_risks").alias("s_num"), "source_agreement",
                     F.col("needs_verification").alias("s_need"), "extraction_pass")
    j = s.join(e, ["media_id", "seed_id"])
    n_sig, n_num = F.size("signals"), F.size("s_num")
    j = j.withColumn("_s", X.score_struct("novelty_type", n_sig, n_num, "source_agreement"))
    return j.select(
        K.stable_id("cl", "media_id", "claim", "topic", "e_start", "e_end").alias("claim_id"), "media_id", "claim",
        X.claim_type("claim", "novelty_type").alias("claim_type"), X.value_types("novelty_type", n_sig, n_num, "source_agreement").alias("value_types"),
        F.array("topic").alias("themes"), F.col("e_speaker").alias("speaker"), F.col("e_status").alias("speaker_status"), "source_record_ids",
        F.array("evidence_id").alias("evidence_ids"), F.col("e_start").alias("start_s"), F.col("e_end").alias("end_s"),
        "_s.confidence", "_s.novelty_score", "_s.importance_score", "_s.non_consensus_score", F.col("e_num").alias("numeric_risks"),
        F.col("e_ent").alias("entity_risks"), F.col("e_neg").alias("negation_risks"), F.col("e_exact").alias("exact_quote_allowed"),
        (F.coalesce("s_need", F.lit(False)) | (F.col("e_conf") > 0) | (F.size("e_num") > 0) | (F.size("e_neg") > 0)).alias("needs_verification"),
        "from_meaningful_unmerged", "extraction_pass")


def dedup_claims(claims: DataFrame, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(best claim per normalised text and first theme, member rows).

    The best has the highest importance, then confidence, then the earliest start; it gets the group's time
    range and size. The member table maps every claim to the claim that stands for it.
    """
    c = claims.withColumn("_n", F.sha2(X.norm_text("claim"), 256)).withColumn("_t", F.coalesce(F.get("themes", F.lit(0)), F.lit("")))
    key = [*scope, "_n", "_t"]
    rank = F.struct("importance_score", "confidence", (-F.col("start_s")).alias("s"), F.col("claim_id"))
    g = c.groupBy(*key).agg(F.max_by("claim_id", rank).alias("canonical_id"), F.min("start_s").alias("g_start"), F.max("end_s").alias("g_end"),
                            F.count("*").alias("merged_candidate_count"))
    members = c.select(*key, "claim_id", "evidence_ids", "source_record_ids").join(g.select(*key, "canonical_id"), key).drop("_n", "_t")
    best = claims.join(g.drop(*key), F.col("claim_id") == F.col("canonical_id")).withColumn("start_s", F.col("g_start")).withColumn("end_s", F.col("g_end"))
    return best.drop("canonical_id", "g_start", "g_end"), members


def theme_assignments(claims: DataFrame) -> DataFrame:
    return claims.select("media_id", "claim_id", F.explode("themes").alias("theme_id"), F.round(F.greatest(F.lit(0.55), F.col("confidence")), 6).alias("confidence")).withColumn(
        "assignment_id", K.stable_id("theme", "claim_id", "theme_id"))


def trend_candidates(claims: DataFrame, importance: float = 0.62, non_consensus: float = 0.45) -> DataFrame:
    return claims.where((F.col("importance_score") >= importance) | (F.col("non_consensus_score") >= non_consensus))


def eligible_claims(claims: DataFrame, excluded: Sequence[str], sources: str = "source_ids") -> DataFrame:
    """Drop claims of unknown speakers and of excluded sources."""
    return claims.where((F.coalesce("speaker", F.lit("unknown")) != "unknown") & ~F.arrays_overlap(sources, X.strings(list(excluded))))


# fixed values: capped views over ranked claims
FAILURE_TYPES = ["failure_mode", "engineering_constraint", "conditional_conclusion"]


def top_claims(claims: DataFrame, view: str = "judge", n: int | None = None) -> DataFrame:
    """A capped report: claims by importance, novelty and id, filtered by the view."""
    filters = {
        "judge": (F.lit(True), 32), "non_consensus": (F.col("non_consensus_score") >= 0.45, 15),
        "failures": (F.col("claim_type").isin(*FAILURE_TYPES), 20),
        "quantitative": (F.array_contains("value_types", "quantitative_signal"), 20),
        "usable": (~F.col("needs_verification") & (F.col("confidence") >= 0.7), 20),
    }
    keep, size = filters[view]
    return claims.where(keep).orderBy(F.col("importance_score").desc(), F.col("novelty_score").desc(), "claim_id").limit(n or size)


def verification_queue(claims: DataFrame, unmerged_claims: DataFrame | None = None) -> DataFrame:
    """Why a claim must be verified, in fixed order, and how urgently. Claims without a reason are left out."""
    rows = claims
    if unmerged_claims is not None:
        rows = rows.join(unmerged_claims.select("claim_id", F.lit(True).alias("_u")).distinct(), "claim_id", "left")
    elif "from_meaningful_unmerged" in claims.columns:
        rows = rows.withColumn("_u", F.col("from_meaningful_unmerged"))
    else:
        rows = rows.withColumn("_u", F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(F.size("numeric_risks") > 0, "numeric_risk"), F.when(F.size("negation_risks") > 0, "negation_risk"), F.when(F.size("entity_risks") > 0, "entity_risk"),
        F.when(~F.coalesce("speaker_status", F.lit("")).isin("source_provided", "audio_confirmed"), "speaker_not_exact"),
        F.when(~F.coalesce("exact_quote_allowed", F.lit(False)), "exact_quote_not_allowed"), F.when(F.col("_u"), "meaningful_unmerged_source"),
        F.when(F.col("confidence") < 0.7, "low_source_confidence")))
    risky = F.arrays_overlap("reasons", X.strings(["numeric_risk", "negation_risk", "entity_risk"]))
    rows = rows.withColumn("reasons", reasons).where(F.size("reasons") > 0)
    return rows.withColumn("priority", F.when(risky & (F.col("importance_score") >= 0.65), "high").when(F.col("importance_score") >= 0.6, "medium").otherwise("low")).drop("_u")


def topic_time_cover(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("media_id", "topic"), id_col: str = "claim_id", middle_s: float = 90.0, bucket: float = 90.0) -> DataFrame:
    """Which rows of ``a`` have a row of ``b`` with the same topic whose time touches or whose middle is near.

    Middles within ``middle_s`` mean that the intervals widened by half of it touch, so one bucketed join finds both.
    """
    from evidence_spark.operators.intervals import range_pairs

    left = a.select(*keys, F.col(id_col).alias("_a"), F.col("start_s").alias("_as"), F.col("end_s").alias("_ae"))
    right = b.select(*keys, F.col("start_s").alias("_bs"), F.col("end_s").alias("_be"))
    touch = F.least("_ae", "_be") >= F.greatest("_as", "_bs")
    near = F.abs((F.col("_as") + F.col("_ae")) / 2 - (F.col("_bs") + F.col("_be")) / 2) <= middle_s
    pad = middle_s / 2 + 1e-6
    pairs = range_pairs(left, right, keys, F.col("_as") - pad, F.col("_ae") + pad, F.col("_bs") - pad, F.col("_be") + pad, bucket, touch | near)
    hit = pairs.select(F.col("_a").alias(id_col)).distinct().withColumn("covered", F.lit(True))
    return a.join(hit, id_col, "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def unallocated(units: DataFrame, records: DataFrame, keys: Sequence[str] = ("media_id",), unit: str = "unit_idx", used: str = "unit_ids") -> DataFrame:
    """Units that no record uses."""
    return units.join(records.select(*keys, F.explode(used).alias(unit)).distinct(), [*keys, unit], "left_anti")


def propagate_queue(queue: DataFrame, theme_parents: DataFrame, insight_claims: DataFrame) -> DataFrame:
    """Carry queue items of source claims to theme claims and on to insights.

    ``queue(queue_id, claim_id, priority)``, ``theme_parents(theme_claim_id, claim_id)``, ``insight_claims(insight_id, theme_claim_id)``.
    An item stays if it reaches an insight or has priority P0; its impact is high only if both hold.
    """
    linked = queue.join(theme_parents, "claim_id").join(insight_claims, "theme_claim_id", "left")
    g = linked.groupBy("queue_id", "claim_id", "priority").agg(F.count_distinct("theme_claim_id").alias("n_theme_claims"), F.count_distinct("insight_id").alias("n_insights"))
    top, reaches = F.col("priority") == "P0", F.col("n_insights") > 0
    return g.where(reaches | top).withColumn("conclusion_impact", F.when(reaches & top, "high").otherwise("medium"))


def risk_spans(rows: DataFrame, text: str, terms: str, around: int | None = None) -> DataFrame:
    """First place of each term in a text, ignoring case, with the text around it (or all of it)."""
    t = rows.withColumn("term", F.explode(terms))
    t = t.withColumn("_at", F.instr(F.lower(text), F.lower("term"))).where("_at > 0")
    begin = F.lit(1) if around is None else F.greatest(F.lit(1), F.col("_at") - around)
    stop = F.length(text) if around is None else F.col("_at") + F.length("term") - 1 + around
    return t.withColumn("char_start", F.col("_at") - 1).withColumn("char_end", F.col("_at") - 1 + F.length("term")).withColumn(
        "excerpt", F.substring(F.col(text), begin, stop - begin + 1)).drop("_at")


# --- roll-ups over claims -----------------------------------------------------------------------

def top_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; each map task already keeps only ``n`` rows of a key."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= n)


def person_positions(claims: DataFrame, n: int = 8) -> DataFrame:
    """Per speaker: claim count, themes by frequency, best claims, first and last date, number of families.

    ``claims`` has ``speaker, claim_id, claim, importance_score, themes, published_at, family``.
    """
    base = claims.groupBy("speaker").agg(F.count("*").alias("n_claims"), F.min("published_at").alias("first_seen_at"), F.max("published_at").alias("last_seen_at"),
                                         F.count_distinct("family").alias("n_families"))
    best = top_per_key(claims.select("speaker", "claim", "claim_id", "importance_score"), ["speaker"], [F.col("importance_score").desc(), F.col("claim_id")], n)
    best = best.groupBy("speaker").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "claim"))), lambda r: r["claim"]).alias("representative_claims"))
    freq = claims.select("speaker", F.explode("themes").alias("theme")).groupBy("speaker", "theme").count()
    # as many entries as the rule pack has themes
    themes = freq.groupBy("speaker").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), "theme"))), lambda r: r["theme"]).alias("themes"))
    return base.join(best, "speaker").join(themes, "speaker", "left")


def theme_trends(claims: DataFrame) -> DataFrame:
    """Per theme: how many claims, speakers and independent families, and what kind of trend that is."""
    g = claims.select(F.explode("themes").alias("theme"), "speaker", "family", "published_at").groupBy("theme").agg(
        F.count("*").alias("n_claims"), F.count_distinct("speaker").alias("n_speakers"), F.count_distinct("family").alias("n_families"),
        F.min("published_at").alias("first_seen_at"), F.max("published_at").alias("last_seen_at"))
    kind = F.when(F.col("n_families") >= 2, "cross_source_pattern").when((F.col("n_claims") >= 3) & (F.col("n_speakers") == 1), "repeated_speaker_position").otherwise("single_source_signal")
    conf = F.least(F.lit(0.9), 0.48 + 0.08 * F.least(F.col("n_claims"), F.lit(4)) + 0.08 * F.least(F.col("n_families"), F.lit(2)))
    return g.withColumn("insight_type", kind).withColumn("confidence", F.round(conf, 3))


def keyword_syntheses(claims: DataFrame, specs: Mapping[str, Sequence[str]], n: int = 12) -> DataFrame:
    """Per spec: the best ``n`` claims that contain one of its terms, and the support they give.

    The specs are a rule pack compiled into one projection, so no join is needed.
    """
    low = F.lower("claim")
    hits = []
    for slug, terms in specs.items():
        any_term = F.lit(False)
        for term in terms:
            any_term = any_term | F.contains(low, F.lit(term))
        hits.append(F.when(any_term, F.lit(slug)))
    rows = claims.withColumn("slug", F.explode(F.array_compact(F.array(*hits))))
    best = top_per_key(rows, ["slug"], [F.col("importance_score").desc(), F.col("claim_id")], n)
    g = best.groupBy("slug").agg(F.count("*").alias("n_claims"), F.count_distinct("family").alias("n_families"), F.count_distinct("speaker").alias("n_speakers"),
                                 F.transform(F.array_sort(F.collect_list(F.struct("rank", "claim_id"))), lambda r: r["claim_id"]).alias("claim_ids"))
    conf = F.least(F.lit(0.88), 0.5 + 0.04 * F.least(F.col("n_claims"), F.lit(6)) + 0.08 * F.least(F.col("n_families"), F.lit(2)))
    return g.withColumn("confidence", F.round(conf, 3))


def merge_evidence(evidence: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(canonical evidence per cluster, member rows): the longest text wins, groups are counted once.

    ``evidence`` has ``evidence_id, section_id, source_id, family, text``; ``clusters`` maps ``section_id`` to ``cluster_id``.
    Sections outside any cluster stand for themselves.
    """
    rows = evidence.join(clusters.select("section_id", "cluster_id"), "section_id", "left")
    rows = rows.withColumn("content_id", F.coalesce(F.col("cluster_id").cast("string"), F.concat(F.lit("section."), F.col("section_id").cast("string"))))
    rank = F.struct(F.length("text").alias("l"), (-F.col("section_id")).alias("s"))
    g = rows.groupBy("content_id").agg(F.max_by("evidence_id", rank).alias("canonical_evidence_id"), F.count("*").alias("n_evidence"),
                                       F.count_distinct("source_id").alias("n_sources"), F.count_distinct("family").alias("n_families"))
    return g, rows.select("content_id", "evidence_id", "section_id", "source_id", "family")
