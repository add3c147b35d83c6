"""Theme claims, their relations and syntheses, representative positions, review queues, applied judgments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.operators.tiles import similar_pairs
from evidence_spark.session import small

# fixed values
COUNTER_TYPES = ["limits", "contradicts", "tension_with"]
DROPPED_VERDICTS = ["unrelated", "contradicted"]


def clamp(c: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 6)


def theme_claims(clusters: DataFrame, members: DataFrame, judgments: DataFrame | None = None) -> DataFrame:
    """One theme claim per cluster: the judged statement, else the representative claim; unrelated clusters are dropped.

    ``clusters`` has ``cluster_id, frame, subtheme, representative``; ``members`` has ``cluster_id, claim_id, speaker, source_id, family,
    published_at, value_types, needs_verification``; ``judgments`` has ``cluster_id, entailment_status, statement``.
    """
    c = clusters
    if judgments is None:
        c = c.withColumn("entailment_status", F.lit(None).cast("string")).withColumn("statement", F.lit(None).cast("string"))
    else:
        c = c.join(judgments.select("cluster_id", "entailment_status", "statement"), "cluster_id", "left")
    c = c.where(~F.coalesce("entailment_status", F.lit("")).isin(*DROPPED_VERDICTS))
    g = members.groupBy("cluster_id").agg(
        F.count("*").alias("n_members"), F.count_distinct("speaker").alias("n_speakers"), F.count_distinct("source_id").alias("n_sources"),
        F.count_distinct("family").alias("n_families"), F.min("published_at").alias("first_seen_at"), F.max("published_at").alias("last_seen_at"),
        F.bool_or("needs_verification").alias("_need"))
    # value types are a small fixed vocabulary
    types = members.select("cluster_id", F.explode("value_types").alias("v")).groupBy("cluster_id").agg(F.array_sort(F.collect_set("v")).alias("value_types"))
    j = c.join(g, "cluster_id").join(types, "cluster_id", "left")
    return j.select(
        "cluster_id", "frame", "subtheme", F.coalesce("statement", "representative").alias("statement"), "value_types", "n_members", "n_speakers", "n_sources", "n_families",
        "first_seen_at", "last_seen_at", F.coalesce("entailment_status", F.lit("fully_supported")).alias("entailment_status"),
        F.when(F.col("_need"), "needs_targeted_verification").otherwise("official_text_only").alias("verification_status"),
        F.when(F.col("n_speakers") > 1, "multi_speaker_consolidation").otherwise("speaker_claim_consolidation").alias("attribution_scope"))


def theme_relations(claims: DataFrame, pair_rules: DataFrame, judgments: DataFrame | None = None, n: int = 48, same: float = 0.67, any_: float = 0.76) -> DataFrame:
    """Related theme claims, at most ``n``: pairs named by the rules first, then by similarity.

    ``claims`` has ``idx, theme_claim_id, frame, subtheme, vector``; ``pair_rules`` has ``frame_a, frame_b, relation``; ``judgments`` has
    ``left, right, relation_type, confidence``. An unrelated pair is left out.
    """
    c = claims.select("idx", "theme_claim_id", "frame", "subtheme", "vector")
    near = similar_pairs(c, same)
    side = lambda tag: c.select(F.col("idx").alias(tag), F.col("theme_claim_id").alias(tag + "_id"), F.col("frame").alias(tag + "_f"), F.col("subtheme").alias(tag + "_s"), F.col("vector").alias(tag + "_v"))
    rules = pair_rules.select("frame_a", "frame_b", "relation").unionByName(pair_rules.select(F.col("frame_b").alias("frame_a"), F.col("frame_a").alias("frame_b"), "relation"))
    from evidence_spark.operators.vectors import cosine

    named = side("left").join(small(rules), F.col("left_f") == F.col("frame_a")).join(side("right"), F.col("frame_b") == F.col("right_f")).where("left < right")
    named = named.select("left", "right", F.greatest(F.lit(0.0), cosine(F.col("left_v"), F.col("right_v"))).alias("similarity"), "relation")
    alike = near.join(side("left"), "left").join(side("right"), "right").where(((F.col("left_s") == F.col("right_s")) & (F.col("similarity") >= same)) | (F.col("similarity") >= any_))
    pairs = named.unionByName(alike.select("left", "right", "similarity", F.lit(None).cast("string").alias("relation")))
    pairs = pairs.groupBy("left", "right").agg(F.max("similarity").alias("similarity"), F.min("relation").alias("suggested"))
    top = pairs.orderBy(F.col("suggested").isNotNull().desc(), F.col("similarity").desc(), "left", "right").limit(n)
    if judgments is not None:
        top = top.join(judgments.select("left", "right", "relation_type", F.col("confidence").alias("_c")), ["left", "right"], "left")
    else:
        top = top.withColumn("relation_type", F.lit(None).cast("string")).withColumn("_c", F.lit(None).cast("double"))
    kind = F.coalesce("relation_type", "suggested", F.lit("unrelated"))
    conf = F.coalesce("_c", F.when(F.col("suggested").isNotNull(), 0.78), F.col("similarity"))
    out = top.withColumn("relation_type", kind).where("relation_type <> 'unrelated'").withColumn("confidence", F.round(conf, 6))
    return out.join(side("left").select("left", F.col("left_id").alias("source_id")), "left").join(side("right").select("right", F.col("right_id").alias("target_id")), "right").select(
        "source_id", "target_id", "relation_type", "confidence", F.round("similarity", 6).alias("similarity"))


def counter_links(relations: DataFrame) -> DataFrame:
    """Both directions of the relations that speak against a claim."""
    r = relations.where(F.col("relation_type").isin(*COUNTER_TYPES))
    return r.select(F.col("source_id").alias("theme_claim_id"), F.col("target_id").alias("counter_id")).unionByName(
        r.select(F.col("target_id").alias("theme_claim_id"), F.col("source_id").alias("counter_id"))).distinct()


def syntheses(claims: DataFrame, relations: DataFrame, specs: Mapping[str, Sequence[str]], judgments: DataFrame | None = None) -> DataFrame:
    """Insights named by frame sets that have at least two supporting theme claims.

    ``claims`` has ``theme_claim_id, frame, n_families``; an insight judged unsupported becomes a hypothesis of at most 0.45.
    """
    slugs = F.array_compact(F.array(*[F.when(F.col("frame").isin(*frames), F.lit(slug)) for slug, frames in specs.items()]))
    rows = claims.select("theme_claim_id", "frame", "n_families", F.explode(slugs).alias("slug"))
    against = counter_links(relations).groupBy("theme_claim_id").agg(F.count("*").alias("_c"))
    g = rows.join(against, "theme_claim_id", "left").groupBy("slug").agg(
        F.count("*").alias("n_support"), F.max("n_families").alias("n_families"), F.sum(F.coalesce("_c", F.lit(0))).alias("n_counter"),
        F.array_sort(F.collect_set("theme_claim_id")).alias("supporting_ids")).where("n_support >= 2")
    conf = F.round(F.least(F.lit(0.82), 0.48 + 0.045 * F.col("n_support") + 0.08 * F.col("n_families")), 6)
    g = g.withColumn("confidence", conf)
    if judgments is None:
        return g.withColumn("epistemic_status", F.lit("synthesis"))
    g = g.join(judgments.select("slug", "supported"), "slug", "left")
    no = ~F.coalesce("supported", F.lit(True))
    return g.withColumn("confidence", F.when(no, F.least(F.lit(0.45), F.col("confidence"))).otherwise(F.col("confidence"))).withColumn(
        "epistemic_status", F.when(no, "hypothesis").otherwise("synthesis")).drop("supported")


def representative_positions(members: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per person the strongest subthemes and, in each, the claim closest to its theme statement.

    ``members`` has ``person, subtheme, theme_claim_id, claim_id, relevance, similarity``; ``limits`` says how many subthemes a person gets.
    """
    m = members.where(F.col("person").isin(*limits))
    g = m.groupBy("person", "subtheme").agg(F.count_distinct("theme_claim_id").alias("n_theme_claims"), F.max("relevance").alias("max_relevance"),
                                            F.max_by("claim_id", F.struct("similarity", "claim_id")).alias("representative_claim_id"), F.count("*").alias("n_claims"))
    limit = F.lit(0)
    for person, size in limits.items():
        limit = F.when(F.col("person") == person, size).otherwise(limit)
    # one row per person and subtheme is left to rank
    w = Window.partitionBy("person").orderBy(F.col("n_theme_claims").desc(), F.col("max_relevance").desc(), "subtheme")
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def review_queue(records: DataFrame, tags: DataFrame, order: Sequence[str], recommended: int = 30) -> DataFrame:
    """Records that need review or carry a tag, by tag class then position; the first ``recommended`` are marked.

    ``records`` has ``record_id, seq, needs_review``; ``tags`` has ``record_id, tag``; ``order`` lists tags, most urgent first.
    """
    rank = F.lit(len(order))
    for i, tag in reversed(list(enumerate(order))):
        rank = F.when(F.col("tag") == tag, i).otherwise(rank)
    best = tags.groupBy("record_id").agg(F.min(rank).alias("priority"), F.array_sort(F.collect_set("tag")).alias("tags"))
    rows = records.join(best, "record_id", "left").where(F.col("needs_review") | F.col("priority").isNotNull())
    rows = rows.withColumn("priority", F.coalesce("priority", F.lit(len(order)))).withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
    first = rows.orderBy("priority", "seq", "record_id").limit(recommended).select("record_id", F.lit(True).alias("recommended"))
    return rows.join(F.broadcast(first), "record_id", "left").withColumn("recommended", F.coalesce("recommended", F.lit(False)))


# fixed values: claim types a judge may use
CLAIM_TYPES = ["failure_mode", "open_question", "prediction", "causal_claim", "conditional_conclusion", "comparison", "engineering_constraint", "technical_mechanism",
               "opinion", "normative_claim", "personal_experience", "institutional_claim", "fact", "strategic_advice"]
SCORES = ["importance_score", "novelty_score", "non_consensus_score"]


def judgment_violations(claims: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts for unknown claims or with a claim type outside the vocabulary."""
    unknown = verdicts.join(claims.select("claim_id"), "claim_id", "left_anti").select("claim_id", F.lit("unknown_claim").alias("issue"))
    bad = verdicts.where(~F.col("claim_type").isin(*CLAIM_TYPES)).select("claim_id", F.lit("invalid_claim_type").alias("issue"))
    return unknown.unionByName(bad)


def apply_judgments(claims: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Overlay judged type and scores (clamped) by id; doubt only ever grows; claims without a verdict keep the rule result.

    ``verdicts`` has ``claim_id, claim_type, importance_score, novelty_score, non_consensus_score, needs_verification``.
    """
    v = verdicts.select("claim_id", F.col("claim_type").alias("_t"), *[clamp(F.col(s).cast("double")).alias("_" + s) for s in SCORES], F.col("needs_verification").alias("_n"))
    j = claims.join(v, "claim_id", "left").withColumn("judged", F.col("_t").isNotNull())
    j = j.withColumn("claim_type", F.coalesce("_t", "claim_type")).withColumn("needs_verification", F.col("needs_verification") | F.coalesce("_n", F.lit(False)))
    for s in SCORES:
        j = j.withColumn(s, F.coalesce("_" + s, s))
    return j.drop("_t", "_n", *["_" + s for s in SCORES])


def accept_boundary(rows: DataFrame, verdicts: DataFrame | None, first: int = 20, least: float = 0.55) -> DataFrame:
    """Boundary rows a judge finds relevant, with the averaged score; without a judge the first ``first`` rows.

    ``rows`` has ``row_id, score``; ``verdicts`` has ``row_id, relevant, relevance_score``.
    """
    if verdicts is None:
        return rows.orderBy(F.col("score").desc(), "row_id").limit(first)
    j = rows.join(verdicts.select("row_id", "relevant", "relevance_score"), "row_id").where(F.col("relevant") & (F.col("relevance_score") >= least))
    return j.withColumn("score", clamp((F.col("score") + F.col("relevance_score")) / 2)).drop("relevant", "relevance_score")
