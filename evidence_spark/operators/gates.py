"""Human review as data: blank decisions, claim and theme gates, edge remapping, local risk queues, readiness.

A gate never raises on bad rows: it returns them as violations, and ``quality.require_clean`` refuses to go on.
Everything a claim gathers from merged claims stays rows of a member table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators.quality import check_exact_set

# fixed values: vocabularies of the gates
CLAIM_DECISIONS = ["accept", "merge_into", "reject_low_value", "reject_incorrect", "reject_duplicate", "reject_unsupported", "defer"]
ENTAILMENT = ["fully_supported", "supported_with_missing_condition", "partially_supported", "overgeneralized", "contradicted", "unrelated"]
SUPPORTED = ["fully_supported", "supported_with_missing_condition", "partially_supported"]
THEME_DECISIONS = ["accept", "edit", "split", "merge", "reject", "defer_for_more_evidence"]
FLAGS = ["speaker_attribution_correct", "conditions_preserved", "claim_scope_valid", "support_independence_sufficient"]
OPEN_FACTS = ["not_checked", "insufficient_evidence"]


def decision_template(candidates: DataFrame, kind: str, key: str, order: list[str]) -> DataFrame:
    """One blank decision per candidate in time order; ids only, no scores."""
    blank = lambda t: F.lit(None).cast(t)
    return candidates.select(key, *[c for c in order if c != key]).orderBy(*order).select(
        F.lit(kind).alias("record_type"), key, F.lit("").alias("decision"), F.lit("").alias("entailment_label"), blank("string").alias("merge_into"),
        blank("boolean").alias("conditions_preserved"), F.lit("").alias("reviewer"), blank("timestamp").alias("reviewed_at"))


def claim_gate_violations(claims: DataFrame, decisions: DataFrame) -> DataFrame:
    """What keeps the claim gate shut: missing, extra or double ids, unknown decisions, missing labels, bad merge targets."""
    sets = check_exact_set(claims, decisions, "claim_id")
    d = decisions
    bad = d.where(~F.coalesce("decision", F.lit("")).isin(*CLAIM_DECISIONS)).select("claim_id", F.lit("invalid_decision").alias("issue"))
    unlabeled = d.where(F.col("decision").isin("accept", "merge_into") & ~F.coalesce("entailment_label", F.lit("")).isin(*ENTAILMENT)).select("claim_id", F.lit("needs_entailment_label").alias("issue"))
    target = F.regexp_replace("merge_into", "^canonical\\.", "")
    merges = d.where("decision = 'merge_into'").select("claim_id", target.alias("_to"))
    accepted = d.where("decision = 'accept'").select(F.col("claim_id").cast("string").alias("_to"))
    lost = merges.join(accepted, "_to", "left_anti").select("claim_id", F.lit("merge_target_not_accepted").alias("issue"))
    return sets.unionByName(bad).unionByName(unlabeled).unionByName(lost)


def apply_claim_gate(claims: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, rejected, members): only accepted claims pass; merged claims extend the time range of their target.

    ``claims`` has ``claim_id, claim, start_s, end_s``; ``decisions`` has ``claim_id, decision, merge_into, canonical_claim``. The member table maps
    each accepted or merged claim to its target, so its evidence and records are found by a join.
    """
    d = decisions.select("claim_id", "decision", F.regexp_replace("merge_into", "^canonical\\.", "").alias("_to"), "canonical_claim")
    j = claims.join(d, "claim_id")
    taken = j.where("decision = 'accept'")
    own = taken.select(F.col("claim_id").cast("string").alias("target_id"), "claim_id", "start_s", "end_s", F.lit("accept").alias("how"))
    folded = j.where("decision = 'merge_into'").select(F.col("_to").alias("target_id"), "claim_id", "start_s", "end_s", F.lit("merge").alias("how"))
    members = own.unionByName(folded.join(own.select("target_id"), "target_id", "left_semi"))
    span = members.groupBy("target_id").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.count("*").alias("n_parents"))
    accepted = taken.select(F.col("claim_id").cast("string").alias("target_id"), "claim_id", F.coalesce(F.nullif(F.trim("canonical_claim"), F.lit("")), "claim").alias("canonical_claim")).join(span, "target_id")
    accepted = accepted.withColumn("canonical_claim_id", F.concat(F.lit("canonical."), "target_id"))
    rejected = j.where(~F.col("decision").isin("accept", "merge_into")).select("claim_id", "decision", F.col("claim").alias("rejected_claim"))
    return accepted, rejected, members.select("target_id", "claim_id", "how")


def theme_gate_violations(claims: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows that keep gate A shut. ``decisions`` has the fields of a theme claim review."""
    key = "theme_claim_id"
    d = decisions
    passing = F.col("decision").isin("accept", "edit", "split")
    flags = F.lit(True)
    for f in FLAGS:
        flags = flags & F.coalesce(F.col(f), F.lit(False))
    issue = (F.when(~F.coalesce("decision", F.lit("")).isin(*THEME_DECISIONS), "invalid_decision")
             .when(F.coalesce("reviewer", F.lit("")) == "", "missing_reviewer")
             .when(passing & ~F.coalesce("entailment_status", F.lit("")).isin(*SUPPORTED), "entailment_not_supported").when(passing & ~flags, "flag_not_true")
             .when(F.col("decision").isin("accept", "edit") & (F.coalesce(F.trim("final_statement"), F.lit("")) == ""), "missing_statement")
             .when((F.col("decision") == "split") & (F.size("split_statements") < 2), "split_needs_two_statements"))
    own = d.select(key, issue.alias("issue")).where("issue is not null")
    kept = d.where(F.col("decision").isin("accept", "edit")).select(F.col(key).alias("merge_into"))
    lost = d.where("decision = 'merge'").join(kept, "merge_into", "left_anti").select(key, F.lit("merge_target_not_accepted").alias("issue"))
    return check_exact_set(claims, decisions, key).unionByName(own).unionByName(lost)


def apply_theme_gate(claims: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(accepted, rejected, mapping, supports): accept and edit keep the id, split makes numbered ids, merge points to its target.

    ``claims`` has ``theme_claim_id, statement, first_seen_at, last_seen_at``. ``mapping`` has ``old_id, new_id, pos``; ``supports`` maps
    each accepted id to the claims whose families, speakers and evidence now count for it.
    """
    key = "theme_claim_id"
    d = decisions.select(key, "decision", "final_statement", "split_statements", F.col("merge_into").alias("_to"))
    j = claims.join(d, key)
    whole = j.where(F.col("decision").isin("accept", "edit")).select(key, F.col(key).alias("new_id"), F.trim("final_statement").alias("final"), F.lit(0).alias("pos"), "first_seen_at", "last_seen_at")
    parts = j.where("decision = 'split'").select(key, F.posexplode("split_statements").alias("pos", "final"), "first_seen_at", "last_seen_at")
    parts = parts.select(key, F.concat(F.col(key), F.lit(".split_"), F.lpad((F.col("pos") + 1).cast("string"), 2, "0")).alias("new_id"), F.trim("final").alias("final"), "pos", "first_seen_at", "last_seen_at")
    made = whole.unionByName(parts)
    merged = j.where("decision = 'merge'").join(whole.select(F.col("new_id").alias("_to")), "_to", "left_semi")
    mapping = made.select(F.col(key).alias("old_id"), "new_id", "pos").unionByName(merged.select(F.col(key).alias("old_id"), F.col("_to").alias("new_id"), F.lit(0).alias("pos")))
    supports = made.select("new_id", key).unionByName(merged.select(F.col("_to").alias("new_id"), key))
    span = merged.groupBy(F.col("_to").alias("new_id")).agg(F.min("first_seen_at").alias("_f"), F.max("last_seen_at").alias("_l"), F.count("*").alias("n_merged"))
    accepted = made.join(span, "new_id", "left").select(
        F.col("new_id").alias("theme_claim_id"), F.col("final").alias("statement"), F.least("first_seen_at", "_f").alias("first_seen_at"), F.greatest("last_seen_at", "_l").alias("last_seen_at"),
        F.coalesce("n_merged", F.lit(0)).alias("n_merged"), F.when(F.col(key) != F.col("new_id"), F.col(key)).alias("split_from"), F.lit("provisionally_accepted").alias("review_status"))
    rejected = j.where(F.col("decision").isin("reject", "defer_for_more_evidence")).select(key, "statement", F.col("decision").alias("review_status"))
    return accepted, rejected, mapping, supports


def accept_insights(insights: DataFrame, support: DataFrame, mapping: DataFrame, decisions: DataFrame) -> DataFrame:
    """Insights whose decision passes and that keep at least two distinct accepted supports.

    ``support`` has ``insight_id, theme_claim_id``; ``decisions`` has ``insight_id, decision``.
    """
    alive = support.join(mapping.select(F.col("old_id").alias("theme_claim_id"), "new_id"), "theme_claim_id").groupBy("insight_id").agg(F.count_distinct("new_id").alias("n_support"))
    j = insights.join(decisions.select("insight_id", "decision"), "insight_id").join(alive, "insight_id", "left").withColumn("n_support", F.coalesce("n_support", F.lit(0)))
    status = F.when(F.col("decision").isin("reject", "defer_for_more_evidence"), F.col("decision")).when(F.col("n_support") < 2, "lacks_support").otherwise("provisionally_accepted")
    return j.withColumn("review_status", status)


def remap_edges(edges: DataFrame, mapping: DataFrame, decisions: DataFrame) -> DataFrame:
    """Move edges to the accepted ids (the first part of a split), turn them round when the review says so, reject the rest.

    ``edges`` has ``relation_id, source_id, target_id, relation_type``; ``decisions`` has ``relation_id, decision, final_relation_type, direction_correct``.
    """
    first = mapping.groupBy("old_id").agg(F.min_by("new_id", F.struct("pos", "new_id")).alias("new_id"))
    j = edges.join(decisions.select("relation_id", "decision", "final_relation_type", "direction_correct"), "relation_id")
    j = j.join(first.select(F.col("old_id").alias("source_id"), F.col("new_id").alias("_s")), "source_id", "left").join(
        first.select(F.col("old_id").alias("target_id"), F.col("new_id").alias("_t")), "target_id", "left")
    status = F.when(F.col("_s").isNull() | F.col("_t").isNull(), "rejected_parent_claim").when(F.col("decision") == "reject", "rejected").otherwise("accepted")
    turn = (F.col("direction_correct") == False)  # noqa: E712 - a NULL flag keeps the direction
    j = j.withColumn("review_status", status).withColumn("_swap", F.coalesce(turn, F.lit(False)))
    ok = F.col("review_status") == "accepted"
    return j.select(
        "relation_id", F.when(ok, F.when(F.col("_swap"), F.col("_t")).otherwise(F.col("_s"))).alias("source_id"), F.when(ok, F.when(F.col("_swap"), F.col("_s")).otherwise(F.col("_t"))).alias("target_id"),
        F.when(ok, F.coalesce("final_relation_type", "relation_type")).otherwise(F.col("relation_type")).alias("relation_type"), "review_status")


def polarity_terms(c: Column) -> Column:
    """Polarity words, word stems and word beginnings found in a text."""
    low = F.lower(c)
    hits = [F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in R.POLARITY_STEMS]
    hits += [F.when(c.rlike(r"(?iU)\b" + t + r"\b"), F.lit(t)) for t in R.POLARITY_WORDS]
    hits += [F.when(c.rlike(r"(?iU)\b" + t + r"\w*\b"), F.lit(t)) for t in R.POLARITY_PREFIXES]
    return F.array_compact(F.array(*hits))


def local_risk_queue(claims: DataFrame, parents: DataFrame) -> DataFrame:
    """Risks of the final statement that a parent claim really carries: numbers, polarity terms and entities.

    ``claims`` has ``theme_claim_id, statement, claim_type``; ``parents`` has ``theme_claim_id, claim_id, claim, entity_risks``. One row per
    (claim, risk type, token) with the number of parents that carry it and whether an outside check is needed.
    """
    key = "theme_claim_id"
    s = F.col("statement")
    base = claims.select(key, "statement", "claim_type", X.matches(s, R.LOCAL_NUMBER).alias("_n"), polarity_terms(s).alias("_p"))
    p = parents.select(key, "claim_id", "claim", "entity_risks")
    # numbers of the statement, or those of the parents when the statement only speaks of a quantity
    worded = base.where((F.size("_n") == 0) & F.lower("statement").rlike(R.QUANTITY_WORDS)).select(key)
    stated = base.select(key, F.explode(F.array_distinct("_n")).alias("tok")).unionByName(p.join(worded, key).select(key, F.explode(X.matches("claim", R.LOCAL_NUMBER)).alias("tok")).distinct())
    num = stated.select(key, F.lit("numeric").alias("risk_type"), "tok")
    neg = base.select(key, F.lit("negation").alias("risk_type"), F.explode("_p").alias("tok"))
    ent = p.select(key, F.explode("entity_risks").alias("tok")).distinct().join(base.select(key, "statement"), key).where(F.contains(F.lower("statement"), F.lower("tok"))).select(key, F.lit("entity").alias("risk_type"), "tok")
    risks = num.unionByName(neg).unionByName(ent)
    seen = risks.join(p, key)
    carried = F.when(F.col("risk_type") == "negation", F.array_contains(polarity_terms(F.col("claim")), F.col("tok"))).otherwise(F.contains(F.lower("claim"), F.lower("tok")))
    q = seen.where(carried).groupBy(key, "risk_type", F.lower("tok").alias("risk_token")).agg(F.count_distinct("claim_id").alias("n_source_claims"), F.min("claim_id").alias("first_claim_id"))
    q = q.join(claims.select(key, "claim_type"), key)
    outside = (F.col("risk_type").isin("numeric", "negation") & (F.col("claim_type") != "open_question")) | F.col("claim_type").isin(*R.EXTERNAL_TYPES)
    return q.select(F.concat(F.lit("verify.local."), F.substring(F.sha2(F.concat_ws("|", key, "risk_type", "risk_token"), 256), 1, 10)).alias("queue_id"), key, "risk_type", "risk_token",
                    "n_source_claims", "first_claim_id", outside.alias("external_verification_required"))


def queue_reduction(old: DataFrame, new: DataFrame) -> DataFrame:
    """How much smaller the local queue is: upstream items without a local one, and items that collapsed into one.

    ``old`` has ``queue_id, theme_claim_id``; ``new`` has ``queue_id, theme_claim_id``.
    """
    local = new.select("theme_claim_id").distinct()
    covered = old.join(local, "theme_claim_id", "left_semi")
    n_old, n_cov = old.select("queue_id").distinct(), covered.select("queue_id").distinct()
    replacing = new.join(covered.select("theme_claim_id").distinct(), "theme_claim_id", "left_semi").select("queue_id").distinct()
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n")
    rows = one(n_old, "old").unionByName(one(n_cov, "covered")).unionByName(one(replacing, "replacing")).unionByName(one(new.select("queue_id").distinct(), "new"))
    pick = lambda name: F.max(F.when(F.col("k") == name, F.col("n")))
    total = F.greatest(F.lit(0), pick("old") - pick("new"))
    return rows.agg(pick("old").alias("original_count"), pick("new").alias("local_count"), (pick("old") - pick("covered")).alias("false_positive_count"),
                    F.greatest(F.lit(0), pick("covered") - pick("replacing")).alias("collapsed_duplicate_count"), total.alias("total_reduction"),
                    F.round(total / F.greatest(F.lit(1), pick("old")), 6).alias("reduction_rate"))


def readiness(claims: DataFrame, queue: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claim status, one readiness row) of gate B.

    ``claims`` has ``theme_claim_id, statement, epistemic_status``; ``queue`` has ``queue_id, theme_claim_id``; ``verdicts`` has ``queue_id,
    source_fidelity_status, external_fact_status``. Contradicted facts block; unchecked ones need outside work unless worded as a view.
    """
    j = queue.join(verdicts, "queue_id").join(claims.select("theme_claim_id", X.is_hedged("statement", F.coalesce("epistemic_status", F.lit(""))).alias("_h")), "theme_claim_id", "left")
    per = j.groupBy("theme_claim_id").agg(F.bool_or(F.col("source_fidelity_status") == "corrected").alias("_c"))
    status = claims.join(per, "theme_claim_id", "left").withColumn("verification_status", F.when(F.col("_c").isNull(), "source_fidelity_not_applicable").when(F.col("_c"), "source_fidelity_corrected").otherwise("source_fidelity_verified")).drop("_c")
    item = j.groupBy("queue_id", "source_fidelity_status", "external_fact_status").agg(F.bool_and(F.coalesce("_h", F.lit(False))).alias("_view"))
    open_ = F.col("external_fact_status").isin(*OPEN_FACTS)
    g = item.agg(F.count_if(F.col("external_fact_status") == "contradicted").alias("contradicted"), F.count_if(open_ & ~F.col("_view")).alias("unqualified_unchecked"),
                 F.count_if(open_ & F.col("_view")).alias("qualified_unchecked"), F.count_if(F.col("source_fidelity_status") == "rejected").alias("source_rejected"))
    state = F.when((F.col("contradicted") > 0) | (F.col("source_rejected") > 0), "blocked").when(F.col("unqualified_unchecked") > 0, "needs_external_verification").otherwise("ready")
    return status, g.withColumn("factual_readiness", state)
