"""Claims of an article corpus: sentences of known speakers that carry a theme."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X


def corpus_claims(sections: DataFrame, keywords: Mapping[str, Sequence[str]] | None = None, min_chars: int = 45) -> DataFrame:
    """``sections`` has ``section_id, source_id, family, speaker, text, published_at`` and maybe ``section_title``."""
    known = sections.where(F.coalesce("speaker", F.lit("unknown")) != "unknown")
    rows = known.select("*", F.posexplode(F.transform(F.split("text", R.CORPUS_SENTENCE_BREAK), X.strip)).alias("_pos", "claim")).where(F.length("claim") >= min_chars)
    own = X.tag_keywords("claim", keywords)
    themes = F.when(F.size(own) > 0, own).otherwise(X.tag_keywords(F.coalesce("section_title", F.lit("")), keywords)) if "section_title" in sections.columns else own
    rows = rows.withColumn("themes", themes).where(F.size("themes") > 0).withColumn("claim_type", X.claim_type("claim", pack="corpus"))
    vt = X.corpus_value_types("claim", "claim_type")
    rows = rows.withColumn("value_types", vt).withColumn("_risk", F.struct(
        X.sorted_set(X.matches("claim", R.CORPUS_NUMBER)).alias("numeric_risks"), X.sorted_set(X.matches("claim", R.MODEL)).alias("entity_risks"),
        X.sorted_set(X.matches("claim", R.CORPUS_NEGATION)).alias("negation_risks")))
    scope = (F.when(F.col("claim_type") == "prediction", "speaker_prediction").when(F.col("claim_type") == "personal_experience", "speaker_personal_experience")
             .otherwise("speaker_direct_claim"))
    return rows.select(
        F.concat(F.col("section_id").cast("string"), F.lit(".claim_"), F.lpad((F.col("_pos") + 1).cast("string"), 4, "0")).alias("claim_id"),
        (F.col("section_id") * 1_000_000 + F.col("_pos")).alias("pos"), "section_id", "source_id", "family", "speaker", "published_at", "claim", "claim_type", "value_types", "themes", scope.alias("attribution_scope"),
        F.array(F.concat(F.col("section_id").cast("string"), F.lit(".evidence"))).alias("evidence_ids"),
        F.array(F.col("section_id").cast("string")).alias("source_record_ids"), F.lit(0.97).alias("confidence"),
        X.corpus_importance("claim", "claim_type", "themes").alias("importance_score"),
        F.when(F.array_contains("value_types", "route_change"), 0.72).otherwise(0.52).alias("novelty_score"),
        F.when(F.array_contains("value_types", "non_consensus"), 0.78).otherwise(0.25).alias("non_consensus_score"),
        "_risk.numeric_risks", "_risk.entity_risks", "_risk.negation_risks",
        ((F.size("_risk.numeric_risks") > 0) | (F.size("_risk.negation_risks") > 0)).alias("needs_verification"), F.lit(True).alias("exact_quote_allowed"),
        F.lit("source_provided").alias("speaker_status"))
