"""Contract and integrity checks that return violations as rows, and comparisons of id sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """Raised by writers that refuse rows with violations."""


def violations(df: DataFrame, contract: Mapping[str, Mapping[str, Any]], key: str) -> DataFrame:
    """One row per broken rule: ``key, column, rule``.

    Rules per column: ``required``, ``enum``, ``min``, ``max``, ``pattern``, ``min_items``. Optional columns pass when NULL.
    """
    rules = []
    for column, spec in contract.items():
        c = F.col(column)
        checks = {
            "required": c.isNull() if spec.get("required") else None,
            "enum": ~c.isin(*spec["enum"]) if "enum" in spec else None,
            "min": c < spec["min"] if "min" in spec else None,
            "max": c > spec["max"] if "max" in spec else None,
            "pattern": ~c.rlike(spec["pattern"]) if "pattern" in spec else None,
            "min_items": F.size(c) < spec["min_items"] if "min_items" in spec else None,
        }
        rules += [F.when(broken, F.struct(F.lit(column).alias("column"), F.lit(name).alias("rule"))) for name, broken in checks.items() if broken is not None]
    return df.select(F.col(key), F.explode(F.array_compact(F.array(*rules))).alias("_v")).select(key, "_v.column", "_v.rule")


def check_contract(df: DataFrame, contract: Mapping[str, Mapping[str, Any]], key: str, examples: int = 5) -> DataFrame:
    """Broken rules with their count and the first few keys. Each map task keeps only ``examples`` keys per rule."""
    from evidence_spark.operators.claims import top_per_key

    bad = violations(df, contract, key)
    n = bad.groupBy("column", "rule").agg(F.count("*").alias("n_violations"))
    first = top_per_key(bad, ["column", "rule"], [F.col(key)], examples).groupBy("column", "rule").agg(F.array_sort(F.collect_list(key)).alias("examples"))
    return n.join(first, ["column", "rule"])


def check_integrity(evidence: DataFrame, claims: DataFrame, evidence_id: str = "evidence_id") -> DataFrame:
    """Evidence ids present and unique, ends not before starts, a link on every row, no reference into nothing."""
    e = evidence
    twice = e.where(F.col(evidence_id).isNotNull()).groupBy(evidence_id).agg(F.count("*").alias("n")).where("n > 1")
    refs = claims.select("claim_id", F.explode("evidence_ids").alias(evidence_id))
    orphans = refs.join(e.select(evidence_id), evidence_id, "left_anti")
    text = lambda df, rule, ref: df.select(F.lit(rule).alias("rule"), F.col(ref).cast("string").alias("ref"))
    return (
        text(e.where(F.col(evidence_id).isNull()), "missing_id", evidence_id)
        .unionByName(text(twice, "duplicate_id", evidence_id))
        .unionByName(text(e.where(F.col("end_s") < F.col("start_s")), "ends_before_start", evidence_id))
        .unionByName(text(e.where(F.coalesce("source_url", F.lit("")) == ""), "missing_link", evidence_id))
        .unionByName(text(orphans, "orphan_reference", "claim_id")))


def require_clean(found: DataFrame) -> None:
    """Refuse to go on when a violations table has rows."""
    sample = found.limit(5).collect()
    if sample:
        raise ContractError("; ".join(str(r.asDict()) for r in sample))


def check_exact_set(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Ids that are decided twice, missing or unexpected; an empty result means the sets are equal."""
    counts = got.groupBy(key).agg(F.count("*").alias("_n"))
    both = expected.select(key).distinct().withColumn("_e", F.lit(1)).join(counts, key, "full_outer")
    issue = F.when(F.col("_e").isNull(), "extra").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate")
    return both.select(key, issue.alias("issue")).where("issue is not null")


def compare_sets(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct values with the side they occur on: both, left or right."""
    left, right = a.select(col).distinct().withColumn("_a", F.lit(1)), b.select(col).distinct().withColumn("_b", F.lit(1))
    side = F.when(F.col("_a").isNull(), "right").when(F.col("_b").isNull(), "left").otherwise("both")
    return left.join(right, col, "full_outer").select(col, side.alias("side"))
