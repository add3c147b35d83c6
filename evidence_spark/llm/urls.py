"""URL rules: host-suffix and path-prefix expressions joined on short hashes, confirmed by full digests.

DataFrame functions only. A rule (host, path, verdict) fits its host and every subdomain when the path of the URL starts
with the path of the rule; the rule whose host and path together are longest wins, then the longer host, then ``block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII texts (as many characters as bytes) take the much faster ``lower``."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _folder(path: Column) -> Column:
    """The part of a rule path up to its last slash: what a URL expression can equal."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _host_suffixes(host: Column, labels: int) -> Column:
    """The last 1 to ``labels`` labels of a host, and the host itself. No rule has more labels, so no longer suffix can match."""
    parts = F.split(host, r"\.")
    n = F.least(F.size(parts), F.lit(labels))
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))


def _path_prefixes(path: Column, depth: int) -> Column:
    """The empty prefix and those ending at one of the first ``depth`` slashes. No rule folder is deeper."""
    parts = F.split(path, "/")
    n = F.least(F.size(parts) - 1, F.lit(depth))
    return F.transform(F.sequence(F.lit(0), n), lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, F.greatest(k, F.lit(1))), "/"), F.lit("/"))))


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(" "), folder), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their expression digests. Null hosts match nothing, null paths are empty, repeated rules count once."""
    r = rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"),
    ).distinct()
    return r.withColumn("_rule_digest", _digest(F.col("rule_host"), _folder(F.col("rule_path")))).withColumn("_short", F.substring("_rule_digest", 1, 8))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict columns (existing columns of these names are replaced).

    Null URLs and URLs without ``://`` have an empty host and path, no rule and the ``default`` verdict. Repeated rows stay repeated.
    An empty rule table gives every row the default. Rules are matched once per distinct (host, path), so a hot URL is judged once;
    the expressions are as deep as the deepest rule, which loses nothing.
    """
    r = prepare_rules(rules)
    deepest = r.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(F.size(F.split(_folder(F.col("rule_path")), "/")) - 1).alias("depth")).first()
    base = pages.drop("host", "path", "rule", "verdict").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    keys = base.where(F.col("host") != "").select("host", "path").distinct()
    expressions = (
        keys.select("host", "path", F.explode(_host_suffixes(F.col("host"), deepest["labels"] or 1)).alias("_suffix"))
        .select("host", "path", "_suffix", F.explode(_path_prefixes(F.col("path"), deepest["depth"] or 0)).alias("_prefix"))
        .withColumn("_full", _digest(F.col("_suffix"), F.col("_prefix")))
        .withColumn("_short", F.substring("_full", 1, 8))
    )
    hits = expressions.join(r, "_short").where((F.col("_full") == F.col("_rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    precedence = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "block").alias("b"),
        "rule_host", "rule_path", "rule_verdict",
    )
    won = hits.groupBy("host", "path").agg(F.max(precedence).alias("_won")).select(
        "host", "path", F.concat("_won.rule_host", "_won.rule_path").alias("rule"), F.col("_won.rule_verdict").alias("_verdict"))
    return base.join(won, ["host", "path"], "left").withColumn("verdict", F.coalesce("_verdict", F.lit(default))).drop("_verdict")
