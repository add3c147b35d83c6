"""The registered queries of the training-data operators and the SQL that must give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence_spark.llm import decontaminate, extract, impacts, packing, quality, runs, simhash, tokens, toxicity, urls, vptree, warc, whitening
from evidence_spark.session import checkpoint_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch on its way to a worker: buffers double as they grow, and a task holds some on both sides.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bound of Arrow batches to BATCH_BYTES, so that a batch of long texts stays small."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op6_url_rules", f"""WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule_host, rule_path, rule_verdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
fits AS (SELECT page_id, host, path, rule_host, rule_path, rule_verdict FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS rn FROM fits)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict FROM best WHERE rn = 1""")
def _(spark, sf):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.filter_urls(read(spark, sf, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


_WORDS = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')".format(_LOWER.format("coalesce(text, '')"))


@query("op10_decontaminate", f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), bw AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
grams AS (SELECT DISTINCT item, least(len(w), 13) AS m, unnest(list_transform(range(0, (len(w) - least(len(w), 13) + 1)::BIGINT), lambda i: w[i + 1 : i + least(len(w), 13)])) AS gram FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM grams),
wins AS (SELECT doc_id, m, unnest(range(1, (len(w) - m + 2)::BIGINT)) AS pos, w FROM dw, sizes WHERE len(w) >= m),
seen AS (SELECT doc_id, m, pos, w[pos : pos + m - 1] AS gram FROM wins),
hit AS (SELECT DISTINCT a.doc_id, a.pos, a.m, g.item FROM seen a JOIN grams g ON a.gram = g.gram),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""")
def _(spark, sf):
    found = decontaminate.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_token_counts")
def _(spark, sf):
    return tokens.count_tokens(read(spark, sf, "documents"), vocabulary())


@query("op7_pack")
def _(spark, sf):
    return packing.pack(read(spark, sf, "documents"), vocabulary())


@query("op4_simhash")
def _(spark, sf):
    return simhash.near_duplicates(read(spark, sf, "documents"))


@query("op3_quality")
def _(spark, sf):
    docs = read(spark, sf, "documents")
    return quality.score_quality(docs, quality.train(docs, read(spark, sf, "labels")))


@query("op5_toxicity")
def _(spark, sf):
    docs = read(spark, sf, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read(spark, sf, "labels")))


@query("op9_vantage_points")
def _(spark, sf):
    vectors = read(spark, sf, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op1_arc_to_warc")
def _(spark, sf):
    return warc.archive_pages(read(spark, sf, "pages"), f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}")


@query("op8_main_text")
def _(spark, sf):
    return extract.extract_pages(read(spark, sf, "pages"))


@query("op12_periodic_runs")
def _(spark, sf):
    found = runs.periodic_runs(runs.with_repeated_tail(read(spark, sf, "documents").select("doc_id", "text")))
    # the longest run; of equally long ones the first, then that of the smallest period
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("_best", F.array_max(order))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("_best.length * 1000 div -_best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op11_whitening")
def _(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", whitening.whole_numbers(F.col("embedding"), 64, 1_000_000).alias("x"))
    return whitening.whitened(rows, whitening.fit(rows, 16))


@query("op13_exact_top")
def _(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", impacts.whole_numbers(F.col("embedding"), 1024).alias("x"))
    return impacts.exact_top(rows, rows.where("vec_id % 100 = 0"), 10)
