"""The test tables seen as recordings, sections, claims and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence_spark.functions import text as X
from evidence_spark.operators.scan import scan

#: characters spoken per second, to give written turns a time line
PACE = 15.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. A table of one small file would be one task, so it is spread over the cores; larger ones keep their splits."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) == 1 and name in TEXT_TABLES else df


#: tables whose rows cost much work each
TEXT_TABLES = ("documents", "conversations", "pages", "embeddings")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as cues: start is the running length over the pace, end the next start."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("media_id"), F.col("turn").alias("seq"), F.col("role").alias("speaker"), "text"
    )
    timed = scan(turns, ["media_id"], ["seq"], sums_before={"_chars": F.length("text")})
    return timed.select(
        "media_id", "seq", "speaker", "text",
        (F.col("_chars") / PACE).alias("start_s"),
        ((F.col("_chars") + F.length("text")) / PACE).alias("end_s"),
    )


CUES_SQL = """
cues AS (
  SELECT conv_id AS media_id, turn AS seq, role AS speaker, text,
    (sum(length(text)) OVER w - length(text)) / 15.0 AS start_s, (sum(length(text)) OVER w) / 15.0 AS end_s
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""


def coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, coarser source: pairs of turns joined and shifted by two seconds."""
    c = cues(spark, sf_dir).withColumn("seq2", F.floor(F.col("seq") / 2))
    return c.groupBy("media_id", F.col("seq2").alias("seq")).agg(
        (F.min("start_s") + 2).alias("start_s"), (F.max("end_s") + 2).alias("end_s"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("text"),
    )


COARSE_SQL = """
coarse AS (
  SELECT media_id, seq // 2 AS seq, min(start_s) + 2 AS start_s, max(end_s) + 2 AS end_s,
    string_agg(text, ' ' ORDER BY seq) AS text
  FROM cues GROUP BY media_id, seq // 2)"""


def sentence_rows(df: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """One row per trimmed sentence with its position."""
    out = df.select("*", F.posexplode(X.sentences(text)).alias("sent_no", "sentence"))
    return out.where(F.length("sentence") >= min_chars)


def joined(c: Column) -> Column:
    """An array as one string, the form both engines print alike."""
    return F.array_join(c, "|")
