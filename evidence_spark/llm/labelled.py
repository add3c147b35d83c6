"""Labelled rows for training: which of them a model may learn from, and a bounded, reproducible sample of their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % by


def held_out(doc_id: Column, by: int, part: int) -> Column:
    """Whether a row is kept from training. Rows with a null id have no label and so are neither; they count as not held out."""
    return F.coalesce(remainder(doc_id, by) == part, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, by: int, part: int, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled rows outside the held-out part, picked by the hash of their id.

    The picked ids are bounded by ``rows`` and broadcast. Null labels and ids without a document give nothing; an id labelled twice gives a
    row per label; of documents with the same id the text that sorts first counts, so there are never more than ``rows``.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), by) != part))
    picked = known.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).distinct().orderBy(F.xxhash64("_id", F.lit(by)), "_id", "_label").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    texts = found.select("_id", F.coalesce("text", F.lit("")).alias("text"), F.col("_label").alias("label"))
    if not found.groupBy("_id", "_label").count().where("count > 1").isEmpty():
        texts = texts.groupBy("_id", "label").agg(F.min("text").alias("text"))
    return texts.select("text", "label")
