"""A training corpus from documents: quality, toxicity, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of documents.
Null and empty texts are scored like others; repeated rows are judged alike until the near-duplicate stage, where one of them stays.
Stages lower the session's bound of Arrow batches to 4 MB. Classifiers learn from the labelled rows of the documents table itself, outside the held-out parts of their queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence_spark.llm import decontaminate, packing, quality, shingles, toxicity
from evidence_spark.llm.queries import bounded_batches, read, vocabulary
from evidence_spark.session import cut


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality 1; the rest goes."""
    bounded_batches(spark)
    model = quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, "_score").where(F.col("_score") >= 0.5).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    bounded_batches(spark)
    model = toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, "_score").where(F.col("_score") < 0.5).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingle similarity 0.8 or more): that with the smallest id.

    SimHash links are the first candidates, a lossless prefix filter finds the pairs they miss; all are verified.
    """
    bounded_batches(spark)
    return shingles.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    bounded_batches(spark)
    return packing.pack(docs, vocabulary())


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near-duplicates", one_of_each), ("decontamination", clean_of_benchmark), ("packing", packed)]

#: No SQL says what the learned stages keep; the run is compared with plain Python versions of the stages in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
