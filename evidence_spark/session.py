"""Session helpers: configuration, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows stay below this bound.
BROADCAST_ROWS = 100_000


def build_session(app: str = "evidence-spark", master: str | None = None, shuffle: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "16g")
    if shuffle:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle))
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for local masters without a setting."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="evidence-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and drop its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``rows`` rows, else leave the join strategy to Spark.

    ``limit`` stops the count early, so the check reads no more than it needs.
    """
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash rows over a fixed number of partitions before heavy Python work.

    Adaptive execution sizes partitions by bytes; a few small rows can hide much work per row.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), *cols)


def byte_batches(spark: SparkSession, mb: int = 16) -> None:
    """Bound Arrow batches by bytes, for rows that hold many texts or vectors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
