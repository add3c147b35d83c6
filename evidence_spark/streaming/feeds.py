"""Streams: ingest with content-hash dedup, live caption dedup, topic sessions and event counts.

Watermarks bound the state; rows later than the watermark are dropped by Spark and counted in the query progress.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.functions.keys import content_hash


def read_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def ingest_feed(feed: DataFrame, at: str = "at", text: str = "text", delay: str = "1 day") -> DataFrame:
    """First row per (source, content hash) inside the watermark."""
    return feed.withColumn("content_hash", content_hash(text)).withWatermark(at, delay).dropDuplicatesWithinWatermark(["source_id", "content_hash"])


KEYS = "source_id string, content_hash string, batch_id long, prefix string"


def write_batch(batch: DataFrame, batch_id: int, table_path: str, process: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One micro-batch of :func:`ingest_sink`: rows, then their keys, then the entry in the manifest; each in a folder of this batch that a replay overwrites.

    Keys lie by hash prefix; a batch reads the prefixes it holds, and never its own keys, so a replay finds the table as the first attempt did.
    """
    spark = batch.sparkSession
    rows = batch.dropDuplicates(["source_id", "content_hash"]).withColumn("prefix", F.substring("content_hash", 1, 2)).persist()
    try:
        prefixes = [r[0] for r in rows.select("prefix").distinct().collect()]  # two hex digits: at most 256
        known = spark.read.schema(KEYS).parquet(f"{table_path}.keys").where(F.col("prefix").isin(prefixes) & (F.col("batch_id") != batch_id))
        rows = rows.withColumn("_source", F.col("source_id").cast("string"))
        new = rows.join(known.select(F.col("source_id").alias("_source"), "content_hash"), ["_source", "content_hash"], "left_anti")
        kept = new.select(*batch.columns)
        (process(kept) if process else kept).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        keys = new.select(F.col("_source").alias("source_id"), "content_hash", "prefix").repartition("prefix")
        keys.write.mode("overwrite").partitionBy("prefix").parquet(f"{table_path}.keys/batch_id={batch_id}")
        spark.range(1).select(F.lit(batch_id).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{table_path}.manifest/batch_id={batch_id}")
    finally:
        rows.unpersist()


def ingest_sink(feed: DataFrame, table_path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame] | None = None):
    """Add rows whose (source, hash) is not in the table yet, exactly once: a batch that is replayed after a failure rewrites its own files.

    Read the table by :func:`read_ingested`, which leaves out batches that did not end.
    """
    empty = feed.sparkSession.createDataFrame([], "batch long")
    for part in ("keys", "manifest"):
        empty.write.mode("ignore").parquet(f"{table_path}.{part}")  # nothing happens if the folder exists
    return feed.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, table_path, process)).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of the batches in the manifest, with their ``batch_id``."""
    done = spark.read.schema("batch long, batch_id long").parquet(f"{table_path}.manifest").where("batch is not null").select(F.col("batch").alias("batch_id"))
    return spark.read.parquet(table_path).join(done, "batch_id", "left_semi")


NOVEL = T.StructType([T.StructField("media_id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("novel", T.StringType())])
TAIL = T.StructType([T.StructField("tail", T.ArrayType(T.StringType()))])


def novel_captions(feed: DataFrame, tail_tokens: int = 400, ttl_ms: int = 3_600_000) -> DataFrame:
    """Live twin of ``dedup_rolling``: new words of rolling captions per recording, in arrival batches ordered by ``seq``.

    The state is the end of what was emitted (``tail_tokens`` words; at least the longest cue); an idle recording is forgotten.
    """
    import re

    token, word, other = re.compile(R.CAPTION_TOKEN), re.compile(R.LONG_WORD), re.compile("[^a-z0-9]+")

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        tail = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(parts)).sort_values("seq")
        out = []
        for seq, text in zip(rows["seq"], rows["text"]):
            found = list(token.finditer(text))
            current = [other.sub("", m.group(0).lower()) for m in found]
            overlap = next((n for n in range(min(len(tail), len(current)), 0, -1) if tail[-n:] == current[:n]), 0)
            if overlap >= len(current):
                continue
            novel = text[found[overlap].start():].strip()
            if not word.search(novel):
                continue
            tail = (tail + current[overlap:])[-tail_tokens:]
            out.append([key[0], int(seq), novel])
        state.update((tail,))
        state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(out, columns=["media_id", "seq", "novel"])

    return feed.groupBy("media_id").applyInPandasWithState(step, NOVEL, TAIL, "append", GroupStateTimeout.ProcessingTimeTimeout)


def overlap(tail: list[str], words: list[str]) -> int:
    """Length of the longest start of ``words`` that ends ``tail``, in one pass (prefix function)."""
    if not words:
        return 0
    links, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = links[k - 1]
        k += words[i] == words[k]
        links[i] = k
    k = 0
    for word in tail[-len(words):]:
        while k and (k == len(words) or word != words[k]):
            k = links[k - 1]
        k += word == words[k]
    return k


class CaptionProcessor(StatefulProcessor):
    """New words of a recording's captions in order of (time, ``seq``). A row waits until the watermark has passed its time; the words that were
    emitted stay until no row came for ``ttl_ms`` of event time."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at_ms long, seq long, text string")
        self.words = handle.getListState("words", "word string")
        self.latest = handle.getValueState("latest", "at_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        news = [(int(a), int(s), t) for part in rows for a, s, t in zip(part["at_ms"], part["seq"], part["text"]) if t is not None]
        if news:
            for row in news:
                self.waiting.appendValue(row)
            last = max(a for a, _, _ in news)
            if not self.latest.exists() or self.latest.get()[0] < last:
                self.latest.update((last,))
            for at in {a for a, _, _ in news} | {last + self.ttl_ms}:
                self.handle.registerTimer(at)
        yield pd.DataFrame({"media_id": [], "seq": [], "novel": []}).astype({"media_id": "int64", "seq": "int64", "novel": "object"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        import re

        token, word, other = re.compile(R.CAPTION_TOKEN), re.compile(R.LONG_WORD), re.compile("[^a-z0-9]+")
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        waiting = [tuple(r) for r in self.waiting.get()]
        ready = sorted(r for r in waiting if r[0] <= now)
        out, tail = [], [r[0] for r in self.words.get()] if ready else []
        for _, seq, text in ready:
            found = list(token.finditer(text))
            current = [other.sub("", m.group(0).lower()) for m in found]
            n = overlap(tail, current)
            if n >= len(current):
                continue
            novel = text[found[n].start():].strip()
            if not word.search(novel):
                continue
            for w in current[n:]:
                self.words.appendValue((w,))
            tail += current[n:]
            out.append([key[0], seq, novel])
        if ready:
            self.waiting.clear()
            for row in waiting:
                if row[0] > now:
                    self.waiting.appendValue(row)
        elif not waiting and self.latest.exists() and self.latest.get()[0] + self.ttl_ms <= now:
            self.words.clear()
            self.latest.clear()
        yield pd.DataFrame(out, columns=["media_id", "seq", "novel"]).astype({"media_id": "int64", "seq": "int64"})

    def close(self) -> None:
        pass


def live_captions(feed: DataFrame, at: str = "at", delay: str = "10 seconds", ttl_ms: int = 21_600_000) -> DataFrame:
    """(media_id, seq, novel): live twin of ``dedup_rolling`` by event time, the same rows whatever the batches and the speed of the feed.

    ``feed`` has ``media_id, seq, text`` and a timestamp ``at``. Rows that come after the watermark (``delay``) has passed their time are dropped by
    Spark and counted in the query progress; rows without text are left out. A later cue can be longer than all before it, so the state holds
    all words of a recording until it is idle for ``ttl_ms`` of event time. Needs the RocksDB state store.
    """
    rows = feed.withWatermark(at, delay).select("media_id", "seq", "text", at, F.unix_millis(F.col(at)).alias("at_ms"))
    return rows.groupBy("media_id").transformWithStateInPandas(CaptionProcessor(ttl_ms), NOVEL, "Append", "EventTime")


def topic_session_feed(feed: DataFrame, at: str = "at", gap: str = "90 seconds", delay: str = "10 minutes", topics=None) -> DataFrame:
    """Sessions of a topic per recording: a pause longer than ``gap`` closes one. The same code runs on a batch."""
    rows = feed.withColumn("topic", F.explode(X.tag_topics("text", topics)))
    if feed.isStreaming:
        rows = rows.withWatermark(at, delay)
    s = rows.groupBy("media_id", "topic", F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))
    return s.select("media_id", "topic", F.col("w.start").alias("start_at"), F.col("w.end").alias("end_at"), "n_rows", "n_chars")


def event_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", size: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events per kind in tumbling (or, with ``slide``, sliding) windows. The same code runs on a batch."""
    rows = events.withWatermark(at, delay) if events.isStreaming else events
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return rows.groupBy(w.alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")
