import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from evidence_spark.operators import sequence as S
from evidence_spark.streaming import feeds


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def drain(query):
    q = query.start()
    q.awaitTermination(120)
    q.stop()


def test_ingest_adds_each_content_once(spark, tmp_path):
    src = tmp_path / "in"
    at = "2024-01-01T00:00:0%dZ"
    write(src, "1.json", [{"source_id": "a", "text": "x", "at": at % 1}, {"source_id": "a", "text": "x", "at": at % 2}, {"source_id": "b", "text": "x", "at": at % 3}])
    schema = spark.read.json(str(src)).withColumn("at", F.to_timestamp("at")).schema
    table, check = str(tmp_path / "table"), str(tmp_path / "check")
    for name, rows in (("1.json", None), ("2.json", [{"source_id": "a", "text": "x", "at": at % 4}, {"source_id": "a", "text": "y", "at": at % 5}])):
        if rows:
            write(src, name, rows)
        feed = feeds.ingest_feed(feeds.read_feed(spark, str(src), schema))
        drain(feeds.ingest_sink(feed, table, check))
    assert sorted((r.source_id, r.text) for r in spark.read.parquet(table).collect()) == [("a", "x"), ("a", "y"), ("b", "x")]


def test_live_captions_equal_the_batch(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta theta kappa lambda sigma".split()
    rows = [{"media_id": m, "seq": i, "text": " ".join(words[max(0, i - 2):i + 2]), "speaker": "x", "start_s": float(i), "end_s": i + 1.0} for m in (1, 2) for i in range(9)]
    src = tmp_path / "in"
    write(src, "1.json", [r for r in rows if r["seq"] < 5])
    schema = "media_id long, seq long, text string, speaker string, start_s double, end_s double"
    from pyspark.sql.types import _parse_datatype_string

    want = {(r.media_id, r.seq): r.novel for r in S.dedup_rolling(spark.createDataFrame([tuple(r[k] for k in ("media_id", "seq", "text", "speaker", "start_s", "end_s")) for r in rows], schema)).collect()}
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for name in ("1.json", "2.json"):
        if name == "2.json":
            write(src, name, [r for r in rows if r["seq"] >= 5])
        feed = feeds.read_feed(spark, str(src), _parse_datatype_string(schema))
        drain(feeds.novel_captions(feed).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True))
    got = {(r.media_id, r.seq): r.novel for r in spark.read.parquet(out).collect()}
    assert got == want


def test_windows_equal_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "in")
    # a last event far ahead moves the watermark past all windows
    late = events.orderBy(F.col("ts").desc()).limit(1).withColumn("ts", F.col("ts") + F.expr("interval 30 days"))
    events.unionByName(late).coalesce(1).sortWithinPartitions("ts").write.parquet(src)
    for kwargs in ({}, {"slide": "30 minutes"}):
        batch = {tuple(r) for r in feeds.event_counts(events, **kwargs).collect()}
        out, check = str(tmp_path / f"o{len(kwargs)}"), str(tmp_path / f"c{len(kwargs)}")
        stream = feeds.event_counts(spark.readStream.schema(events.schema).parquet(src), **kwargs)
        drain(stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", check).trigger(availableNow=True))
        assert {tuple(r) for r in spark.read.parquet(out).collect()} == batch


def test_topic_sessions_stream(spark, tmp_path):
    rows = [(1, f"2024-01-01 00:0{m}:{s:02d}", t) for m, s, t in ((0, 0, "this one"), (1, 0, "that too"), (4, 0, "this again"), (4, 30, "nothing"))]
    batch = spark.createDataFrame(rows, "media_id long, at string, text string").withColumn("at", F.to_timestamp("at"))
    pack = {"near": [r"\bthis\b", r"\bthat\b"]}
    assert sorted(r.n_rows for r in feeds.topic_session_feed(batch, topics=pack).collect()) == [1, 2]
    src = str(tmp_path / "in")
    ahead = spark.createDataFrame([(9, "2024-01-03 00:00:00", "this")], "media_id long, at string, text string").withColumn("at", F.to_timestamp("at"))
    batch.unionByName(ahead).coalesce(1).write.parquet(src)
    out, check = str(tmp_path / "o"), str(tmp_path / "c")
    stream = feeds.topic_session_feed(spark.readStream.schema(batch.schema).parquet(src), topics=pack)
    drain(stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", check).trigger(availableNow=True))
    assert sorted(r.n_rows for r in spark.read.parquet(out).where("media_id = 1").collect()) == [1, 2]


def test_replayed_batches_add_nothing(spark, tmp_path):
    at = "2024-01-01T00:00:0%dZ"
    src, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    write(src, "1.json", [{"source_id": "a", "text": "x", "at": at % 1}, {"source_id": "b", "text": "x", "at": at % 3}])
    schema = spark.read.json(str(src)).withColumn("at", F.to_timestamp("at")).schema
    feed = lambda: feeds.read_feed(spark, str(src), schema).withColumn("content_hash", F.sha2("text", 256))
    rows = lambda: sorted((r.source_id, r.text) for r in feeds.read_ingested(spark, table).collect())
    drain(feeds.ingest_sink(feed(), table, check))
    write(src, "2.json", [{"source_id": "a", "text": t, "at": at % 4} for t in "xyz"])

    def killed(_df):
        raise RuntimeError("killed")

    with pytest.raises(StreamingQueryException):
        drain(feeds.ingest_sink(feed(), table, check, killed))
    assert rows() == [("a", "x"), ("b", "x")]
    drain(feeds.ingest_sink(feed(), table, check))
    want = [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x")]
    assert rows() == want
    # the same batch again, as after a loss before the stream's own checkpoint, and one that had written rows and keys only
    batch = spark.read.schema(schema).json(str(src / "2.json")).withColumn("content_hash", F.sha2("text", 256))
    feeds.write_batch(batch, 1, table)
    assert rows() == want
    feeds.write_batch(batch, 2, table)
    assert rows() == want
    spark.createDataFrame([("c", "lost")], "source_id string, text string").write.parquet(f"{table}/batch_id=3")
    assert rows() == want


@pytest.mark.parametrize("cuts", [[20], [3, 9], [1, 2, 4, 6, 8, 10]])
def test_captions_by_event_time_equal_the_batch_for_all_cuts(spark, tmp_path, cuts):
    words = "alpha beta gamma delta epsilon zeta theta kappa lambda sigma omega".split()
    texts = [" ".join(words[max(0, i - 2):i + 2]) for i in range(9)] + [" ".join(words), " ".join(words) + " and more", None]
    rows = [(m, i, t, f"2024-01-01 00:{10 + i // 2}:00") for m in (1, 2) for i, t in enumerate(texts)]
    order = sorted(rows, key=lambda r: (r[1] ^ 1, r[0]))  # neighbours swapped: they come out of order
    batch = spark.createDataFrame([(m, i, t, "x", float(i), i + 1.0) for m, i, t, _ in rows if t], "media_id long, seq long, text string, speaker string, start_s double, end_s double")
    want = sorted((r.media_id, r.seq, r.novel) for r in S.dedup_rolling(batch).collect())
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    parts = [order[a:b] for a, b in zip([0, *(2 * c for c in cuts)], [*(2 * c for c in cuts), len(order)])]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k, part in enumerate([p for p in parts if p] + [[(9, 0, "end", "2024-01-01 01:00:00")]]):
            write(src, f"{k:02d}.json", [dict(zip(("media_id", "seq", "text", "at"), r)) for r in part])
            os.utime(src / f"{k:02d}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # files are read by age
        feed = spark.readStream.schema("media_id long, seq long, text string, at timestamp").option("maxFilesPerTrigger", 1).json(str(src))
        drain(feeds.live_captions(feed, delay="2 minutes").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted((r.media_id, r.seq, r.novel) for r in spark.read.parquet(out).where("media_id < 9").collect()) == want
