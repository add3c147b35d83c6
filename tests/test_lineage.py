"""Ranges through cutting, joining and merging: the raw text at the ranges is the text."""

import random

import pytest
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.operators import claims as C
from evidence_spark.operators import lineage as L
from evidence_spark.operators import records as P
from evidence_spark.sources import tables as B

TURNS = [(1, 0, "  One is here. Two é日本 follows!  Three?"), (1, 1, ""), (1, 2, None), (1, 3, "Last one.  "), (2, 0, "Alone")]


def placed(spark, rows=TURNS):
    df = spark.createDataFrame(rows, "media_id long, seq long, text string").withColumn("rid", F.concat_ws(".", "media_id", "seq"))
    return df, L.laid_out(df, ["media_id"], ["seq"], F.col("rid"), F.lit("a")), L.raw_sources(df, ["media_id"], ["seq"], F.lit("a"))


def test_rows_and_their_pieces_lie_in_the_raw_text(spark):
    df, lineage, sources = placed(spark)
    texts = {r.rid: r.text or "" for r in df.collect()}
    raw = {r.media_id: r.text for r in sources.collect()}
    assert raw == {1: "\n".join(texts[f"1.{k}"] for k in range(4)), 2: "Alone"}
    assert {r.owner_id: r.cut for r in L.cut_out(lineage, sources, ["media_id"]).collect()} == texts
    pieces = L.pieces(df.drop("rid").withColumn("rid", F.concat_ws(".", "media_id", "seq")), ["media_id", "rid"], R.SENTENCE_BREAK)
    assert [(r.rid, r.piece) for r in pieces.orderBy("rid", "piece_no").collect()] == [
        ("1.0", "One is here."), ("1.0", "Two é日本 follows!"), ("1.0", "Three?"), ("1.3", "Last one."), ("2.0", "Alone")]
    children = pieces.select("media_id", F.concat_ws("/", "rid", "piece_no").alias("child_id"), F.col("rid").alias("owner_id"), "start", "end", "piece")
    got = {r.owner_id: r.cut for r in L.cut_out(L.compose(children, lineage, ["media_id"]), sources, ["media_id"]).collect()}
    assert got == {r.child_id: r.piece for r in children.collect()}


def test_composition_over_many_pieces_equals_plain_intervals(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    df, lineage, sources = placed(spark, [(1, k, w) for k, w in enumerate(words)])
    ends = [sum(len(w) + 1 for w in words[:k]) for k in range(60)]
    # one owner joined of all rows, then cut anywhere
    members = df.select("media_id", F.lit("all").alias("parent_id"), F.col("rid").alias("owner_id"), F.element_at(F.array(*[F.lit(e) for e in ends]), (F.col("seq") + 1).cast("int")).alias("at"))
    whole = L.merged(members, lineage, ["media_id"])
    text = "\n".join(words)
    spans = [(1, f"c{k}", "all", *sorted(rng.sample(range(len(text) + 1), 2))) for k in range(40)]
    got = L.cut_out(L.compose(spark.createDataFrame(spans, "media_id long, child_id string, owner_id string, start long, end long"), whole, ["media_id"], 16), sources, ["media_id"]).collect()
    for _, child, _, a, b in spans:
        want = [(max(e - a, 0), text[max(a, e): min(b, e + len(w))]) for e, w in zip(ends, words, strict=True) if a < e + len(w) and e < b]
        assert sorted((r.own_start, r.cut) for r in got if r.owner_id == child) == want


def test_unknown_sources_are_null_and_not_traced(spark):
    df, lineage, sources = placed(spark)
    some = sources.where("media_id = 2")
    assert {r.owner_id for r in L.cut_out(lineage, some, ["media_id"]).where("cut is not null").collect()} == {"2.0"}
    rows = L.with_lineage(df.withColumn("speaker", F.lit("x")).withColumn("start_s", F.lit(0.0)).withColumn("end_s", F.lit(1.0)), "rid", lineage, some, ["media_id"])
    records = P.canonical_records(rows.withColumnRenamed("rid", "record_id").withColumn("media_url", F.lit("https://example.org")), "text_single")
    seeds = records.groupBy("media_id").agg(F.collect_list("record_id").alias("record_ids")).withColumn("seed_id", F.lit("s"))
    evidence = C.bundle_evidence(seeds, records)
    assert {r.media_id: (len(r.source_hashes), r.source_ranges[0].source) for r in evidence.collect()} == {1: (0, "a"), 2: (1, "a")}
    assert L.traceability(evidence, ["media_id"]).orderBy("media_id").collect()[0].traceability_rate == 0
    plain = P.canonical_records(df.withColumnRenamed("rid", "record_id").withColumn("media_url", F.lit("u")).withColumn("start_s", F.lit(0.0)).withColumn("end_s", F.lit(1.0)).withColumn(
        "secondary_char_start", F.lit(3)).withColumn("secondary_char_end", F.lit(9)), "text_single")
    assert {tuple(r.source_ranges[0]) for r in plain.collect()} == {("secondary_transcript", 3, 9, None, "semantic_projection")}
    bare = C.bundle_evidence(seeds, records.drop("source_ranges", "source_hashes")).collect()
    assert {tuple(r.source_ranges[0]) for r in bare} == {("canonical_record", None, None, None, "record")} and all(not r.source_hashes for r in bare)


def test_lines_are_numbered_over_splits(spark, tmp_path):
    rows = [f'{{"n": {k}}}' if k % 7 else ("" if k % 2 else ("[1]" if k % 3 else "{broken")) for k in range(1, 3001)]
    (tmp_path / "a.jsonl").write_text("\n".join(rows) + "\n")
    (tmp_path / "b.jsonl").write_text('\n\n  \n"text"\n5\nnull\n{"n": 1}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = B.read_records(spark, str(tmp_path), "n long", "report").collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        with pytest.raises(Exception, match="malformed row in .*jsonl line [0-9]+"):
            B.read_records(spark, str(tmp_path), "n long").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {(r._file.rsplit("/", 1)[1], r._line): (r.n, r._corrupt) for r in got}
    want = {("a.jsonl", k): (k, None) if k % 7 else (None, rows[k - 1]) for k in range(1, 3001) if rows[k - 1]}
    want |= {("b.jsonl", 4): (None, '"text"'), ("b.jsonl", 5): (None, "5"), ("b.jsonl", 6): (None, "null"), ("b.jsonl", 7): (1, None)}
    assert found == want
