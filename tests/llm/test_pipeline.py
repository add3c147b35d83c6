"""The pipeline against plain Python versions of its stages, on the smallest tables."""

import tempfile
import zlib

import corpus_pipeline as C
from test_shingles import brute_groups
from test_urls_decontaminate import brute

from evidence_spark.llm import quality, toxicity
from evidence_spark.llm.queries import read, vocabulary

SMALL = "/root/testdata/sf0.001"


def test_every_stage_equals_its_plain_version(spark):
    sf, folder = str(SMALL), tempfile.mkdtemp(prefix="stages-")
    documents, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    judge_quality, judge_toxic = quality.train(documents, labels), toxicity.train(documents, labels)
    bucket, bias = judge_quality.folded()
    scorer = quality.Scorer(bucket, bias)

    def plain_near(rows):
        rows = sorted(rows)
        return [rows[k] for k in sorted(set(brute_groups([t for _, t in rows])))]

    plain = {
        "quality": lambda rows: [r for r in rows if scorer(r[1]) >= 0],
        "toxicity": lambda rows: [r for r in rows if judge_toxic.probability(*toxicity.scan(r[1], judge_toxic)) < 0.5],
        "near-duplicates": plain_near,
        "decontamination": lambda rows: [r for r in rows if not any(k[5] for k in brute([r], items, 13))],
    }
    items = [tuple(r) for r in read(spark, sf, "benchmark").select("item_id", "text").collect()]
    docs, columns = documents, documents.columns
    for name, stage in C.STAGES[:-1]:
        want = plain[name]([tuple(r) for r in docs.select("doc_id", "text").collect()])
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == sorted(want), name
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    out = C.STAGES[-1][1](spark, docs, sf).collect()
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            want[(r.doc_id, k)] = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[k: k + 4096]))
    assert {(r.doc_id, r.start): r.ids_crc32 for r in out} == want and len(out) == len(want)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in C.run(spark, sf).collect()) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out)


def test_stages_on_odd_rows(spark, docs, no_docs):
    sf, kept = str(SMALL), ["doc_id", "text", "lang", "source", "n_chars"]
    for rows in (docs.select(kept), no_docs.select(kept)):
        for _, stage in C.STAGES[:-1]:
            rows = stage(spark, rows, sf)
            assert rows.columns == kept
        C.STAGES[-1][1](spark, rows, sf).count()
