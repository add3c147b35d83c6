"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evidence_spark.llm import runs as R
from evidence_spark.llm.queries import QUERIES


def brute_runs(words, length=6, exponent=4):
    """Every maximal stretch with a period, kept if that period is its smallest."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(length, exponent * q) and not any(all(words[i + k] == words[i + k + p] for k in range(size - p)) for p in range(1, q)):
                out.add((i, size, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=6))
def test_small_alphabets(texts):
    ids, sizes = np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64)
    want = [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]
    assert R.find_runs(ids, sizes) == want


@pytest.mark.parametrize("length, exponent", [(2, 2), (6, 3), (9, 5)])
def test_other_thresholds(length, exponent):
    rng = random.Random(length)
    for _ in range(200):
        t = [rng.randrange(2) for _ in range(rng.randrange(50))]
        assert R.find_runs(np.array(t, np.int64), np.array([len(t)]), length, exponent) == [(0, *r) for r in brute_runs(t, length, exponent)]


def test_runs_within_runs_and_long_periods():
    rng = random.Random(1)
    inner = [0] * 7 + [1, 2] * 5 + [rng.randrange(50) for _ in range(30)]
    texts = [inner * 5 + [3], [9] + inner * 4 + inner[:11], [rng.randrange(9) for _ in range(40)] + list(range(100)) * 3]
    ids, sizes = np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts])
    assert R.find_runs(ids, sizes) == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


def test_long_texts_in_little_time():
    import time

    start = time.time()
    same = R.find_runs(np.zeros(200_000, np.int64), np.array([200_000]))
    assert same == [(0, 0, 200_000, 1)]
    block = np.random.default_rng(1).integers(0, 1000, 20_000)
    assert R.find_runs(np.tile(block, 10), np.array([200_000])) == [(0, 0, 200_000, 20_000)]
    assert time.time() - start < 20


def test_operator_on_odd_rows(spark, docs, no_docs):
    rows = R.periodic_runs(docs).collect()
    want = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert len(rows) == len(want)
    for r, (i, text) in zip(sorted(rows, key=lambda r: (str(r.doc_id),)), want, strict=True):
        words = text.split()
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute_runs(words) and r.collapsed == collapsed(words, brute_runs(words))
        else:
            assert i == "8" and [tuple(x) for x in r.runs] == [(0, 70_000, 1)] and r.collapsed == "word end"
    assert R.periodic_runs(no_docs).count() == 0


def plain_query(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text[:1500]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [(1000, None), (1001, ""), (1002, "a " * 9)]
    spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == columns and sorted(tuple(r) for r in got.collect()) == sorted(plain_query(*r) for r in rows)
    assert sum(r[1] > 0 for r in (plain_query(*r) for r in rows)) > 10
