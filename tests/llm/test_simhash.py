import random
import re

import numpy as np
import xxhash

from evidence_spark.llm import simhash as S


def brute_print(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i: i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """{(position): smallest id reachable} over all pairs."""
    n, left, out = len(rows), set(range(len(rows))), {}
    while left:
        todo, group = [left.pop()], set()
        while todo:
            i = todo.pop()
            group.add(i)
            near = {j for j in left if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4}
            left -= near
            todo += near
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        for i in group:
            out[i] = min(ids) if ids else None
    assert len(out) == n
    return out


def check(df):
    rows = df.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    want = sorted(((str(i), f"{p:016x}", str(c)) for (i, p), c in zip(prints, (brute_components(prints)[k] for k in range(len(rows))), strict=True)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in S.near_duplicates(df).collect()) == want


def test_odd_rows(spark, docs, no_docs):
    check(docs)
    assert S.near_duplicates(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_groups_of_copies_and_near_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(60, 160))] for _ in range(12)]
    rows = []
    for i in range(260):
        words = list(rng.choice(bases[:1] if i % 3 == 0 else bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 30])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in S.near_duplicates(df).collect()})


def test_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([(1, "a b c d e", "p"), (1, "a b c d e", "q"), (2, "a b c d e", "r")], "doc_id long, text string, component_id string")
    assert [r.doc_id for r in S.keep_one(df).collect()] == [1]


def test_rows_without_ids_are_kept_once(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "other words that are new here"), (7, "x y z w"), (None, "x y z w"), (None, None), (None, "")]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == [("7", "x y z w"), ("None", ""), ("None", "a b c d"), ("None", "other words that are new here")]


def test_every_pair_within_four_bits_shares_a_key():
    rng, golay = np.random.default_rng(1), S.Golay()
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for bits in range(1, 5):
        b = a.copy()
        for i in range(len(b)):
            for k in rng.choice(64, bits, replace=False).tolist():
                b[i] ^= np.uint64(1 << k)
        one, two = (set(zip(*(x.tolist() for x in S.fuzzy_keys(p.view(np.int64), golay)), strict=True)) for p in (a, b))
        assert {i for i, _ in one & two} == set(range(len(a)))


def test_golay_decodes_three_errors():
    golay, rng = S.Golay(), np.random.default_rng(0)
    for message in rng.integers(0, 4096, 50).tolist():
        word = message << 11
        word ^= S._remainder(word)
        for _ in range(20):
            error = sum(1 << int(k) for k in rng.choice(23, rng.integers(0, 4), replace=False))
            assert golay.index(np.array([word ^ error]))[0] == message


def test_hot_keys_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 8)
    rng = random.Random(5)
    prints = {0xF0F0F0F0F0F0F0F0}
    while len(prints) < 60:
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]

    def rows():
        import pyarrow as pa

        who, keys = S.fuzzy_keys(np.array(signed, np.int64), S.Golay())
        order = np.argsort(keys, kind="stable")
        for k in range(0, len(order), 37):
            part = order[k: k + 37]
            yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(np.array(signed, np.int64)[who[part]])], ["key", "fingerprint"])

    links, blocks = set(), {}
    for batch in S._same_key(rows(), 4):
        for r in batch.to_pylist():
            if r["key"] is None:
                links.add((r["a"], r["b"]))
            else:
                assert len(r["members"]) <= 8
                blocks.setdefault(r["key"], []).append(r["members"])
    for parts in blocks.values():
        for i, x in enumerate(parts):
            for y in parts[i + 1:]:
                links |= set(S.stars(np.array([*x, *y], np.int64)))
    assert blocks
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 64
        root[find(a)] = find(b)
    want = brute_components([(k, p & (2**64 - 1)) for k, p in enumerate(signed)])
    for i, p in enumerate(signed):
        for j, q in enumerate(signed):
            assert (find(p) == find(q)) == (want[i] == want[j])


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (200, 200)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert S.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tasks_need_little_memory():
    """Python tasks load no pandas, and a comparison of two full blocks holds one byte a pair, not eight."""
    import subprocess
    import sys
    import tracemalloc

    subprocess.run([sys.executable, "-c", "import evidence_spark.llm.simhash, evidence_spark.llm.shingles, sys; assert 'pandas' not in sys.modules"], check=True)
    prints = 5 ^ (1 << np.random.default_rng(2).integers(0, 62, 2 * S.BLOCK))
    tracemalloc.start()
    found = S.stars(prints)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {b for _, b in found} == {int(prints.min())} and {a for a, _ in found} | {int(prints.min())} == set(prints.tolist())
    assert peak < 3 * len(prints) ** 2
