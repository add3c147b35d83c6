"""The near-duplicate stage against brute-force shingle similarity."""

import random

import corpus_pipeline as C
from pyspark.sql import functions as F

from evidence_spark.llm import shingles as S


def brute_groups(texts):
    """The smallest position of each text's group over all pairs with five-word shingle similarity 0.8 or more."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def planted(seed=3):
    """Texts with copies at all similarities around 0.8, chains of copies, a large group and a line that all have."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(30, 250))]
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base if k % 3 else texts[-1].split())
            for _ in range(rng.randint(1, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy) if rng.random() < 0.9 else " ".join(copy).upper())
    big = [rng.choice(words) for _ in range(100)]
    for _ in range(60):
        copy = list(big)
        for _ in range(2):
            copy[rng.randrange(100)] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += ["all rights reserved by us here " + " ".join(rng.choice(words) for _ in range(8)) for _ in range(40)]
    texts += ["a b", "A  b", "a b c", "", "  ", "one", "one one one one one one", "one one one one one one one"]
    rng.shuffle(texts)
    return texts


def test_stage_finds_every_pair_of_shingle_similarity(spark):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in C.one_of_each(spark, df, "").collect())
    assert got == sorted(set(brute_groups(texts)))


def test_order_of_shingles_does_not_change_the_result(spark, monkeypatch):
    texts = planted(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(S, "shingle_order", lambda *a: (S.np.empty(0, S.np.int64),) * 2)
    assert sorted(r.doc_id for r in S.keep_one(df).collect()) == sorted(set(brute_groups(texts)))


def test_one_row_of_each_group(spark):
    rows = [(1, "a b c d e", 1), (1, "a b c d e", 2), (2, "A b  c d e", 3), (1, "other words that are new here", 4), (None, "x y z w", 5), (7, "x y z w", 6), (None, None, 7), (None, "", 8), (None, "p q", 9), (None, "p q", 10)]
    got = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int")).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "a b c d e"), ("1", "other words that are new here"), ("7", "x y z w"), ("None", ""), ("None", "p q")]


def test_stage_on_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    want = [rows[k][0] for k in sorted(set(brute_groups([t for _, t in rows])))]
    got = C.one_of_each(spark, df, "")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == want


def test_stage_starts_from_simhash_links(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(S, "linked", lambda prints, whole=S.linked: asked.append(prints.count()) or whole(prints))
    texts = planted(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in C.one_of_each(spark, df, "").collect()) == sorted(set(brute_groups(texts)))
    assert len(asked) == 1 and asked[0] > 30


def test_unlike_texts_with_a_common_line_are_not_all_compared(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(5000)]
    line = [f"x{k}" for k in range(60)]
    texts = [" ".join(line + [rng.choice(words) for _ in range(45)]) for _ in range(120)]
    compared = []
    monkeypatch.setattr(S, "_verified", lambda pairs, sets_of, whole=S._verified: compared.append(pairs.count()) or whole(pairs, sets_of))
    monkeypatch.setattr(S, "shingle_order", lambda *a: (S.np.empty(0, S.np.int64),) * 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert S.keep_one(df).count() == len(set(brute_groups(texts))) == 120
    assert sum(compared) < 120


def test_parities_never_exceed_the_difference(spark):
    rng = S.np.random.default_rng(2)
    for n in (1, 5, 80, 2000):
        a = rng.integers(-2**63, 2**63 - 1, n)
        b = S.np.concatenate([a[: n // 2], rng.integers(-2**63, 2**63 - 1, n // 3)])
        unlike = int(S.np.bitwise_count((S.parities(a) ^ S.parities(b)).view(S.np.uint64)).sum())
        assert unlike <= len(set(a.tolist()) ^ set(b.tolist()))
