import math
import random
import zlib

import numpy as np
import pytest

from evidence_spark.llm import quality, toxicity


def documents(spark, n=240):
    rng = random.Random(4)
    words = ["alder", "birch", "cedar", "dogwood", "elm", "fir", "ginkgo", "holly", "ivy", "juniper"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        bad, rude = i % 4 == 0, i % 5 == 2
        if bad:
            text = [w.upper() + "!!" for w in text]
        if rude:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["blockhead", "blockheads", "nitwit"])
        rows.append((i, " ".join(text), "clash"))
        labels.append((i, int(not bad), int(rude)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def rate(rows, truth):
    return np.mean([r.predicted == truth(r.doc_id) for r in rows if r.held_out])


def test_quality_learns_and_holds_out(spark):
    docs, labels = documents(spark)
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert rate(rows, lambda i: int(i % 4 != 0)) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    # a label outside the training part changes nothing
    from pyspark.sql import functions as F

    changed = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.train(docs, changed).vectors, model.vectors)


def test_folded_scores_equal_the_average_of_vectors():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=(quality.BUCKETS, 4)), rng.normal(size=(4, 2)), rng.normal(size=2))
    bucket, bias = model.folded()
    for text in ("", "one two two two", "É é 日本 " + "long" * 500, "a | b | c"):
        ids, weights = quality.features(text)
        z = (weights @ model.vectors[ids] if len(ids) else np.zeros(4)) @ model.output + model.bias
        assert quality.Scorer(bucket, bias)(text) == pytest.approx(z[1] - z[0], abs=1e-4)


def test_scores_of_odd_rows(spark, docs, no_docs):
    train, labels = documents(spark)
    for module, scored, model in ((quality, quality.score_quality, quality.train(train, labels)), (toxicity, toxicity.score_toxicity, toxicity.train(train, labels))):
        rows = scored(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert scored(no_docs, model).count() == 0
        assert module.with_score(docs.drop("score"), model).count() == docs.count()


def test_models_without_labels(spark):
    docs, labels = documents(spark, 20)
    assert quality.score_quality(docs, quality.train(docs, labels.limit(0))).count() == 20
    assert sum(r.predicted for r in toxicity.score_toxicity(docs, toxicity.train(docs, labels.limit(0))).collect()) == 0
    nulls = spark.createDataFrame([(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    assert quality.score_quality(docs, quality.train(docs, nulls)).count() == 20


def test_toxicity_learns_and_finds_passages(spark):
    docs, labels = documents(spark, 600)
    model = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert rate(rows, lambda i: int(i % 5 == 2)) > 0.95
    found = toxicity.toxic_passages(docs, model).collect()
    assert {r.doc_id for r in found} <= {i for i in range(600) if i % 5 == 2}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert found and all(texts[r.doc_id][r.char_start: r.char_end] == r.passage and ("nitwit" in r.passage.lower() or "blockhead" in r.passage.lower()) for r in found)
    # forms never seen are known by their stem
    assert model.look_up("blockheadedness") > 0


def brute_segments(scores):
    """All maximal scoring segments by their definition: the best segment, then the same left and right of it."""
    if not scores:
        return []
    best, at = 0.0, None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i: j + 1])
            if s > best + 1e-9 or at and abs(s - best) <= 1e-9 and (i, -j) > at and False:
                best, at = s, (i, j)
    if at is None:
        return []
    i, j = at
    return brute_segments(scores[:i]) + [(i, j, best)] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1:])]


def test_segments_equal_the_definition():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 14)
        hits = [(i, rng.choice([2.3, 1.7, -1.1, 0.37])) for i in range(n) if rng.random() < 0.5]
        scores = [-0.31] * n
        for i, s in hits:
            scores[i] = s - 0.31
        got = toxicity.maximal_segments(hits, 0.31)
        want = brute_segments(scores)
        assert len(got) == len(want) and all(a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-9) for a, b in zip(got, want, strict=True)), (scores, got, want)


def test_lambda_solves_the_moment_equation():
    scores, shares = np.array([2.0, -0.5]), np.array([0.1, 0.9])
    lam = toxicity.solve_lambda(scores, shares)
    assert lam > 0 and abs((shares * np.exp(lam * scores)).sum() - 1) < 1e-9


def test_segments_take_linear_time():
    import time

    rng = random.Random(5)
    took = []
    for n in (100_000, 200_000, 400_000):
        hits = [(i, rng.choice([2.0, 1.0]) if rng.random() < 0.375 else -1.0) for i in range(n) if rng.random() < 0.16]
        start = time.process_time()
        toxicity.maximal_segments(hits)
        took.append(time.process_time() - start)
    assert took[2] < 8 * max(took[0], 0.02) and took[2] < 3


def test_training_equals_a_plain_version(spark):
    docs, labels = documents(spark, 600)
    model = toxicity.train(docs, labels)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.text, toxic[r.doc_id]) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    counts = {}
    for text, y in rows:
        words = set(toxicity.TOKEN.findall(text.lower()))
        for w in words | {w[:n] + "-" for n in toxicity.STEMS for w in words if len(w) > n}:
            counts.setdefault(w, [0, 0])[y] += 1
    totals = [sum(c[y] for w, c in counts.items() if not w.endswith("-")) for y in (0, 1)]
    prior, whole, odds = toxicity.PRIOR, toxicity.PRIOR * sum(totals), {}
    for w, (other, bad) in counts.items():
        a = prior * (other + bad)
        x, y = (math.log(c + a) - math.log(t + whole - c - a) for c, t in ((bad, totals[1]), (other, totals[0])))
        if abs(x - y) >= toxicity.SIGMAS * math.sqrt(1 / (bad + a) + 1 / (other + a)):
            odds[w] = x - y
    assert model.log_odds.keys() == odds.keys() and all(math.isclose(model.log_odds[w], v, rel_tol=1e-9) for w, v in odds.items())
    shares = {w: max(counts[w][0], 0.5) for w in odds} | {"": max(totals[0] - sum(counts[w][0] for w in odds), 1.0)}
    moment = sum(s * math.exp(model.lam * (odds.get(w, 0.0) - toxicity.COST)) for w, s in shares.items()) / sum(shares.values())
    assert math.isclose(moment, 1, rel_tol=1e-9)
    best = [(n, max((s for *_, s in found), default=0.0)) for n, found in (toxicity.scan(t, model) for t, y in rows if not y)]
    assert math.isclose(model.k, len(best) / sum(n * math.exp(-model.lam * s) for n, s in best), rel_tol=1e-9)


def test_training_rows_are_bounded(spark):
    from evidence_spark.llm.labelled import training_texts

    docs, labels = documents(spark, 60)
    many = docs.unionByName(docs).unionByName(docs.limit(0))
    got = training_texts(many, labels, "toxic", 5, 0, 30).collect()
    assert len(got) == 30 and len({r.text for r in got}) == 30
