"""Toxic passages that come late in a text, and words that are only somewhat likelier in toxic texts."""

import random

from evidence_spark.llm import toxicity


def test_repeated_passages_score_like_the_first(spark):
    model = toxicity.Model({"nitwit": 4.0, "blockhead": 3.5}, lam=2.0, k=0.003)
    passage, rest = "nitwit you blockhead", " " + "elm fir ivy " * 60
    text = rest.join([passage] * 5)
    scores = [s for _, _, s in toxicity.scan(text, model)[1]]
    assert len(scores) == 5 and max(scores) - min(scores) < 1e-9
    scattered = rest.join(["nitwit", "blockhead", "nitwit", "blockhead", passage])
    assert abs(toxicity.scan(scattered, model)[1][-1][2] - scores[0]) < 1e-9
    found = toxicity.toxic_passages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [r.passage for r in sorted(found, key=lambda r: r.first_token)] == [passage] * 5


def test_every_significant_token_is_in_the_lexicon(spark):
    """Words five times likelier in toxic texts: below the former least log-odds, far beyond three standard deviations."""
    rng, rows, labels = random.Random(2), [], []
    plain = [f"w{k}" for k in range(200)]
    somewhat = ["grub", "dolt", "oaf", "twerp"]
    for i in range(1500):
        rude = i % 3 == 0
        text = [rng.choice(plain) for _ in range(40)]
        text += [w for w in somewhat if rng.random() < (0.5 if rude else 0.1)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(rude)))
    docs, labelled = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labelled)
    assert all(1 < model.log_odds.get(w, 0) < 2.5 for w in somewhat)
