import random
from difflib import SequenceMatcher

from evidence_spark.functions.similarity import _matched, anchor_bounds, anchor_of, ratio_of

SYLLABLES = ["th", "e", "on", "re", "er", "an", "in", "ti", "es", "ou"]


def texts(rng, size=60):
    a = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(0, size)))
    if rng.random() < 0.5:
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            if b:
                b[rng.randrange(len(b))] = rng.choice(["x", "", "qq", "e"])
        return a, "".join(b)
    return a, "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(0, size)))


def test_blocks_equal_the_standard_library():
    rng = random.Random(5)
    for _ in range(600):
        a, b = texts(rng)
        sizes = [x.size for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()]
        assert _matched(a, b) == (sum(sizes), max(sizes))


def test_threshold_only_drops_pairs_below_it():
    rng = random.Random(6)
    for _ in range(400):
        a, b = texts(rng)
        full = ratio_of(a, b)
        assert ratio_of(a, b, 0.9) == (full if full >= 0.9 else ratio_of(a, b, 0.9))
        if full >= 0.9:
            assert ratio_of(a, b, 0.9) == full


def test_anchor_lies_inside_its_bounds():
    rng = random.Random(7)
    for _ in range(400):
        a, b = texts(rng)
        lo, hi = anchor_bounds(a, b)
        assert lo - 1e-6 <= anchor_of(a, b) <= hi + 1e-6


def test_empty_texts():
    assert ratio_of("", "") == 1.0 and ratio_of("a", "") == 0.0
