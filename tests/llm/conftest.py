import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "x"),
    (2, None, "x"),
    (3, "", "y"),
    (4, "   \n\t ", "y"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "z"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "z"),
    (None, "A text without an id, é and 日本 included.", None),
    (8, "word " * 70_000 + "end", "long"),
    (9, "x" * 300_000, "no white space"),
    (10, "I'll say don't 12 times! <|endoftext|> 'tis", None),
]


@pytest.fixture
def docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with those the operators make."""
    rows = [(i, t, s, "en", 0, "clash", True, 1.5) for i, t, s in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, fingerprint string, open boolean, score double")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
