import zlib
from collections import Counter

import numpy as np
import pytest

from evidence_spark.llm import packing, tokens
from evidence_spark.llm.queries import vocabulary


@pytest.fixture(scope="module")
def spec():
    with open(vocabulary(), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(spec):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


HARD = ["don't 'tis we're they'll I'd 've!!'s ''s 're'r 'l 'v1 'll' it''s '", "x'", " ", "", "'r", "'re", "a'lb", "12'3", "éÀÇ ǅ İ ΑΣ Σ<|endoftext|>a", "<|endoftext", "éx", "日本語 text", " a b\x1cc\x85d",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "!!!!!!???...", "ß ẞ ﬁ", "a​b"]


def test_transducer_counts_as_the_library(spec, library):
    import duckdb

    machine = tokens.Transducer(spec)
    texts = HARD + [r[0] for r in duckdb.connect().execute("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    assert machine.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert machine.count([]) == []


def test_state_maps_compose_in_any_cut(spec, library):
    machine = tokens.Transducer(spec)
    text = " ".join(HARD) + "nospace" * 30 + " end"
    want = len(library.encode(text, add_special_tokens=False).ids)
    for size in (1, 3, 17, 200):
        assert machine.compose(machine.chunk_maps([text[i: i + size] for i in range(0, len(text), size)])) == want


def test_lost_prefixes_are_left_to_the_library(spec, library):
    machine = tokens.Transducer(spec)
    machine._grow = lambda *a: (_ for _ in ()).throw(LookupError())
    assert machine.count(["some words", "", "more"]) == [len(library.encode(t, add_special_tokens=False).ids) for t in ("some words", "", "more")]


def test_other_vocabularies_are_refused(spec):
    with pytest.raises(ValueError):
        tokens.Transducer(spec.replace("Lowercase", "NFKC"))


def test_count_tokens_on_odd_rows(spark, docs, no_docs, library, monkeypatch):
    got = tokens.count_tokens(docs, vocabulary()).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[(r.doc_id, len((r.text or "").encode()), n, n > 2048)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert tokens.count_tokens(no_docs, vocabulary()).count() == 0


def brute_pieces(library, text, capacity):
    ids = library.encode(text or "", add_special_tokens=False).ids + [1]
    return [(k // capacity, k, len(ids[k: k + capacity]), zlib.crc32(np.array(ids[k: k + capacity], "<u4").tobytes())) for k in range(0, len(ids), capacity)]


def test_pack_places_every_piece_once(spark, docs, no_docs, library):
    for capacity in (8, 4096):
        got = packing.pack(docs, vocabulary(), capacity).collect()
        want = Counter((r.doc_id, *p) for r in docs.select("doc_id", "text").collect() for p in brute_pieces(library, r.text, capacity))
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        by = {}
        for r in got:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in by.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        least = -(-sum(r.length for r in got) // capacity)
        assert len(by) <= least * 1.05 + 2
    assert packing.pack(no_docs, vocabulary()).count() == 0


def test_sequences_hold_the_ids(spark, library):
    rows = [(i, " ".join(["word"] * (i % 13)) + f" text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.packed_sequences(df, packing.pack(df, vocabulary(), 16), vocabulary(), 16).collect()
    want = Counter()
    for _, t in rows:
        want.update(library.encode(t, add_special_tokens=False).ids + [1])
    assert Counter(i for r in out for i in r.ids) == want
    assert all(len(r.ids) <= 16 for r in out)


def test_rule_makes_the_sum_of_squares_smallest():
    rng, capacity = np.random.default_rng(2), 12
    gaps = packing.Gaps(capacity)
    state: list[int] = []

    def squares(s):
        return sum(n * n for g, n in Counter(s).items() if g > 0)

    for length in rng.integers(1, capacity + 1, 300).tolist():
        options = [[*state, capacity - length]] + [[*state[:i], g - length, *state[i + 1:]] for i, g in enumerate(state) if g >= length]
        at, offset = gaps.place(length)
        if at == len(state):
            state.append(capacity)
        assert offset == capacity - state[at]
        state[at] -= length
        assert squares(state) == min(squares(o) for o in options)


def test_words_are_cut_once_and_their_tables_stay_small(spec, library, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 50)
    ids, cut = packing.Ids(spec), []
    monkeypatch.setattr(packing.Words, "_cut", lambda self, word, whole=packing.Words._cut: cut.append(word) or whole(self, word))
    rng = np.random.default_rng(3)
    signs = [*"aAbzéÀß'.,!<|>0\t\x0b ", "the", "Straße", "<|endoftext|>", "İ", "K"]
    texts = [*HARD, "a word, a WORD, a word,", "x" * 500, *("".join(rng.choice(signs, rng.integers(1, 40))) for _ in range(400))]
    for t in texts:
        assert ids.of([t]) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]
        assert max(len(ids.words), len(ids.words.earlier)) <= 50
    cut.clear()
    ids.of(["once again once", "again"])
    ids.of(["again once"])
    assert sorted(cut) == ["again", "once"]
    assert all(len(w) <= packing.LONGEST for w in [*ids.words, *ids.words.earlier])
