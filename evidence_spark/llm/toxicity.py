"""Toxic passages: maximum-scoring segments over token log-odds.

1. In how many toxic and other labelled documents a token occurs gives it a log-odds ratio under an informative Dirichlet prior (the counts
   of both together, scaled; a word that one document repeats says no more than once). Tokens whose ratio is many standard deviations from zero form the lexicon.
2. A token scores its log-odds less a constant, tokens outside the lexicon the constant alone, so other text scores negative on average.
   One linear scan finds all maximal scoring segments: none can be extended or cut for more, and they do not overlap.
3. Such segments of random text follow an extreme-value law: a segment of score S in n tokens is expected K n exp(-lambda S) times. lambda
   solves the moment equation over the tokens of clean documents, K is fitted to their best segments.
4. A document's score comes from its best segment's and all its segments' significance by a logistic fit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.llm.labelled import held_out, training_texts
from evidence_spark.session import cut

TOKEN = re.compile(r"[^\W_]+")
#: A word outside the lexicon is looked up by its beginnings of these lengths, so that forms never seen are known by their stem.
STEMS = (5, 4)
#: Labelled documents that train the lexicon and the calibration (a bound; picked by the hash of the id).
SAMPLE = 200_000
#: Weight of the prior against the counts, the least standard deviations of a lexicon token, and the lexicon's bound (the furthest from zero stay).
PRIOR, SIGMAS, LEXICON = 0.1, 3.0, 20_000
#: Words whose score a worker keeps; beyond that the table begins anew.
KNOWN = 100_000
#: What each token costs a segment.
COST = 0.1
#: Segments expected less often than this in clean text are reported as passages.
RARE = 0.05


@dataclass
class Model:
    log_odds: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, float, float] = (-4.0, 1.0, 0.0)  # bias, best segment, all segments

    def __post_init__(self):
        self.of_word: dict[str, float] = {}

    def look_up(self, word: str) -> float:
        """Log-odds of a word, or of the longest of its stems in the lexicon (stems end in ``-``); 0 for others. Found words are kept, up to KNOWN."""
        if len(self.of_word) > KNOWN:
            self.of_word.clear()
        found = self.log_odds.get(word)
        for n in STEMS:
            if found is None and len(word) > n:
                found = self.log_odds.get(word[:n] + "-")
        self.of_word[word] = found or 0.0
        return found or 0.0

    def rarity(self, score: float, n: int) -> float:
        """-log10 of the number of segments of this score or more expected in n tokens of clean text, at least 0."""
        return max(0.0, (self.lam * score - np.log(max(self.k * n, 1e-300))) / np.log(10))

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> tuple[float, float]:
        rare = [self.rarity(s, n) for _, _, s in segments]
        return float(np.log1p(max(rare, default=0.0))), float(np.log1p(sum(rare)))

    def probability(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        best, total = self.evidence(n, segments)
        z = self.weights[0] + self.weights[1] * best + self.weights[2] * total
        return float(1 / (1 + np.exp(-z)))


def maximal_segments(hits: list[tuple[int, float]], cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text given by its lexicon tokens (position, log-odds).

    Every other token scores -cost, so only lexicon tokens can begin or end a segment. A positive token looks for the last candidate that began
    lower, along links from each candidate to the last one below it; what a link passes over is never looked at again. If the newer one ends
    higher, both are joined, and the joined one has the link of the older. If no candidate began lower, all of them are final.
    """
    final: list[list] = []
    found: list[list] = []  # first, last, sum before, sum after, place of the last candidate that began lower
    total, at = 0.0, 0
    for position, score in hits:
        before = total - cost * (position - at)
        total, at = before + score - cost, position + 1
        if total <= before:
            continue
        new = [position, position, before, total, -1]
        j = len(found) - 1
        while j >= 0 and found[j][2] >= new[2]:
            j = found[j][4]
        while j >= 0 and found[j][3] < new[3]:
            new[0], new[2], below = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = below
        if j < 0:
            final += found
            found.clear()
        new[4] = j
        found.append(new)
    return [(a, b, high - low) for a, b, low, high, _ in final + found]


def scan(text: str, model: Model) -> tuple[int, list[tuple[int, int, float]]]:
    """The number of tokens of a text and its maximal segments. Every occurrence scores its full log-odds, whatever came before it."""
    tokens, known = TOKEN.findall(text.lower()), model.of_word
    hits = []
    for i, t in enumerate(tokens):
        s = known.get(t)
        if s is None:
            s = model.look_up(t)
        if s:
            hits.append((i, s))
    return len(tokens), maximal_segments(hits)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, toxic, other): in how many toxic and other texts each token occurs, counted in each task before the shuffle."""
    def run(frames):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()), pa.array([counts[0][w] for w in words], pa.int64())], ["token", "toxic", "other"])
            counts[0].clear()
            counts[1].clear()

        for frame in frames:
            for text, label in zip(frame.column("text"), frame.column("label").to_pylist(), strict=True):
                words = set(TOKEN.findall(text.as_py().lower()))
                counts[int(label > 0)].update(words | {w[:n] + "-" for n in STEMS for w in words if len(w) > n})
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "token string, toxic long, other long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_odds(counts: DataFrame, toxic: int, other: int, prior: float = PRIOR) -> DataFrame:
    """(token, toxic, other, log_odds, z) under a Dirichlet prior in proportion to the counts of both groups."""
    alpha, whole = (F.col("toxic") + F.col("other")) * prior, prior * (toxic + other)

    def side(n, total):
        return F.log(n + alpha) - F.log(F.greatest(F.lit(total + whole) - n - alpha, F.lit(1e-9)))

    ratio = side(F.col("toxic"), toxic) - side(F.col("other"), other)
    spread = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("other") + alpha))
    return counts.select("token", "toxic", "other", ratio.alias("log_odds"), (ratio / spread).alias("z"))


def solve_lambda(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * score)) = 1; there is one if the mean is negative and some score positive."""
    if not (scores > 0).any():
        return 1.0
    high = 1e-3
    while (shares * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 1e3:
        high *= 2
    low = high / 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (shares * np.exp(np.minimum(mid * scores, 700))).sum() < 1 else (low, mid)
    return high


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first column of ``x`` is one."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * len(y) * w * np.r_[0, np.ones(len(w) - 1)]
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, by: int = 5, part: int = 0, rows: int = SAMPLE) -> Model:
    """Learn from at most ``rows`` labelled documents outside the held-out part. Without both labels the model finds nothing toxic.

    Null and empty texts have no tokens but count as documents; null labels, repeated documents and labels without a document are
    those of ``training_texts``; empty tables give the model that finds nothing. Other columns are not read.
    """
    texts = training_texts(docs, labels, "toxic", by, part, rows)
    counts = token_counts(texts).persist()
    try:
        totals = counts.where(~F.col("token").endswith("-")).agg(F.sum("toxic"), F.sum("other")).first()
        if not totals[0] or not totals[1]:
            return Model()
        strong = log_odds(counts, *totals).where(F.abs("z") >= SIGMAS).orderBy(F.abs("z").desc(), "token").limit(LEXICON).collect()
    finally:
        counts.unpersist()
    model = Model({r["token"]: r["log_odds"] for r in strong})
    clean = np.array([r["other"] for r in strong], float)
    scores = np.array([*(r["log_odds"] - COST for r in strong), -COST])
    # a lexicon token never met in clean text may still occur there: half an occurrence
    shares = np.array([*np.maximum(clean, 0.5), max(totals[1] - clean.sum(), 1.0)])
    shares /= shares.sum()
    if (shares * scores).sum() < 0:
        model.lam = solve_lambda(scores, shares)

    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON tokens

    def run(frames):
        for frame in frames:
            for k in range(0, frame.num_rows, 256):
                part = frame.slice(k, 256)
                seen = [scan(t, shared.value) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("label"), pa.array([n for n, _ in seen], pa.int64()), pa.array([[s for _, _, s in found] for _, found in seen], pa.list_(pa.float64()))], ["label", "n", "scores"])

    seen = cut(texts.mapInArrow(run, "label int, n long, scores array<double>"))
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    clean, weight = seen.where("label <= 0 and n > 0").agg(F.count(F.lit(1)), F.sum(F.col("n") * F.exp(-model.lam * best))).first()
    model.k = float(f"{clean / max(weight or 0.0, 1e-300):.12g}")  # the same however the tasks end
    rare = F.transform("scores", lambda s: F.greatest(F.lit(0.0), (s * model.lam - F.log(F.greatest(F.col("n") * model.k, F.lit(1e-300)))) / float(np.log(10))))
    evidence = seen.select("label", F.log1p(F.coalesce(F.array_max(rare), F.lit(0.0))).alias("best"), F.log1p(F.aggregate(rare, F.lit(0.0), lambda a, x: a + x)).alias("total"))
    rows_ = evidence.orderBy("label", "best", "total").toArrow()  # two numbers a document, at most ``rows`` documents
    best, total = (rows_.column(c).to_numpy() for c in ("best", "total"))
    model.weights = tuple(fit_logistic(np.stack([np.ones(len(best)), best, total], axis=1), (rows_.column("label").to_numpy() > 0).astype(float)).tolist())
    return model


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability that the whole text is toxic; null and empty texts hold no segment."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.probability(*scan(t or "", shared.value)) for k in range(0, len(texts), 256) for t in texts.slice(k, 256).to_pylist()], pa.float64())

    return docs.withColumn(name, score(F.col("text")))


def score_toxicity(docs: DataFrame, model: Model, by: int = 5, part: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Repeated rows are scored each, other columns are not read, an empty table gives no rows."""
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), by, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxic_passages(docs: DataFrame, model: Model, rare: float = RARE) -> DataFrame:
    """One row per significant passage: doc_id, first and last token (from 0), char_start, char_end, passage, score, expected (times in clean text).

    Null and empty texts have none, repeated rows give theirs each, an empty table no rows. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames):
        for frame in frames:
            for doc_id, value in zip(frame.column("doc_id"), frame.column("text"), strict=True):
                text = value.as_py() or ""
                n, found = scan(text, model)
                kept = [(a, b, s, e) for a, b, s in found if (e := model.k * n * np.exp(-model.lam * s)) < rare]
                if kept:
                    spans = [m.span() for m in TOKEN.finditer(text.lower())]
                    at = [(spans[a][0], spans[b][1]) for a, b, _, _ in kept]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id.as_py()] * len(kept), frame.column("doc_id").type), pa.array([a for a, *_ in kept], pa.int64()), pa.array([b for _, b, *_ in kept], pa.int64()),
                        pa.array([i for i, _ in at], pa.int64()), pa.array([j for _, j in at], pa.int64()), pa.array([text[i:j] for i, j in at], pa.string()),
                        pa.array([s for *_, s, _ in kept], pa.float64()), pa.array([float(e) for *_, e in kept], pa.float64())],
                        ["doc_id", "first_token", "last_token", "char_start", "char_end", "passage", "score", "expected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, first_token long, last_token long, char_start long, char_end long, passage string, score double, expected double")
