"""Quality classifier: supervised subword embeddings.

Every word has a hashed vector and shares the vectors of its hashed character n-grams; a word repeated right after itself adds the vector
of that event. A document is the average of its words' vectors; two softmax outputs follow. Vectors and outputs are learned together by
stochastic gradient descent in numpy on a bounded sample of labelled documents.

The model is linear in the vectors, so for scoring each hash bucket is folded to one number, and a word to the mean of its buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.llm.labelled import held_out, training_texts

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
#: Labelled documents used for training (a bound; the sample is picked by the hash of the id).
SAMPLE = 3000
#: Words whose score a worker keeps; beyond that the table begins anew.
KNOWN = 100_000
#: The event that a word is the same as the one before it: the last bucket.
AGAIN = BUCKETS - 1


def word_buckets(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The hash buckets of some words: (position of the word, bucket) for the whole words, then for their n-grams of each length.

    Words carry a mark at each end; the longest word has all its n-grams.
    """
    yield np.arange(len(words)), np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % AGAIN for w in words], np.int64)
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner, ends = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(codes))
    for n in GRAMS:
        first = at[at + n <= ends]
        h = np.full(len(first), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[first + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        yield owner[first], (h % np.uint64(AGAIN)).astype(np.int64)


def bucket_count(words: list[str]) -> np.ndarray:
    """How many buckets each word has."""
    sizes = np.array([len(w) + 2 for w in words])
    return 1 + sum(np.maximum(sizes - n + 1, 0) for n in GRAMS)


def repeats(words: list[str]) -> int:
    return sum(map(str.__eq__, words, words[1:]))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights, which add up to one; no buckets for a document without words."""
    from collections import Counter

    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    counted = Counter(words)
    weight = np.array(list(counted.values())) / bucket_count(list(counted))
    total = np.zeros(BUCKETS)
    for owner, bucket in word_buckets(list(counted)):
        total += np.bincount(bucket, weight[owner], BUCKETS)
    total[AGAIN] += repeats(words)
    kept = np.flatnonzero(total)
    return kept.astype(np.int32), (total[kept] / total.sum()).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        """What each bucket and the bias add to the log-odds of label 1."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 4, rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents, with a step that falls to zero. Without rows, or with one label only, the bias tells that label."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)), np.zeros((dim, 2)), np.zeros(2))
    if rows:
        share = np.mean([y for _, _, y in rows])
        model.bias[:] = np.log([max(1 - share, 1e-3), max(share, 1e-3)])
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)).tolist():
            ids, weights, y = rows[k]
            step = rate * (1 - done / steps)
            done += 1
            hidden = weights @ model.vectors[ids] if len(ids) else np.zeros(dim)
            z = hidden @ model.output + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = model.output @ p
            model.output -= step * np.outer(hidden, p)
            model.bias -= 0.1 * step * p
            if len(ids):
                # the step of a vector is its share of the average, sharpened: shares of long documents are tiny
                model.vectors[ids] -= (step * 20) * weights[:, None] * back
    return model


def train(docs: DataFrame, labels: DataFrame, by: int = 3, part: int = 1, rows: int = SAMPLE) -> Model:
    def run(frames):
        for frame in frames:
            for text, label in zip(frame.column("text"), frame.column("label").to_pylist(), strict=True):
                ids, weights = features(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary()), pa.array([label], pa.int32())], ["ids", "weights", "label"])

    found = training_texts(docs, labels, "quality", by, part, rows).mapInArrow(run, "ids binary, weights binary, label int").toArrow().to_pylist()
    found.sort(key=lambda r: (r["ids"], r["weights"], r["label"]))  # the same order however the tasks end
    return fit([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["weights"], np.float32), int(r["label"] > 0)) for r in found])


class Scorer:
    def __init__(self, bucket: np.ndarray, bias: float):
        self.bucket, self.bias, self.again = bucket, bias, float(bucket[AGAIN])
        self.known: dict[str, float] = {}

    def __call__(self, text: str) -> float:
        words = text.split()
        if not words:
            return self.bias
        known = self.known
        try:
            total = sum([known[w] for w in words])
        except KeyError:
            if len(known) > KNOWN:
                known.clear()
            new = [w for w in set(words) if w not in known]
            sums = sum(np.bincount(owner, self.bucket[bucket], len(new)) for owner, bucket in word_buckets(new))
            known.update(zip(new, (sums / bucket_count(new)).tolist(), strict=True))
            total = sum([known[w] for w in words])
        again = repeats(words)
        return (total + again * self.again) / (len(words) + again) + self.bias


def score_quality(docs: DataFrame, model: Model, by: int = 3, part: int = 1) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted of every row; whole texts, null as empty. Empty texts get the bias alone.

    Repeated rows are scored each, other columns are not read, an empty table gives no rows.
    """
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), by, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score column."""
    folded, bias = model.folded()
    bucket = docs.sparkSession.sparkContext.broadcast(folded)  # half a megabyte, whatever the data

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(bucket.value, bias)
        for texts in batches:
            z = np.array([scorer(t or "") for k in range(0, len(texts), 256) for t in texts.slice(k, 256).to_pylist()], float)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())

    return docs.withColumn(name, score(F.col("text")))
