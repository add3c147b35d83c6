"""Periodic runs of words in texts, found by uniting suffix classes in the order of falling LCP.

1. The words of a block of documents are numbers; prefix doubling sorts their suffixes, document by document. The longest common prefix (LCP)
   of neighbours is compared word by word where the word before differs, and is one less than that of the place before elsewhere.
2. As in Kruskal's algorithm, neighbours are united from the largest LCP down by a union-find whose classes keep their positions in order.
   When two classes meet at LCP l, every pair of positions that becomes adjacent has the LCP l exactly. At a distance p <= l / (exponent - 1)
   the pair (i, i + p) seeds a run of p + l words with the smallest period p: a smaller one would put another position between the two.
   The run begins at i if the words before i and i + p differ, so each run is found once, from its first word.

Only LCPs that a run needs are united (five words at least, for six words of period one), and documents in which no such stretch of words
occurs twice are not sorted at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run, and how often its period must fit in it.
LENGTH, EXPONENT = 6, 4
#: Words of the documents that are sorted together; a longer document is sorted alone.
WORDS = 200_000


def least_lcp(length: int = LENGTH, exponent: int = EXPONENT) -> int:
    """The smallest LCP of the first positions of a run's first two periods."""
    return min(max(length - p, (exponent - 1) * p) for p in range(1, length + 1))


def repeated(ids: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """The documents in which some stretch of ``size`` words occurs twice (by 64-bit hashes, so at times one more)."""
    n = len(ids) - size + 1
    if n < 2:
        return np.empty(0, np.int64)
    h = doc[:n].astype(np.uint64)
    for k in range(size):
        h = (h ^ ids[k: k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:n] == doc[size - 1:])
    order = inside[np.argsort(h[inside])]
    same = h[order[1:]] == h[order[:-1]]
    return np.unique(doc[order[1:][same]])


def suffix_order(ids: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The positions sorted by document and then by the words from there to the document's end (``end``, per position)."""
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key)
    key, head = key[order], np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while len(tied := np.flatnonzero(~(head & np.append(head[1:], True)))):
        at = order[tied]
        after = at + step
        key = rank[at] * (n + 1) + np.where(after < end[at], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        at, key = at[by], key[by]
        first = np.append(True, key[1:] != key[:-1])
        order[tied], head[tied] = at, first
        rank[at] = np.maximum.accumulate(np.where(first, tied, 0))
        step *= 2
    return order


def common_words(ids: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from ``a`` and from ``b`` on are equal, at most ``most``; all pairs move on together, by longer strides as they get fewer."""
    out, left, done = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(left):
        width = max(8, (1 << 16) // len(left))
        step = np.arange(done, done + width)
        x = np.minimum(a[left, None] + step, len(ids) - 1)
        y = np.minimum(b[left, None] + step, len(ids) - 1)
        differ = ids[x] != ids[y]
        run = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[left] = np.minimum(done + run, most[left])
        done += width
        left = left[(run == width) & (most[left] > done)]
    return out


def neighbour_lcp(ids: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of ``order``, the LCP of its suffix with the one before it; 0 across documents."""
    n = len(ids)
    before = np.full(n, -1)
    before[order[1:]] = np.where(doc[order[1:]] == doc[order[:-1]], order[:-1], -1)
    here, has = np.arange(n), before >= 0
    follows = has & (here > start) & (before > start) & (ids[here - 1] == ids[before - 1])
    own = np.flatnonzero(has & ~follows)
    lcp = np.zeros(n, np.int64)
    lcp[own] = common_words(ids, own, before[own], end[own] - np.maximum(own, before[own]))
    last = np.maximum.accumulate(np.where(follows, 0, here))
    lcp = np.where(follows, lcp[last] - (here - last), lcp)
    return lcp[order]


def find_runs(ids: np.ndarray, sizes: np.ndarray, length: int = LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run of the documents whose words follow each other in ``ids``."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    least = least_lcp(length, exponent)
    some = repeated(ids, doc, least)
    if not len(some):
        return []
    wanted = np.isin(doc, some)
    kept, ids, doc = some, ids[wanted], np.repeat(np.arange(len(some)), sizes[some])
    stops = np.cumsum(sizes[some])
    start, end = (stops - sizes[some])[doc], stops[doc]
    order = suffix_order(ids, doc, end)
    lcp = neighbour_lcp(ids, doc, start, end, order)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]

    # union-find over places of the suffix order; a root's class holds its positions in order
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []
    places = np.unique(np.append(edges, edges - 1))
    for k, position in zip(places.tolist(), order[places].tolist(), strict=True):
        parent[k], members[k] = k, [position]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for k, l in zip(edges.tolist(), lcp[edges].tolist(), strict=True):
        a, b = root(k - 1), root(k)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        parent[b] = a
        large, small = members[a], members.pop(b)
        reach, previous = l // (exponent - 1), -1
        for t, x in enumerate(small):
            at = bisect_left(large, x)
            if at and previous < (i := large[at - 1]) and x - i <= reach and x - i + l >= length:
                found.append((i, x, l))
            if at < len(large) and (j := large[at]) - x <= reach and j - x + l >= length and (t + 1 == len(small) or j < small[t + 1]):
                found.append((x, j, l))
            previous = x
        if len(small) < 8:
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()
    if not found:
        return []
    i, j, l = np.array(found, np.int64).T
    begins = (i == start[i]) | (ids[i - 1] != ids[j - 1])
    i, j, l = i[begins], j[begins], l[begins]
    rows = np.stack([kept[doc[i]], i - start[i], j - i + l, j - i], axis=1)
    return [tuple(r) for r in rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))].tolist()]


def _blocks(texts: list[str]):
    """(first document, word lists) of some documents at a time, of about WORDS words."""
    first, held, n = 0, [], 0
    for k, text in enumerate(texts):
        words = (text or "").encode().split()  # bytes are cut at ASCII white space alone
        if held and n + len(words) > WORDS:
            yield first, held
            first, held, n = k, [], 0
        held.append(words)
        n += len(words)
    if held:
        yield first, held


def periodic_runs(docs: DataFrame, length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs and collapsed of every row.

    ``runs`` is an array of (start, length, period) in words from 0, by start, then period: every stretch of at least ``length`` words that holds
    its smallest period ``exponent`` times or more and that no neighbouring word extends. ``collapsed`` is the text's words, joined by one
    space, without those that a run holds after its first period. Words are cut at ASCII white space. Null and empty texts have no words:
    no runs, an empty text. Repeated rows give a row each, other columns are not read, an empty table gives no rows. Texts of any length are read whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames):
        import pyarrow as pa

        spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for frame in frames:
            for at in range(0, frame.num_rows, 512):
                part = frame.slice(at, 512)
                runs: list[list] = [[] for _ in range(part.num_rows)]
                texts = []
                for first, held in _blocks(part.column("text").to_pylist()):
                    number: dict[bytes, int] = defaultdict(count().__next__)
                    ids = np.array([number[w] for words in held for w in words], np.int64)
                    for k, start, size, period in find_runs(ids, np.array([len(w) for w in held]), length, exponent):
                        runs[first + k].append({"start": start, "length": size, "period": period})
                    for words, spans_ in zip(held, runs[first:first + len(held)], strict=True):
                        if spans_:
                            kept = np.ones(len(words), bool)
                            for r in spans_:
                                kept[r["start"] + r["period"]: r["start"] + r["length"]] = False
                            words = [words[i] for i in np.flatnonzero(kept).tolist()]
                        texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(runs, spans), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which the words of a tenth of the texts, by the checksum of the id, repeat from some word on.

    With h the crc32 of the id as text, g = h // 10 and n words: if h % 10 = 0 and n > 0, each word i >= a becomes word a + (i - a) % p,
    with a = g % n and p = 1 + (n - a) // (3 + g % 8), and the words are joined by one space. Rows without an id stay as they are.
    """
    @F.pandas_udf("string")
    def repeat(texts: pd.Series, g: pd.Series) -> pd.Series:
        out = []
        for text, k in zip(texts, g, strict=True):
            words = text.encode().split() if isinstance(text, str) else []
            if words:
                n, k = len(words), int(k)
                a = k % n
                p = 1 + (n - a) // (3 + k % 8)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            out.append(b" ".join(words).decode())
        return pd.Series(out, dtype=object)

    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    changed = repeat(F.when(chosen, F.col("text")), F.when(chosen, F.floor(h / 10)).otherwise(0))
    return docs.withColumn("text", F.when(chosen, changed).otherwise(F.col("text")))
