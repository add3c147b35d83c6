"""Matching-block similarity of normalised texts: the one Arrow UDF over already pruned pairs."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: run lengths tried in turn when looking for the longest common block
STEPS = (24, 6, 1)


def _matched(a: str, b: str) -> tuple[int, int]:
    """(characters in matching blocks, longest block): longest block first, then left and right of it.

    A longest block is found as the longest run of shared grams, so long texts are walked by rare grams and not by single
    letters. The first longest block in ``a``, then in ``b``, wins.
    """
    places: dict[int, dict[str, list[int]]] = {}

    def index(k: int) -> dict[str, list[int]]:
        if k not in places:
            table: dict[str, list[int]] = {}
            for j in range(len(b) - k + 1):
                table.setdefault(b[j:j + k], []).append(j)
            places[k] = table
        return places[k]

    total = longest = 0
    work = [(0, len(a), 0, len(b), 0)]
    while work:
        alo, ahi, blo, bhi, level = work.pop()
        run = at = bt = 0
        while alo < ahi and blo < bhi:
            k = STEPS[level]
            if min(ahi - alo, bhi - blo) >= k:
                table, before, stop = index(k), {}, bhi - k
                for i in range(alo, ahi - k + 1):
                    now = {}
                    found = table.get(a[i:i + k])
                    if found:
                        for j in found[bisect_left(found, blo):] if found[0] < blo else found:
                            if j > stop:
                                break
                            r = now[j] = before.get(j - 1, 0) + 1
                            if r > run:
                                run, at, bt = r, i - r + 1, j - r + 1
                    before = now
            if run or level == len(STEPS) - 1:
                break
            level += 1
        if run:
            size = run + STEPS[level] - 1
            total += size
            longest = max(longest, size)
            work.append((alo, at, blo, bt, level))
            work.append((at + size, ahi, bt + size, bhi, level))
    return total, longest


def _longest_common_subsequence(a: str, b: str) -> int:
    """Length by bit-parallel row updates: an upper bound for the characters in matching blocks."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio_of(a: str, b: str, at_least: float = 0.0) -> float:
    """2M/(|a|+|b|) over recursive longest blocks; 0.0 as soon as a bound proves it is below ``at_least``."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    total = len(a) + len(b)
    if a in b or b in a:
        return 2.0 * min(len(a), len(b)) / total
    if at_least > 0.0:
        if 2.0 * min(len(a), len(b)) / total < at_least:
            return 0.0
        if 2.0 * _longest_common_subsequence(a, b) / total < at_least:
            return 0.0
    return 2.0 * _matched(a, b)[0] / total


def block_ratio(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Similarity of two *normalised* texts; not symmetric, so feed (earlier, later)."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([ratio_of(x, y, at_least) if x is not None and y is not None else None for x, y in zip(left, right)],
                         dtype="float64")

    return run(a, b)


def longest_block(a: Column, b: Column) -> Column:
    """Length of the longest common block of two normalised texts."""

    @F.pandas_udf("long")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_matched(x, y)[1] for x, y in zip(left, right)], dtype="int64")

    return run(a, b)


def _grams(x: str, n: int = 8) -> list[str]:
    return [x[i:i + n] for i in range(len(x) - n + 1)]


def anchor_bounds(x: str, y: str, gx: set[str] | None = None) -> tuple[float, float]:
    """Lower and upper bound of the lexical anchor score, without matching blocks.

    A block of eight or more characters shows as a run of consecutive shared 8-grams. The longest run
    bounds the longest block from above; where the run itself occurs in the other text, it is that block.
    """
    if not x or not y:
        return 0.0, 0.0
    small, total = min(len(x), len(y)), len(x) + len(y)
    gx = set(_grams(x)) if gx is None else gx
    order = _grams(y)
    gy = set(order)
    shared = len(gx & gy)
    gram = shared / max(1, min(len(gx), len(gy)))
    run = best = end = 0
    for i, g in enumerate(order):
        run = run + 1 if g in gx else 0
        if run > best:
            best, end = run, i
    if best == 0:
        high = min(7, small)
        return 0.25 * gram, 0.45 * (2.0 * small / total) + 0.30 * (high / small) + 0.25 * gram
    high = best + 7
    low = high if y[end - best + 1:end + 8] in x else 8
    whole = low == small
    ratio_high = 2.0 * small / total
    ratio_low = ratio_high if whole else 2.0 * low / total
    return (0.45 * ratio_low + 0.30 * low / small + 0.25 * gram, 0.45 * ratio_high + 0.30 * min(high, small) / small + 0.25 * gram)


def lexical_bounds(a: Column, b: Column) -> Column:
    """STRUCT<lo, hi> around the lexical anchor score of two normalised texts."""

    @F.pandas_udf("lo double, hi double")
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        seen: dict[str, set[str]] = {}
        rows = []
        for x, y in zip(left, right):
            if x not in seen:
                seen = {x: set(_grams(x))}
            rows.append(anchor_bounds(x, y, seen[x]))
        return pd.DataFrame(rows, columns=["lo", "hi"], dtype="float64")

    return run(a, b)


def anchor_of(x: str, y: str, bounds: tuple[float, float] | None = None) -> float:
    if not x or not y:
        return 0.0
    lo, hi = bounds or anchor_bounds(x, y)
    if hi - lo < 1e-12:
        return round(hi, 6)
    matched, longest = _matched(x, y)
    gx, gy = set(_grams(x)), set(_grams(y))
    shared = len(gx & gy) / max(1, min(len(gx), len(gy)))
    return round(0.45 * (2.0 * matched / (len(x) + len(y))) + 0.30 * longest / min(len(x), len(y)) + 0.25 * shared, 6)


def lexical_anchor(a: Column, b: Column) -> Column:
    """0.45 ratio + 0.30 longest block over the shorter + 0.25 shared 8-grams over the smaller set."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([anchor_of(x, y) for x, y in zip(left, right)], dtype="float64")

    return run(a, b)


def _best(x: str, ys, priors, starts, counts, k: int) -> list[dict]:
    """The ``k`` best of a text's spans by 0.65 anchor score + 0.35 prior, ties by start and count; bounds drop those that cannot be among them."""
    gx = set(_grams(x)) if x else set()
    limits = [anchor_bounds(x, y, gx) for y in ys]
    priors = [-np.inf if p is None else p for p in priors]
    low = sorted((0.65 * lo + 0.35 * p for (lo, _), p in zip(limits, priors)), reverse=True)
    floor = low[k - 1] if len(low) >= k else -np.inf
    kept = [n for n, ((_, hi), p) in enumerate(zip(limits, priors)) if 0.65 * hi + 0.35 * p >= floor - 1e-5]
    score = {n: anchor_of(x, ys[n], limits[n]) for n in kept}
    kept.sort(key=lambda n: (-(0.65 * score[n] + 0.35 * priors[n]), starts[n], counts[n]))
    return [{"at": n, "lexical": score[n]} for n in kept[:k]]


def best_spans(text: Column, spans: Column, priors: Column, starts: Column, counts: Column, k: int) -> Column:
    """ARRAY<STRUCT<at, lexical>>: places (from 0) and lexical anchor scores of the ``k`` best of the normalised ``spans`` of a normalised text."""

    @F.pandas_udf("array<struct<at int, lexical double>>")
    def run(x: pd.Series, ys: pd.Series, p: pd.Series, s: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_best(*row, k) for row in zip(x, ys, p, s, n)], dtype="object")

    return run(text, spans, priors, starts, counts)


def text_score(a: Column, b: Column) -> Column:
    """Best of ratio and shared 5-grams over the smaller set; at least 0.92 on containment."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            if not x or not y:
                out.append(0.0)
                continue
            if x in y or y in x:
                out.append(max(ratio_of(x, y), 0.92))
                continue
            ratio = ratio_of(x, y)
            gx, gy = set(_grams(x, 5)), set(_grams(y, 5))
            out.append(max(ratio, len(gx & gy) / max(1, min(len(gx), len(gy)))))
        return pd.Series(out, dtype="float64")

    return run(a, b)
