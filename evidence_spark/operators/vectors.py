"""Embeddings as array columns: hashed vectors, cached model vectors, pooling, margins and recall."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidence_spark.functions.keys import content_hash
from evidence_spark.operators.tiles import blocks, met
from evidence_spark.session import cut, spread

# fixed values: words the hashed vector treats as one
SYNONYMS = {
    "purchase": "buy", "purchased": "buy", "automobile": "car", "rapid": "fast", "quick": "fast", "decrease": "reduce", "decreased": "reduce",
    "thanks": "thank", "welcomes": "welcome",
}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of unit vectors, clamped to [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b)))


def unit(c: Column) -> Column:
    """Unit length; the zero vector stays."""
    from evidence_spark.functions.text import let

    wide = F.transform(c, lambda x: x.cast("double"))
    return let(wide, lambda v: let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)),
                                lambda n: F.transform(v, lambda x: x / F.when(n == 0, 1.0).otherwise(n))))


def hash_embed(df: DataFrame, key: Sequence[str], text: str = "text", dim: int = 128, synonyms: Mapping[str, str] | None = None) -> DataFrame:
    """Signed bag of words: SHA-256 of a token gives its slot (bytes 0-1) and sign (byte 2); unit length.

    Tokens are counted before they are hashed, so a word is hashed once per text.
    """
    key = list(key)
    same = dict(SYNONYMS if synonyms is None else synonyms)

    @F.pandas_udf("array<struct<slot int, v double>>")
    def slots(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            sums: dict[int, int] = {}
            for w, n in Counter(TOKEN.findall(t or "")).items():
                slot, sign = _slot(same.get(w, w))
                sums[slot % dim] = sums.get(slot % dim, 0) + sign * n
            out.append([{"slot": s, "v": float(v)} for s, v in sums.items()])
        return pd.Series(out, dtype="object")

    # one shuffle of a few numbers a text; rows of one key add up
    parts = spread(df.select(*key, slots(F.lower(text)).alias("_p")), *key).select(*key, F.explode_outer("_p").alias("_p"))
    sums = parts.groupBy(*key, "_p.slot").agg(F.sum("_p.v").alias("v"))
    packed = sums.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "v")))).alias("m"), F.coalesce(F.sqrt(F.sum(F.col("v") * F.col("v"))), F.lit(0.0)).alias("n"))
    # a row without its whole key has no words of its own
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    dense = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)) / F.when(F.col("n") == 0, 1.0).otherwise(F.col("n")))
    return packed.select(*key, F.when(known, dense).otherwise(F.array_repeat(F.lit(0.0), dim)).alias("vector"))


TOKEN = re.compile("[a-z0-9]+")


@lru_cache(maxsize=50_000)
def _slot(word: str) -> tuple[int, int]:
    h = hashlib.sha256(word.encode()).digest()
    return int.from_bytes(h[:2], "big"), 1 if h[2] % 2 else -1


class Scorer:
    """What turns texts into vectors. ``batch`` runs inside tasks on lists of texts; ``degraded`` marks a stand-in."""

    def __init__(self, name: str, version: str, dim: int, batch: Callable[[list[str]], Sequence[Sequence[float]]] | None, degraded: bool = False):
        self.name, self.version, self.dim, self.batch, self.degraded = name, version, dim, batch, degraded

    @classmethod
    def hashed(cls, dim: int = 128, degraded: bool = False) -> "Scorer":
        """The built-in hashed vectors; ``degraded=True`` when they replace a model that is not available."""
        return cls("hashed_words", "v1", dim, None, degraded)


def embed(df: DataFrame, scorer: Scorer, cache: DataFrame | None = None, text: str = "text", batch_size: int = 64) -> tuple[DataFrame, DataFrame]:
    """(input with ``vector`` and ``degraded``, rows new to the cache).

    Each distinct text is computed once and only if ``(text_hash, model, version)`` is not in the cache table
    (``text_hash, model, version, vector``). A vector of the wrong size is an error.
    """
    rows = df.withColumn("text_hash", content_hash(text))
    distinct = rows.select("text_hash", F.col(text).alias("text")).dropDuplicates(["text_hash"])
    known = None
    if cache is not None:
        known = cache.where((F.col("model") == scorer.name) & (F.col("version") == scorer.version)).select("text_hash", "vector")
        distinct = distinct.join(known, "text_hash", "left_anti")
    if scorer.batch is None:
        fresh = hash_embed(distinct, ["text_hash"], dim=scorer.dim)
    else:
        run, size = scorer.batch, scorer.dim

        def infer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for at in range(0, len(part), batch_size):
                    chunk = part.iloc[at:at + batch_size]
                    vectors = [list(map(float, v)) for v in run(chunk["text"].tolist())]
                    if any(len(v) != size for v in vectors):
                        raise ValueError(f"expected vectors of size {size}")
                    yield pd.DataFrame({"text_hash": chunk["text_hash"].tolist(), "vector": vectors})

        fresh = distinct.mapInPandas(infer, "text_hash string, vector array<double>")
    fresh = cut(fresh)
    every = fresh if known is None else fresh.unionByName(known.dropDuplicates(["text_hash"]))
    new = fresh.select("text_hash", F.lit(scorer.name).alias("model"), F.lit(scorer.version).alias("version"), "vector")
    return rows.join(every, "text_hash").withColumn("degraded", F.lit(scorer.degraded)), new


def score_pairs(pairs: DataFrame, scorer: Scorer, left: str = "left_text", right: str = "right_text") -> DataFrame:
    """Cosine (not below zero) of two text columns; every distinct text is embedded once."""
    texts = pairs.select(F.col(left).alias("text")).union(pairs.select(F.col(right).alias("text"))).distinct()
    v = embed(texts, scorer)[0].select("text", "vector")
    out = pairs.join(v.select(F.col("text").alias(left), F.col("vector").alias("_l")), left).join(v.select(F.col("text").alias(right), F.col("vector").alias("_r")), right)
    return out.withColumn("similarity", F.round(F.greatest(F.lit(0.0), cosine(F.col("_l"), F.col("_r"))), 6)).drop("_l", "_r")


def mean_vector(vectors: Column) -> Column:
    """Unit mean of an array of vectors."""
    total = F.aggregate(F.slice(vectors, F.lit(2), F.size(vectors)), F.element_at(vectors, 1), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    return unit(total)


def weighted_vector(vectors: Column, weights: Column) -> Column:
    """Unit mean weighted by (at least one) characters."""
    both = F.zip_with(vectors, weights, lambda v, w: F.transform(v, lambda x: x * F.greatest(F.lit(1.0), w.cast("double"))))
    return mean_vector(both)


def span_cosines(vector: str, units: str, spans: str) -> Column:
    """ARRAY<STRUCT<run_start, n_units, cosine>> of ``vector`` with the :func:`weighted_vector` of each span; spans without any vector are left out.

    ``units`` is an array of ``unit_idx, vector``, ``spans`` one of ``run_start, n_units, m``, where ``m`` has ``unit_idx, w``. Sums run in order, as those of
    :func:`dot` and :func:`unit`.
    """
    total = lambda x: float(np.cumsum(x)[-1]) if len(x) else 0.0

    @F.pandas_udf("array<struct<run_start long, n_units int, cosine double>>")
    def run(own: pd.Series, known: pd.Series, asked: pd.Series) -> pd.Series:
        out = []
        for t, us, ss in zip(own, known, asked):
            t, at = np.asarray(t, dtype="float64"), {u["unit_idx"]: np.asarray(u["vector"], dtype="float64") for u in us}
            found = []
            for s in ss:
                parts = [at[u["unit_idx"]] * max(1.0, float(u["w"] or 0)) for u in sorted(s["m"], key=lambda u: (u["unit_idx"] is None, u["unit_idx"])) if u["unit_idx"] in at]
                if parts:
                    v = parts[0]
                    for x in parts[1:]:
                        v = v + x
                    n = np.sqrt(total(v * v))
                    found.append({"run_start": int(s["run_start"]), "n_units": int(s["n_units"]), "cosine": max(-1.0, min(1.0, total(t * (v / (n if n else 1.0)))))})
            out.append(found)
        return pd.Series(out, dtype="object")

    return run(vector, units, spans)


def runs(rows: DataFrame, idx: str, value: Column, k: int, keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """(keys, run_start, run): the value at a position and at up to k-1 positions after it, in order."""
    member = rows.select(*keys, F.struct(F.col(idx).alias("i"), value.alias("v")).alias("m"), F.explode(F.sequence(F.greatest(F.lit(0), F.col(idx) - (k - 1)), F.col(idx))).alias("run_start"))
    g = member.groupBy(*keys, "run_start").agg(F.array_sort(F.collect_list("m")).alias("_r"))
    return g.where(F.element_at("_r", 1)["i"] == F.col("run_start")).select(*keys, "run_start", F.transform("_r", lambda m: m["v"]).alias("run"))


def pool_spans(vectors: DataFrame, k: int, idx: str = "idx", keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """Unit mean of 1..k consecutive vectors: (keys, start, count, vector)."""
    r = runs(vectors, idx, F.col("vector"), k, keys)
    rows = r.select(*keys, F.col("run_start").alias("start"), "run", F.explode(F.sequence(F.lit(1), F.size("run"))).alias("count"))
    return rows.select(*keys, "start", "count", mean_vector(F.slice("run", F.lit(1), F.col("count"))).alias("vector"))


def margin_scores(pairs: DataFrame, k: int = 4, keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """raw minus the mean of the row's and the column's best ``k``, scaled between the 2 % and 98 % ranks; flat data gives 0.5.

    ``pairs`` has ``i, j, raw`` (raw at six decimals): all pairs the caller wants as background. For whole recordings use
    :func:`rectangle_baselines`, which does not list the pairs.
    """
    from evidence_spark.operators.claims import top_per_key
    from evidence_spark.operators.rollups import nearest_rank_per

    keys = list(keys)
    p = pairs.withColumn("raw", F.round("raw", 6))
    base = {side: top_per_key(p.select(*keys, side, "raw"), [*keys, side], [F.col("raw").desc()], k).groupBy(*keys, side).agg(F.avg("raw").alias("_" + side)) for side in ("i", "j")}
    m = p.join(base["i"], [*keys, "i"]).join(base["j"], [*keys, "j"]).withColumn("margin", F.round(F.col("raw") - (F.col("_i") + F.col("_j")) / 2, 9))
    m = cut(m)
    lo = nearest_rank_per(m, keys, "margin", 0.02, "_lo", 1 / 64)
    hi = nearest_rank_per(m, keys, "margin", 0.98, "_hi", 1 / 64)
    m = m.join(lo, keys).join(hi, keys)
    score = F.when(F.col("_hi") <= F.col("_lo") + 1e-9, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("margin") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))))
    return m.select(*keys, "i", "j", "raw", "margin", score.alias("score"))


# --- background statistics over a whole recording's rectangle, tile by tile -------------------------

TILE = 512
#: a recording's rectangle of tiles is cut into about SIDES x SIDES blocks, with at most STRIP tiles a side
SIDES, STRIP = 6, 128


def _tiles(rows: DataFrame, idx: str, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, F.floor(F.col(idx) / TILE).alias("tile")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(idx).cast("long").alias("i"), F.col("vector").alias("v")))).alias("members"))


def _tile_pairs(source: DataFrame, target: DataFrame, keys: Sequence[str], facts: DataFrame | None = None) -> DataFrame:
    """Pairs of tiles of one recording as :func:`tiles.blocks`; a tile holds at most TILE vectors. Tile numbers are paired first and vectors joined to
    them by number, so a long recording is not one join key. ``facts`` of a recording ride along."""
    number = lambda df, name: df.select(*keys, F.floor(F.col("idx") / TILE).alias(name))
    ends = lambda df, name: number(df, name).groupBy(*keys).agg(F.min(name).alias(f"_{name}0"), F.max(name).alias(f"_{name}1"))
    pairs = number(source, "a").distinct().join(ends(source, "a"), list(keys)).join(ends(target, "b"), list(keys))
    pairs = pairs.select("*", F.explode(F.sequence("_b0", "_b1")).alias("b"))
    span = lambda n: F.least(F.lit(STRIP), F.greatest(F.lit(1), F.ceil((F.col(f"_{n}1") - F.col(f"_{n}0") + 1) / SIDES)))
    at = lambda n: F.floor((F.col(n) - F.col(f"_{n}0")) / span(n))
    pairs = pairs.select(*keys, F.concat_ws("/", at("a"), at("b")).alias("block"), "a", "b")
    if facts is not None:
        pairs = pairs.join(facts, list(keys))
    return blocks(pairs, _tiles(source, "idx", keys), _tiles(target, "idx", keys), keys)


def _load(r) -> tuple[np.ndarray, np.ndarray]:
    return np.array([x["i"] for x in r.members], dtype="int64"), np.array([list(x["v"]) for x in r.members])


def _cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.round(np.clip(left @ right.T, -1.0, 1.0), 6)


def rectangle_baselines(source: DataFrame, target: DataFrame, k: int = 4, keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """(keys, side, idx, baseline): mean of the best ``k`` cosines of every row (side "a") and column (side "b").

    Each task multiplies the tiles of a block and returns only the best ``k`` values per row and column of the block.
    """
    keys = list(keys)
    pairs = _tile_pairs(source, target, keys)
    schema = T.StructType([*[pairs.schema[c] for c in keys], T.StructField("side", T.StringType()), T.StructField("idx", T.LongType()), T.StructField("top", T.ArrayType(T.DoubleType()))])

    def best(old: np.ndarray | None, m: np.ndarray) -> np.ndarray:
        m = -m if m.shape[1] <= k else np.partition(-m, k - 1, axis=1)[:, :k]
        return np.sort(m if old is None else np.concatenate([old, m], axis=1), axis=1)[:, :k]

    def rows(here, side, ids, top):
        return pd.DataFrame([[*here[:-1], side, int(i), [-float(v) for v in t]] for i, t in zip(ids, top)], columns=schema.fieldNames())

    def run(parts):
        at, tops = None, {}
        for here, lefts, (ids, right), _ in met(parts, keys, _load):
            if here != at:
                for own, top in tops.values():
                    yield rows(at, "a", own, top)
                at, tops = here, {}
            column = None
            for tile, (own, left) in lefts:
                m = _cosines(left, right)
                tops[tile] = own, best(tops[tile][1] if tile in tops else None, m)
                column = best(column, m.T)
            if column is not None:
                yield rows(here, "b", ids, column)
        for own, top in tops.values():
            yield rows(at, "a", own, top)

    tops = pairs.mapInPandas(run, schema)
    g = tops.groupBy(*keys, "side", "idx").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top")), asc=False), 1, k).alias("top"))
    return g.select(*keys, "side", "idx", (F.aggregate("top", F.lit(0.0), lambda s, v: s + v) / F.size("top")).alias("baseline"))


def _with_baseline(rows: DataFrame, baselines: DataFrame, side: str, keys: Sequence[str]) -> DataFrame:
    """The baseline rides along as one more number of the vector."""
    own = baselines.where(F.col("side") == side).select(*keys, "idx", "baseline")
    return rows.join(own, [*keys, "idx"]).select(*keys, "idx", F.concat("vector", F.array("baseline")).alias("vector"))


def rectangle_rank(source: DataFrame, target: DataFrame, fraction: float, kind: str, keys: Sequence[str] = ("media_id",), baselines: DataFrame | None = None,
                   scale: DataFrame | None = None, name: str = "value") -> DataFrame:
    """Exact nearest-rank value per recording over all (row, column) cells, without listing the cells.

    ``kind`` is ``margin`` (raw minus the mean of both baselines), ``raw_cost`` (1 - raw, positive ones only) or ``margin_cost`` (1 - scaled margin,
    positive ones only; ``scale`` has ``lo, hi``). Two passes: tile histograms find the bin that holds the rank, then only the values
    of that bin are counted.
    """
    from evidence_spark.operators.scan import scan

    keys = list(keys)
    src, tgt = source, target
    if baselines is not None:
        src, tgt = _with_baseline(source, baselines, "a", keys), _with_baseline(target, baselines, "b", keys)
    facts = None if scale is None else scale.select(*keys, "lo", "hi")
    pairs = _tile_pairs(src, tgt, keys, facts)
    width = 1.0 / 512
    with_base = baselines is not None

    def cells(left, right, row) -> np.ndarray:
        if with_base:
            raw = _cosines(left[:, :-1], right[:, :-1])
            margin = raw - (left[:, -1:] + right[:, -1:].T) / 2
        else:
            raw, margin = _cosines(left, right), None
        if kind == "margin":
            v = margin
        elif kind == "raw_cost":
            v = 1.0 - raw
        else:
            lo, hi = row.lo, row.hi
            v = 1.0 - (np.full_like(margin, 0.5) if hi <= lo + 1e-9 else np.clip((margin - lo) / (hi - lo), 0.0, 1.0))
        v = np.round(v, 9).ravel()
        return v if kind == "margin" else v[v > 1e-9]

    key_fields = [pairs.schema[c] for c in keys]
    hist_schema = T.StructType([*key_fields, T.StructField("bin", T.LongType()), T.StructField("n", T.LongType())])
    value_schema = T.StructType([*key_fields, T.StructField("v", T.DoubleType()), T.StructField("n", T.LongType())])

    def count_bins(parts):
        for here, lefts, (_, right), row in met(parts, keys, _load):
            for _, (_, left) in lefts:
                bins, n = np.unique(np.floor(cells(left, right, row) / width).astype("int64"), return_counts=True)
                yield pd.DataFrame([[*here[:-1], int(x), int(y)] for x, y in zip(bins, n)], columns=hist_schema.fieldNames())

    hist = cut(pairs.mapInPandas(count_bins, hist_schema).groupBy(*keys, "bin").agg(F.sum("n").alias("n")))
    total = hist.groupBy(*keys).agg(F.bround((F.sum("n") - 1) * F.lit(fraction)).cast("long").alias("_rank"))
    placed = scan(hist, keys, ["bin"], sums_before={"_lo": F.col("n")}, block=F.lit(0))
    where = placed.join(total, keys).where("_rank >= _lo and _rank < _lo + n").select(*keys, F.col("bin").alias("wanted"), (F.col("_rank") - F.col("_lo")).alias("_left"))
    where = cut(where)
    wanted = _tile_pairs(src, tgt, keys, where if facts is None else facts.join(where, keys))

    def count_values(parts):
        for here, lefts, (_, right), row in met(parts, keys, _load):
            for _, (_, left) in lefts:
                v = cells(left, right, row)
                values, n = np.unique(v[np.floor(v / width).astype("int64") == int(row.wanted)], return_counts=True)
                yield pd.DataFrame([[*here[:-1], float(x), int(y)] for x, y in zip(values, n)], columns=value_schema.fieldNames())

    values = wanted.mapInPandas(count_values, value_schema).groupBy(*keys, "v").agg(F.sum("n").alias("n"))
    placed = scan(values, keys, ["v"], sums_before={"_lo": F.col("n")}, block=F.floor(F.col("v") / (width / 64)))
    return placed.join(where, keys).where("_left >= _lo and _left < _lo + n").select(*keys, F.col("v").alias(name))


def rectangle_margins(source: DataFrame, target: DataFrame, least: float, k: int = 4, keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """(keys, i, j, raw, margin, score): the cells of each recording's whole rectangle whose scaled margin is ``least`` or more.

    As :func:`margin_scores` over all pairs: baselines and both ranks are those of the rectangle, but only the asked cells leave a task.
    """
    keys = list(keys)
    base = cut(rectangle_baselines(source, target, k, keys))
    ends = [rectangle_rank(source, target, f, "margin", keys, base, name=name) for f, name in ((0.02, "lo"), (0.98, "hi"))]
    scale = cut(ends[0].join(ends[1], keys))
    pairs = _tile_pairs(_with_baseline(source, base, "a", keys), _with_baseline(target, base, "b", keys), keys, scale)
    schema = T.StructType([*[pairs.schema[c] for c in keys], *[T.StructField(c, t) for c, t in (("i", T.LongType()), ("j", T.LongType()), ("raw", T.DoubleType()), ("margin", T.DoubleType()), ("score", T.DoubleType()))]])

    def run(parts):
        for here, lefts, (j, right), r in met(parts, keys, _load):
            for _, (i, left) in lefts:
                raw = _cosines(left[:, :-1], right[:, :-1])
                margin = np.round(raw - (left[:, -1:] + right[:, -1:].T) / 2, 9)
                score = np.full_like(margin, 0.5) if r.hi <= r.lo + 1e-9 else np.round(np.clip((margin - r.lo) / (r.hi - r.lo), 0.0, 1.0), 6)
                x, y = np.nonzero(score >= least)
                yield pd.DataFrame({**{c: [v] * len(x) for c, v in zip(keys, here)}, "i": i[x], "j": j[y], "raw": raw[x, y], "margin": margin[x, y], "score": score[x, y]}, columns=schema.fieldNames())

    return pairs.mapInPandas(run, schema)


#: recall questions are configuration; longer lists are split by the caller
MAX_QUERIES = 256


def semantic_recall(claims: DataFrame, queries: Sequence[tuple[str, Sequence[float], Sequence[str], Sequence[str]]]) -> DataFrame:
    """Score every claim against every query: 0.82 cosine + 0.08 theme hit + up to 0.08 for words + 0.02 importance.

    ``claims`` has ``row_id, claim, vector, themes, importance``; a query is (name, unit vector, themes, words). The queries are
    literals of the projection, so claims are scored in place without a join or shuffle.
    """
    if len(queries) > MAX_QUERIES:
        raise ValueError(f"at most {MAX_QUERIES} queries per call")
    low = F.lower("claim")
    scored = []
    for name, vector, themes, words in queries:
        hits = F.lit(0)
        for w in words:
            hits = hits + F.when(F.contains(low, F.lit(w)), 1).otherwise(0)
        theme = F.arrays_overlap("themes", F.array(*[F.lit(t) for t in themes])) if themes else F.lit(False)
        scored.append(F.struct(F.lit(name).alias("query"), F.greatest(F.lit(0.0), cosine(F.col("vector"), F.lit(np.asarray(vector, dtype="float64")))).alias("semantic"),
                               theme.alias("theme_hit"), hits.alias("n_words")))
    rows = claims.select("row_id", "importance", F.explode(F.array(*scored)).alias("q")).select("row_id", "importance", "q.*")
    score = (0.82 * F.col("semantic") + F.when(F.col("theme_hit"), 0.08).otherwise(0.0) + F.least(F.lit(0.08), F.col("n_words") * 0.025) + 0.02 * F.col("importance"))
    return rows.select("row_id", "query", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 6).alias("score"), F.round("semantic", 6).alias("semantic"),
                       "theme_hit", "n_words", "importance")


def best_query(scores: DataFrame) -> DataFrame:
    return scores.groupBy("row_id").agg(F.max_by(F.struct("query", "score"), F.struct("score", F.col("query"))).alias("_b")).select("row_id", "_b.*")
