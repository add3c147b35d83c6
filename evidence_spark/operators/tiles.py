"""Similarity joins of vectors: tiles of near vectors, tile pairs ruled out by centre and radius, matrix products of the rest.

A tile is one row that holds the numbers of about ``bytes_`` of vectors. Vectors go to the nearest of a few pivots, and the vectors of a
pivot are dealt over as many tiles as they fill, so a group of copies of any size is many tiles. Pairs of tiles come from a sequence of tile
numbers; vectors are joined to them by number. Two tiles cannot hold a pair with a dot product of ``least`` if their centres are too far
apart for their radii and longest vectors; such pairs of tiles are dropped before any vector is sent. The rectangle of tiles is cut into a
bounded number of blocks, and a tile is sent once to each block it lies in and not once to each pair, so what is sent grows with the rows.

Rows without a vector take no part; a zero vector has dot product 0 with all. Ids must be unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.session import cut, spread

TILE_BYTES = 2 << 20
#: vectors that stand for regions; the only ones that reach the driver
PIVOTS = 256
#: rows of a tile that are multiplied at a time
SLAB = 512
#: a rectangle of tiles is cut into about SIDES x SIDES blocks; a task holds the left tiles of one, at most STRIP_BYTES of them
SIDES = 8
STRIP_BYTES = 64 << 20
NO_LIMIT = (1 << 63) - 1


@dataclass(frozen=True)
class Tiles:
    """``rows`` has ``tile, ids, limits, vectors`` (packed numbers) and ``centre, radius, norm``; tiles are numbered below ``count``."""
    rows: DataFrame
    count: int


def _grid(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in vectors])


def tiled(rows: DataFrame, idx: str = "idx", vector: str = "vector", limit: Column | None = None, bytes_: int = TILE_BYTES) -> Tiles:
    """Vectors as tiles. ``limit`` is a number that travels with each vector (see :func:`next_best`)."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))  # a row here is a whole tile
    limit = F.lit(NO_LIMIT) if limit is None else F.coalesce(limit, F.lit(NO_LIMIT))
    base = rows.where(F.col(vector).isNotNull()).select(F.col(idx).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v"), limit.cast("long").alias("limit"))
    n, dim = base.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    size = max(2, bytes_ // (8 * (dim or 1)))
    marks = [list(r["v"]) for r in base.orderBy(F.xxhash64("i"), "i").limit(min(PIVOTS, -(-n // size))).collect()]
    pivots = np.array(marks) if marks else np.zeros((1, 1))

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(np.argmin((pivots ** 2).sum(axis=1) - 2 * _grid(v) @ pivots.T, axis=1)) if len(v) else pd.Series([], dtype="int32")

    placed = cut(base.withColumn("cell", nearest("v") if len(marks) > 1 else F.lit(0)))
    cells, first = [], 0
    for cell, members in sorted(placed.groupBy("cell").count().collect()):  # at most PIVOTS rows
        k = -(-members // size)
        cells.append((cell, first, k))
        first += k
    places = F.broadcast(spark.createDataFrame(cells, "cell int, first long, k long"))
    tile = (F.col("first") + F.pmod(F.xxhash64("i"), F.col("k"))).alias("tile")

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for t, members in zip(part["tile"], part["members"]):
                ids, limits = (np.array([m[name] for m in members], dtype="int64") for name in ("i", "limit"))
                grid = np.array([list(m["v"]) for m in members], dtype="float64")
                centre = grid.mean(axis=0)
                out.append([t, ids.tobytes(), limits.tobytes(), grid.tobytes(), centre, float(np.sqrt(((grid - centre) ** 2).sum(axis=1)).max()), float(np.sqrt((grid ** 2).sum(axis=1)).max())])
            yield pd.DataFrame(out, columns=["tile", "ids", "limits", "vectors", "centre", "radius", "norm"])

    members = placed.join(places, "cell").groupBy(tile).agg(F.array_sort(F.collect_list(F.struct("i", "limit", "v"))).alias("members"))
    return Tiles(cut(members.mapInPandas(pack, "tile long, ids binary, limits binary, vectors binary, centre array<double>, radius double, norm double")), first)


def tile_pairs(a: Tiles, b: Tiles, least: float, half: bool = False) -> DataFrame:
    """(a, b): numbers of the tiles that may hold a pair with a dot product of ``least``; ``half`` leaves out b < a."""
    ids = a.rows.select(F.col("tile").alias("a"), F.explode(F.sequence(F.col("tile") if half else F.lit(0).cast("long"), F.lit(max(b.count - 1, 0)).cast("long"))).alias("b"))
    side = lambda t, n: t.rows.select(F.col("tile").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("centre", "radius", "norm")])
    apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    gap = F.greatest(F.lit(0.0), apart - F.col("radius_a") - F.col("radius_b"))
    # |x - y|^2 = |x|^2 + |y|^2 - 2 xy; the slack covers products rounded to six decimals
    near = gap * gap <= F.col("norm_a") * F.col("norm_a") + F.col("norm_b") * F.col("norm_b") - 2 * least + 1e-5
    return spread(ids, "a", "b").join(side(a, "a"), "a").join(side(b, "b"), "b").where(near).select("a", "b")


def blocks(pairs: DataFrame, lefts: DataFrame, rights: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of tiles as blocks of work, sorted: the left tiles of a block, then its right tiles with the left ones each ``meets``.

    ``pairs`` has ``keys, block, a, b`` and maybe facts of the keys that ride along; ``lefts`` and ``rights`` have ``keys, tile`` and the same further columns.
    """
    facts = [c for c in pairs.columns if c not in ("a", "b")]
    left = pairs.select(*facts, F.col("a").alias("tile")).distinct().withColumn("meets", F.array().cast("array<long>"))
    right = pairs.groupBy(*facts, F.col("b").alias("tile")).agg(F.collect_list(F.col("a").cast("long")).alias("meets"))
    sent = lambda t, rows, is_right: t.join(rows, [*keys, "tile"]).withColumn("is_right", F.lit(is_right))
    return spread(sent(left, lefts, False).unionByName(sent(right, rights, True)), *keys, "block").sortWithinPartitions(*keys, "block", "is_right")


def met(parts: Iterator[pd.DataFrame], keys: Sequence[str], load: Callable) -> Iterator[tuple]:
    """(block, its left tiles so far, right tile, row) for every right tile of sorted :func:`blocks`; left tiles are (number, loaded) pairs that meet the right one."""
    at, held = None, {}
    for part in parts:
        places = [part.columns.get_loc(c) for c in (*keys, "block")]
        for r in part.itertuples(index=False):
            here = tuple(r[p] for p in places)
            if here != at:
                at, held = here, {}
            if r.is_right:
                yield here, [(t, held[t]) for t in map(int, r.meets)], load(r), r
            else:
                held[int(r.tile)] = load(r)


def products(a: Tiles, b: Tiles, pairs: DataFrame, pick: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple], same: bool = False, bytes_: int = TILE_BYTES) -> DataFrame:
    """(left, right, score): the cells that ``pick(scores, left ids, right ids, right limits)`` names by row and column numbers, slab by slab."""
    side = lambda t: t.rows.select("tile", "ids", "limits", "vectors")
    longest = max(1, STRIP_BYTES // bytes_)
    span = lambda t: min(longest, -(-t.count // SIDES) or 1)
    block = F.floor(F.col("a") / span(a)) * (b.count + 1) + F.floor(F.col("b") / span(b))

    def load(r):
        ids = np.frombuffer(r.ids, "int64")
        return ids, np.frombuffer(r.limits, "int64"), np.frombuffer(r.vectors).reshape(len(ids), -1)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, lefts, (right, limits, y), r in met(parts, [], load):
            for tile, (left, _, x) in lefts:
                for at in range(0, len(left), SLAB):
                    m = np.round(np.clip(x[at: at + SLAB] @ y.T, -1.0, 1.0), 6)
                    rows, cols = pick(m, left[at: at + SLAB], right, limits)
                    one, two, score = left[at: at + SLAB][rows], right[cols], m[rows, cols]
                    if same:
                        keep = one < two if tile == r.tile else np.full(len(one), True)
                        one, two, score = np.minimum(one, two)[keep], np.maximum(one, two)[keep], score[keep]
                    if len(one):
                        yield pd.DataFrame({"left": one, "right": two, "score": score})

    return blocks(pairs.withColumn("block", block), side(a), side(b)).mapInPandas(run, "left long, right long, score double")


def similar_pairs(rows: DataFrame, threshold: float, idx: str = "idx", vector: str = "vector", bytes_: int = TILE_BYTES) -> DataFrame:
    """(left, right, similarity) of rows with cosine (six decimals) at or above ``threshold``, the smaller id on the left. Vectors have unit length."""
    t = tiled(rows, idx, vector, bytes_=bytes_)
    return products(t, t, tile_pairs(t, t, threshold, half=True), lambda m, *_: np.nonzero(m >= threshold), same=True, bytes_=bytes_).withColumnRenamed("score", "similarity")


def similar_between(lefts: DataFrame, rights: DataFrame, threshold: float, idx: str = "idx", vector: str = "vector", bytes_: int = TILE_BYTES) -> DataFrame:
    """(left, right, score): pairs of the whole rectangle with cosine (six decimals) at or above ``threshold``."""
    a, b = tiled(lefts, idx, vector, bytes_=bytes_), tiled(rights, idx, vector, bytes_=bytes_)
    return products(a, b, tile_pairs(a, b, threshold), lambda m, *_: np.nonzero(m >= threshold), bytes_=bytes_)


def next_best(lefts: DataFrame, rights: Tiles, k: int, least: float, idx: str = "idx", vector: str = "vector", bytes_: int = TILE_BYTES) -> DataFrame:
    """(left, right, score): the best ``k`` rights of every left that score ``least`` and whose limit is not below the left; ties to the smaller right."""
    from evidence_spark.operators.claims import top_per_key

    def pick(m, left, right, limits):
        free = np.where((m >= least) & (limits[None, :] >= left[:, None]), m, -np.inf)
        bar = np.partition(free, -k, axis=1)[:, -k] if k < len(right) else np.full(len(left), -np.inf)
        rows, cols = np.nonzero((free >= bar[:, None]) & (free > -np.inf))
        order = np.lexsort((right[cols], -free[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        return rows[nth < k], cols[nth < k]

    a = tiled(lefts, idx, vector, bytes_=bytes_)
    found = products(a, rights, tile_pairs(a, rights, least), pick, bytes_=bytes_)
    return top_per_key(found, ["left"], [F.col("score").desc(), F.col("right")], k).drop("rank")
