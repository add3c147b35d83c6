"""Near-duplicates by the similarity of word shingle sets: every pair at or above 4/5 is found and verified.

1. A text is the set of hashes of its five-word shingles. Texts of the same words are one node.
2. Texts whose SimHash fingerprints are equal or linked (:mod:`simhash`) are the first candidates: their verified links make most groups at
   once. They miss pairs, the following steps do not.
3. Under any total order of the shingles, two sets with similarity 4/5 or more have a common shingle among the first n - ceil(4n/5) + 1
   of each. The order goes from shingles that a sample of texts never repeats to its most common ones, so few texts meet by chance. The
   sample decides only how much work there is, never which pairs are found.
4. Texts with a common first shingle are candidates if their sizes, the place of the shingle and the parities of their sets still allow the
   similarity. Shared by many texts, a shingle first compares a few of them with the rest, and what is then in one component is not compared
   again. Parities: shingles fall into cells, and a cell in which one set has an odd and the other an even number of shingles holds a shingle
   that only one of them has.
5. Candidates are verified by their whole sets; groups are the connected components of the verified links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.llm.simhash import components, fingerprint, linked
from evidence_spark.session import cut, small

#: Words of a shingle.
WORDS = 5
#: Texts whose shingles are counted for the order, and how many repeated shingles of them are ranked.
SAMPLE, RANKED = 20_000, 200_000
#: Rounds in which each shingle compares a few texts with its others before all that are still apart are compared.
ROUNDS, FEW = 2, 4
#: Columns of 64 cells each that hold the parities of a set.
CELLS = [f"cells{k}" for k in range(8)]


def words_of(text: bytes) -> list[bytes]:
    """Words are cut at ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def hashed(text: bytes, words: int = WORDS) -> tuple[int, np.ndarray]:
    """The hash of a text's words in their order, and the distinct hashes of its word shingles, as signed longs; a shorter text is one
    shingle, a text without words has none."""
    from xxhash import xxh64_intdigest

    cut_up = words_of(text)
    joined = b" ".join(cut_up)
    found = set()
    if cut_up:
        stops = np.cumsum([len(w) + 1 for w in cut_up]) - 1
        ends = stops[min(words, len(cut_up)) - 1:]
        starts = np.concatenate([[0], stops[: len(ends) - 1] + 1])
        found = {xxh64_intdigest(joined[i:j], 42) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)}
    return int(np.uint64(xxh64_intdigest(joined, 7)).view(np.int64)), np.array(list(found), np.uint64).view(np.int64)


def node(text: bytes) -> int:
    """The hash of a text's words in their order, as a signed long."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(b" ".join(words_of(text)), 7)).view(np.int64))


def _texts(column):
    """The bytes of each text in turn."""
    return (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column.cast(pa.large_binary()))


def with_node(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the node of each row's text."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([node(t) for t in _texts(texts)], pa.int64())

    return docs.withColumn(name, run(F.col("text")))


def shingle_order(texts: DataFrame, n: int, sample: int = SAMPLE, ranked: int = RANKED) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, texts with them) of the most repeated shingles in about ``sample`` of ``n`` texts, sorted by shingle; at most ``ranked``."""
    def run(frames):
        for frame in frames:
            found = [hashed(t)[1] for t in _texts(frame.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found]))], ["shingle"])

    picked = texts.where(F.pmod(F.xxhash64("text"), F.lit(max(1, -(-n // sample)))) == 0).select("text")
    counted = picked.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = counted.orderBy(F.col("n").desc(), "shingle").limit(ranked).toArrow().sort_by("shingle")
    return rows.column("shingle").to_numpy(), rows.column("n").to_numpy()


def first_shingles(texts: DataFrame, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shingle, node, size, place) of the first shingles of every text, as many as a pair of similarity 4/5 needs to meet."""
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def run(frames):
        known, counts = shared.value
        for frame in frames:
            parts = []
            for t in _texts(frame.column("text")):
                i, s = hashed(t)
                if n := len(s):
                    times = np.zeros(n, np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        times = np.where(known[at] == s, counts[at], 0)
                    first = s[np.lexsort((s, times))[: n - (4 * n + 4) // 5 + 1]]
                    parts.append((first, np.full(len(first), i, np.int64), np.full(len(first), n, np.int32), np.arange(len(first), dtype=np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["shingle", "node", "size", "place"])

    return texts.select("text").mapInArrow(run, "shingle long, node long, size int, place int")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, shingles) of every text."""
    def run(frames):
        for frame in frames:
            found = [hashed(t) for t in _texts(frame.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("text").mapInArrow(run, "node long, shingles array<long>")


def parities(shingles: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles in each cell, as one long for each of CELLS."""
    odd = np.bincount((shingles.view(np.uint64) >> np.uint64(55)).astype(np.int64), minlength=64 * len(CELLS)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def signatures(texts: DataFrame) -> DataFrame:
    """(node, fingerprint, CELLS) of every text."""
    def run(frames):
        for frame in frames:
            nodes, prints, cells = [], [], np.empty((frame.num_rows, len(CELLS)), np.int64)
            for k, t in enumerate(_texts(frame.column("text"))):
                i, s = hashed(t)
                nodes.append(i)
                prints.append(fingerprint(t))
                cells[k] = parities(s)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), *map(pa.array, cells.T.copy())], ["node", "fingerprint", *CELLS])

    return texts.select("text").mapInArrow(run, "node long, fingerprint long, " + ", ".join(f"{c} long" for c in CELLS))


def linked_by_print(signs: DataFrame) -> DataFrame:
    """(a, b), a < b, of nodes with linked fingerprints: one node stands for a fingerprint, the others of it are paired with that one."""
    first = cut(signs.groupBy("fingerprint").agg(F.min("node").alias("one")))
    links = linked(first.select("fingerprint"))
    of = lambda n: first.select(F.col("fingerprint").alias(n), F.col("one").alias(f"_{n}"))
    met = links.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("node"), F.col("_b").alias("one"))
    same = signs.select("node", "fingerprint").join(first, "fingerprint").where("node != one").select("node", "one")
    return met.unionByName(same).select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()


def _allowed(pairs: DataFrame) -> DataFrame:
    """(a, b), a < b, of pairs whose sizes, common place and parities still allow the similarity."""
    both = F.col("size") + F.col("size2")
    most = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
    unlike = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in CELLS[1:]), F.bit_count(F.col(CELLS[0]).bitwiseXOR(F.col(f"{CELLS[0]}_2"))))
    # of sets with similarity 4/5 at most a ninth of both sizes is in one of them only
    fits = (5 * F.least("size", "size2") >= 4 * F.greatest("size", "size2")) & (9 * most >= 4 * both) & (9 * unlike <= both)
    return pairs.where(fits).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _verified(pairs: DataFrame, sets_of) -> DataFrame:
    """The pairs whose sets have similarity 4/5 or more. Only the texts of candidates are made into sets, and these are shuffled once for both sides."""
    sets = sets_of(cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    both = 9 * F.size(F.array_intersect("_x", "_y"))
    return pairs.join(x, "a").join(y, "b").where(both >= 4 * (F.size("_x") + F.size("_y"))).select("a", "b")


def node_roots(texts: DataFrame, n: int, sets_of, rounds: int = ROUNDS) -> DataFrame:
    """(node, root) for the nodes of ``texts`` (each of the ``n`` nodes once) that are linked to a smaller node; root is the smallest.

    ``sets_of`` returns (node, shingles) of a table of nodes.
    """
    places = first_shingles(texts, shingle_order(texts, n))
    # only shingles that several texts begin with can make a pair
    rows = places.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("_n > 1").drop("_n")
    signs = cut(signatures(texts))
    rows = cut(rows.join(signs.drop("fingerprint"), "node"))
    root, seen = places.sparkSession.createDataFrame([], "node long, root long"), None
    for k in range(-1, rounds + 1):
        if k < 0:
            pairs = cut(linked_by_print(signs))
        else:
            labelled = rows.join(root, "node", "left").select("shingle", "node", "size", "place", *CELLS, F.coalesce("root", "node").alias("label"))
            apart = labelled.groupBy("shingle").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo < _hi").select("shingle")
            labelled = cut(labelled.join(apart, "shingle"))
            other, once = labelled, F.col("label") < F.col("label2")
            if k < rounds:  # a few texts of each shingle, others in each round
                one = lambda j: F.min_by(F.struct("node", "size", "place", *CELLS, "label"), F.struct(F.xxhash64("node", F.lit(FEW * k + j)), F.col("node")))
                picked = labelled.groupBy("shingle").agg(F.array(*[one(j) for j in range(FEW)]).alias("_few"))
                other, once = picked.select("shingle", F.explode(F.array_distinct("_few")).alias("_one")).select("shingle", "_one.*"), F.col("label") != F.col("label2")
            other = other.select("shingle", *[F.col(c).alias(f"{c}2") for c in ("node", "size", "place", "label")], *[F.col(c).alias(f"{c}_2") for c in CELLS])
            pairs = cut(_allowed(labelled.join(other, "shingle").where(once)).join(small(seen), ["a", "b"], "left_anti"))
        seen = pairs if seen is None else seen.unionByName(pairs)
        if pairs.isEmpty():
            continue
        found = cut(_verified(pairs, sets_of))
        if not found.isEmpty():  # the components so far, as stars, and the new links
            root = cut(components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)))
    return root


def _one_row(docs: DataFrame, other: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` (with ``_node``) without the rows whose node and id are in ``other``, and one row of those in ``repeated``."""
    def joined(rows, keys, how):
        keys = small(keys.select(F.col("node").alias("_other_node"), F.col("doc_id").alias("_other_id")))
        return rows.join(keys, (F.col("_node") == F.col("_other_node")) & F.col("doc_id").eqNullSafe(F.col("_other_id")), how)

    kept = joined(docs, other, "left_anti")
    if repeated.isEmpty():
        return kept
    return joined(kept, repeated, "left_anti").unionByName(joined(kept, repeated, "left_semi").dropDuplicates(["_node"]))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest id; rows without an id come last.

    Groups are connected over pairs with shingle similarity 4/5 or more. Texts without words are one group. Of rows with the same id and the same
    words one stays; rows with the same id in different groups each stay.
    """
    with_nodes = with_node(docs, "_node")
    rows = cut(with_nodes.groupBy(F.col("_node").alias("node"), "doc_id").agg(F.count(F.lit(1)).alias("_rows")))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_no"), "doc_id", "node")).alias("_first")
    repeated = rows.where("_rows > 1").select("node", "doc_id")

    def others(placed):
        """The (node, doc_id) that are not the first of their root."""
        first = placed.groupBy("root").agg(least).select("root", F.col("_first.doc_id").alias("_id"), F.col("_first.node").alias("_at"))
        return cut(placed.join(first, "root").where((F.col("node") != F.col("_at")) | ~F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "doc_id"))

    # ids tell rows apart unless some repeat or are missing; then texts are hashed once, together with their shingles
    unique = rows.groupBy("doc_id").agg(F.sum("_rows").alias("_n")).where("_n > 1 or doc_id is null").isEmpty()
    copies = others(rows.withColumn("root", F.col("node")))
    if unique:
        texts = docs.select("doc_id", "text").join(small(copies.select("doc_id")), "doc_id", "left_anti")
    else:
        texts = _one_row(with_nodes.select("doc_id", "text", "_node"), copies, repeated)

    def sets_of(nodes):
        """One row of each node, found by its first id."""
        first = rows.join(small(nodes), "node", "left_semi").groupBy("node").agg(least)
        ids = small(cut(first.select(F.col("_first.doc_id").alias("_id")).distinct()))
        found = shingle_sets(docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"))
        return found if unique else found.join(small(nodes), "node", "left_semi").dropDuplicates(["node"])

    root = node_roots(texts.select("text"), rows.select("node").distinct().count(), sets_of)
    placed = rows.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _one_row(with_nodes, others(placed), repeated).select(*docs.columns)
