"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word of the (23, 12) Golay code, whose every word lies
within three bits of exactly one codeword. The keys of a segment are the indices of the codewords nearest to it and to its one-bit
neighbours: at most six. Two segments that differ in two bits or fewer have a common neighbour, hence a common key.

Of at most four differing bits over three segments, either some segment has none, and then another has at most two (family A: one
segment exactly and a key of another), or every segment has one or two (family B: a key of each). So every pair of fingerprints within
four bits meets under some key; keys have 33 to 36 bits, and all pairs are verified by counting bits.

Only distinct fingerprints are keyed. Those under a key are compared in blocks, and a block gives a star per connected component, never its
pairs. Keys with more than BLOCK fingerprints are split into blocks that are compared two by two in separate tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.session import cut

#: Generator polynomial of the binary Golay code, and how the 64 bits are cut.
GENERATOR, PARITY = 0b110001110101, 11
SEGMENTS = ((0, 22), (22, 21), (43, 21))
BITS = 4
#: Fingerprints of one key that one task compares at once.
BLOCK = 1024
#: Rows of such a comparison at a time, and fingerprints keyed at a time.
ROWS, KEYED = 64, 500


# --- fingerprints -----------------------------------------------------------------------------------------------


def fingerprint(text: bytes, words: int = 4, seed: int = 42, chunk: int = 1 << 15) -> int:
    """The SimHash of a text's word shingles, repeats included; zero without words. Words are cut at ASCII white space, A-Z lower-cased."""
    from xxhash import xxh64_intdigest

    cut_up = text.lower().split()
    if not cut_up:
        return 0
    joined = b" ".join(cut_up)
    stops = np.cumsum([len(w) + 1 for w in cut_up]) - 1
    k = min(words, len(cut_up))
    ends = stops[k - 1:]
    starts = np.concatenate([[0], stops[: len(ends) - 1] + 1])
    n, counts = len(ends), np.zeros(64, np.int64)
    for a in range(0, n, chunk):
        h = np.array([xxh64_intdigest(joined[i:j], seed) for i, j in zip(starts[a: a + chunk].tolist(), ends[a: a + chunk].tolist(), strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _prints(texts: pa.Array, words: int) -> np.ndarray:
    return np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in texts.cast(pa.large_binary())], np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and fingerprint (a long with the 64 bits) of every row. Null and empty texts have fingerprint zero."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames):
        for frame in frames:
            if frame.num_rows:
                yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(_prints(frame.column("text"), words))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint long")


def print_column(text: Column, words: int = 4) -> Column:
    """The fingerprint of a text column."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(_prints(texts, words))

    return run(text)


# --- keys -------------------------------------------------------------------------------------------------------


def _remainder(word: int) -> int:
    for k in range(22, PARITY - 1, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - PARITY)
    return word


class Golay:
    """Nearest codeword of any 23-bit word, by its syndrome."""

    def __init__(self):
        single = np.array([_remainder(1 << k) for k in range(23)])
        self.low, self.high = self._sums(single[:12]), self._sums(single[12:])
        self.error = np.zeros(1 << PARITY, np.int64)
        bits = range(23)
        for pattern in [(), *((a,) for a in bits), *((a, b) for a in bits for b in range(a)), *((a, b, c) for a in bits for b in range(a) for c in range(b))]:
            syndrome = int(np.bitwise_xor.reduce(single[list(pattern)])) if pattern else 0
            self.error[syndrome] = sum(1 << k for k in pattern)

    @staticmethod
    def _sums(rows: np.ndarray) -> np.ndarray:
        """The xor of the rows picked by the bits of each index."""
        out = np.zeros(1, np.int64)
        for r in rows:
            out = np.concatenate([out, out ^ r])
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """12-bit index of the codeword nearest to each word."""
        return (words ^ self.error[self.low[words & 0xFFF] ^ self.high[words >> 12]]) >> PARITY

    def keys(self, words: np.ndarray, width: int) -> np.ndarray:
        """The indices near each word as a row of six, -1 where there are fewer."""
        probes = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(width))], axis=1)
        found = np.sort(self.index(probes), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = 1 << 20
        found = np.sort(found, axis=1)[:, :6]
        return np.where(found == 1 << 20, -1, found)


def fuzzy_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for every key of every fingerprint."""
    bits = prints.view(np.uint64)
    words = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [golay.keys(w, width) for w, (_, width) in zip(words, SEGMENTS, strict=True)]
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                who, which = np.nonzero(near[j] >= 0)
                rows.append(who)
                keys.append((3 * i + j) << 40 | words[i][who] << 12 | near[j][who, which])
    ok = (near[0] >= 0)[:, :, None, None] & (near[1] >= 0)[:, None, :, None] & (near[2] >= 0)[:, None, None, :]
    who, a, b, c = np.nonzero(ok)
    rows.append(who)
    keys.append(9 << 40 | near[0][who, a] << 24 | near[1][who, b] << 12 | near[2][who, c])
    return np.concatenate(rows), np.concatenate(keys)


# --- comparison -------------------------------------------------------------------------------------------------


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of 64-bit fingerprints held as signed longs (a signed count would take the absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def stars(prints: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """(fingerprint, smallest of its component) for the links among some fingerprints, without those that are alone."""
    near = np.empty((len(prints), len(prints)), bool)
    for k in range(0, len(prints), ROWS):  # eight bytes a pair for a few rows only
        near[k: k + ROWS] = differing(prints[k: k + ROWS, None], prints[None, :]) <= bits
    left, out = np.ones(len(prints), bool), []
    for k in np.argsort(prints, kind="stable").tolist():
        if left[k]:
            left[k] = False
            edge = near[k] & left
            while edge.any():
                left &= ~edge
                out += [(x, int(prints[k])) for x in prints[edge].tolist()]
                edge = near[edge].any(axis=0) & left
    return out


def _same_key(frames, bits: int):
    """From rows sorted by key: links (a, b) of fingerprints with a common key, and blocks (key, block, members) of keys with too many."""
    def batch(links, blocks):
        n, m = len(links), len(blocks)
        a, b = links.T if n else ([], [])
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(a, pa.int64()), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([x[0] for x in blocks], pa.int64())]), pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array([x[1] for x in blocks], pa.int32())]),
            pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([x[2] for x in blocks], pa.list_(pa.int64()))])], ["a", "b", "key", "block", "members"])

    def compared(keys, prints):
        """Links under complete keys: runs of two and three by shifted comparison, longer ones as stars."""
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.concatenate([start, [len(keys)]]))
        found = []
        for n, shifts in ((2, ((0, 1),)), (3, ((0, 1), (0, 2), (1, 2)))):
            at = start[size == n]
            for i, j in shifts:
                x, y = prints[at + i], prints[at + j]
                good = differing(x, y) <= bits
                found.append(np.stack([np.maximum(x, y)[good], np.minimum(x, y)[good]], axis=1))
        for at, n in zip(start[size > 3].tolist(), size[size > 3].tolist(), strict=True):
            if star := stars(prints[at: at + n], bits):
                found.append(np.array(star, np.int64))
        return np.unique(np.concatenate(found), axis=0)

    keys, prints, hot, links = np.empty(0, np.int64), np.empty(0, np.int64), {}, []
    for frame in frames:
        keys, prints = np.concatenate([keys, frame.column("key").to_numpy()]), np.concatenate([prints, frame.column("fingerprint").to_numpy()])
        while len(keys):
            last = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            if last:
                if keys[0] in hot:
                    ready = int(np.searchsorted(keys, keys[0], side="right"))
                    yield batch(np.empty((0, 2), np.int64), [(int(keys[0]), hot.pop(keys[0]), prints[:ready].tolist())])
                    keys, prints = keys[ready:], prints[ready:]
                    continue
                links.append(compared(keys[:last], prints[:last]))
                keys, prints = keys[last:], prints[last:]
            if len(keys) > BLOCK:
                no = hot.get(keys[0], 0)
                yield batch(np.empty((0, 2), np.int64), [(int(keys[0]), no, prints[:BLOCK].tolist())])
                hot = {keys[0]: no + 1}
                keys, prints = keys[BLOCK:], prints[BLOCK:]
                continue
            break
        if sum(map(len, links)) > 100_000:
            yield batch(np.unique(np.concatenate(links), axis=0), [])
            links = []
    if len(keys):
        if keys[0] in hot:
            yield batch(np.empty((0, 2), np.int64), [(int(keys[0]), hot[keys[0]], prints.tolist())])
        else:
            links.append(compared(keys, prints))
    if links:
        yield batch(np.unique(np.concatenate(links), axis=0), [])


def linked(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) over distinct fingerprints, a > b, whose connected components are those of all pairs within ``bits`` <= 4 bits."""
    if bits > BITS:
        raise ValueError("the keys are built for at most four differing bits")

    def keyed(frames):
        golay = Golay()
        for frame in frames:
            all_prints = frame.column("fingerprint").to_numpy()
            for k in range(0, len(all_prints), KEYED):
                part = all_prints[k: k + KEYED]
                who, keys = fuzzy_keys(part, golay)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[who])], ["key", "fingerprint"])

    def crossed(frames):
        for frame in frames:
            for x, y in zip(frame.column("members"), frame.column("others"), strict=True):
                found = stars(np.concatenate([x.values.to_numpy(), y.values.to_numpy()]), bits)
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    rows = prints.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long").repartition("key").sortWithinPartitions("key")
    met = cut(rows.mapInArrow(lambda f: _same_key(f, bits), "a long, b long, key long, block int, members array<long>"))
    blocks = met.where(F.col("key").isNotNull()).select("key", "block", "members")
    others = blocks.select("key", F.col("block").alias("block2"), F.col("members").alias("others"))
    within = blocks.join(others, "key").where(F.col("block") < F.col("block2")).select("members", "others").mapInArrow(crossed, "a long, b long")
    return met.where(F.col("key").isNull()).select("a", "b").unionByName(within).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) with the smallest node of each connected component, for every node that is not the root itself.

    Alternating stars: each node hangs its larger neighbours on its smallest one, then its smaller ones. Nothing is collected but a count
    and a checksum per round; both stop changing when every component is a star.
    """
    edges, before = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.u", "e.v").where("u != v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def print_components(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(fingerprint, root, component_id) of every distinct fingerprint: the smallest fingerprint and the smallest doc_id of its component."""
    distinct = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    root = components(linked(distinct, bits))
    placed = distinct.join(root, distinct["fingerprint"] == root["node"], "left").select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.join(lowest, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links of at most ``bits`` bits.

    Null and texts without words have fingerprint zero and link like any other. Repeated rows are each returned. Null ids take part, but
    are never the smallest; a component of null ids only has a null id. Empty tables give no rows. Other columns are not read.
    """
    prints = cut(fingerprints(docs, words))
    return prints.join(print_components(prints, bits), "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest id. Of repeated rows of that id one stays, and of a
    group whose rows all lack an id any one."""
    prints = cut(fingerprints(docs, words))
    of_print = cut(print_components(prints, bits))
    first = prints.join(of_print, "fingerprint").where(F.col("doc_id") == F.col("component_id")).groupBy(F.col("component_id").alias("_first")).agg(F.count(F.lit(1)).alias("_rows"))
    joined = docs.join(first, docs["doc_id"] == first["_first"])
    once, more = joined.where(F.col("_rows") == 1), joined.where(F.col("_rows") > 1)
    nameless = docs.where(F.col("doc_id").isNull()).withColumn("_print", print_column(F.col("text"), words))
    alone = of_print.where(F.col("component_id").isNull()).select(F.col("fingerprint").alias("_print"), F.col("root").alias("_first"))
    kept = [once, more.dropDuplicates(["_first"]), nameless.join(alone, "_print").dropDuplicates(["_first"])]
    return kept[0].select(*docs.columns).unionByName(kept[1].select(*docs.columns)).unionByName(kept[2].select(*docs.columns))
