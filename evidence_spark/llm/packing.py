"""Packing documents into fixed-length training sequences by the sum-of-squares rule.

A document's token ids end with one separator id; documents longer than a sequence are cut into full pieces and one rest. A piece goes
where the sum over all residual gaps of the squared number of open sequences with that gap becomes smallest: into an open sequence or a
new one. The rule needs only a count per gap, so each task packs the pieces of its own partition as they come. Sequences that are not
full at the end are emptied, and their pieces are packed again, together with those of the other tasks.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.llm.tokens import byte_alphabet
from evidence_spark.session import cut

#: Words in each of a worker's two tables, about 40 MB together, and the characters of the longest word that is kept.
KNOWN, LONGEST = 150_000, 64
#: Pieces that one task packs again; more are dealt to several tasks.
TOGETHER = 200_000
#: Lower-case Latin-1 letters, and ASCII signs without apostrophe: the pre-tokenizer cuts exactly between a run of the ones and a run of the others.
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
PLACED = "doc_id {id}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"


class Words(dict):
    """Token ids of words as little-endian unsigned 32-bit bytes. Words that it does not hold are cut by the library when they are looked up.

    New words go into this table; a full one becomes the earlier table, and words found there return into this one. A letter run and the
    signs behind it are one pre-token each, so they are cut by the library's model, without its search for pre-tokens.
    """

    def __init__(self, library):
        super().__init__()
        self.library, self.tokenize = library, library.model.tokenize
        self.earlier: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        alphabet = byte_alphabet()
        self.letters = {code: "".join(alphabet[b] for b in chr(code).encode()) for code in range(0xDF, 0x100)}
        self.bytes_of = [k.to_bytes(4, "little") for k in range(library.get_vocab_size())]

    def _run(self, run: str) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(run)])

    def _cut(self, word: str) -> bytes:
        letters = word.rstrip(SIGNS)
        signs = word[len(letters):]
        letters = letters.lower()
        if "<|" in word or not (letters.isascii() and letters.isalpha() or LETTERS.fullmatch(letters)):
            return np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        after = self.signs.get(signs)
        if after is None:
            after = self._run(signs)
            if len(self.signs) < 10_000 and len(signs) <= LONGEST:
                self.signs[signs] = after
        return self._run(letters if letters.isascii() else letters.translate(self.letters)) + after

    def __missing__(self, word: str) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self._cut(word)
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.earlier = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, put together from those of their words.

    The vocabulary's pre-tokenizer never joins anything across ASCII white space, so a text's ids are those of its words. Words are looked
    up; new ones are cut by the library, whose special strings lie within words.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.words = Words(Tokenizer.from_str(spec))

    def of(self, texts: list[str]) -> list[bytes]:
        ids = self.words.__getitem__  # of a subclass of dict, so it calls __missing__
        return [b"".join(map(ids, t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))) for t in texts]


_IDS: dict[int, Ids] = {}


def ids_of(spec: str) -> Ids:
    key = hash(spec)
    if key not in _IDS:
        _IDS.clear()
        _IDS[key] = Ids(spec)
    return _IDS[key]


class Gaps:
    """Open sequences counted by their residual gap, and the rule that picks one for a piece."""

    def __init__(self, capacity: int):
        self.capacity, self.n = capacity, np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.gap: list[int] = []

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece. Taking gap g to g - length changes the sum of squares by 2 (n[g - length] - n[g]) + 2.

        Full sequences are not open and do not count. Ties go to the smallest gap, and to an open sequence before a new one.
        """
        c, n = self.capacity, self.n
        new = 2 * n[c - length] + 1 if length < c else 0
        best, change = 0, new
        if length < c:
            costs = 2 * (n[: c - length] - n[length:c]) + 2
            costs[0] = 1 - 2 * n[length]
            costs[n[length:c] == 0] = np.iinfo(np.int64).max
            k = int(costs.argmin())
            if costs[k] <= new:
                best, change = length + k, costs[k]
        if best:
            n[best] -= 1
            at = self.open[best].pop()
        else:
            best, at = c, len(self.gap)
            self.gap.append(c)
        self.gap[at] = best - length
        if best > length:
            n[best - length] += 1
            self.open.setdefault(best - length, []).append(at)
        return at, c - best


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order, and the gap left in each sequence."""
    gaps = Gaps(capacity)
    placed = np.array([gaps.place(int(x)) for x in lengths], np.int64).reshape(-1, 2)
    return placed[:, 0], placed[:, 1], np.array(gaps.gap, np.int64)


def packed_again(lengths: np.ndarray, capacity: int, rounds: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack pieces in several rounds: after each, what lies in sequences that are not full is packed anew in another order, longest first
    or shuffled (by a fixed seed); the round that ends with the fewest sequences counts."""
    rng = np.random.default_rng(0)
    where, offset, gap = sum_of_squares(lengths[(order := rng.permutation(len(lengths)))], capacity)
    number, at = np.empty_like(where), np.empty_like(offset)
    number[order], at[order] = where, offset
    for k in range(rounds):
        loose = np.flatnonzero(gap[number] > 0)
        if len(loose) < 2:
            break
        order = loose[np.argsort(-lengths[loose], kind="stable")] if k % 2 == 0 else rng.permutation(loose)
        where, offset, left = sum_of_squares(lengths[order], capacity)
        if len(left) <= int((gap > 0).sum()):
            full = np.flatnonzero(gap == 0)
            again = np.full(len(gap), -1)
            again[full] = np.arange(len(full))
            number = again[number]
            number[order], at[order] = len(full) + where, offset
            gap = np.concatenate([gap[full], left])
    return number, at, gap


def _placed_batch(doc_id, piece, start, length, crc, sequence, offset, gap, base):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(base + sequence, pa.int64()),
         pa.array(offset, pa.int64()), pa.array(gap[sequence] > 0, pa.bool_())],
        ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"])


def _base(round_: int) -> int:
    """The first sequence number of a task: tasks of all rounds have ranges of their own."""
    from pyspark import TaskContext

    return (round_ << 58) + (TaskContext.get().partitionId() << 36)


def cut_pieces(ids: bytes, capacity: int, separator: int) -> list[bytes]:
    whole = ids + separator.to_bytes(4, "little")
    return [whole[k: k + 4 * capacity] for k in range(0, len(whole), 4 * capacity)]


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, separator: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    Null and empty texts are one piece of the separator alone. Repeated rows are packed each. Empty tables give no rows. Other columns of
    ``docs`` are not read. ``vocabulary`` is the path of the vocabulary file on the driver.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def first(frames):
        import pyarrow as pa

        library, gaps, base = ids_of(spec.value), Gaps(capacity), _base(0)
        owners, placed = [], []  # of the pieces only numbers are held: some 60 bytes each
        for frame in frames:
            for k in range(0, frame.num_rows, 256):
                part = frame.slice(k, 256)
                taken, rows = [], []
                for i, ids in enumerate(library.of([t or "" for t in part.column("text").to_pylist()])):
                    for j, p in enumerate(cut_pieces(ids, capacity, separator)):
                        taken.append(i)
                        rows.append((j, j * capacity, len(p) // 4, zlib.crc32(p), *gaps.place(len(p) // 4)))
                owners.append(part.column("doc_id").take(pa.array(taken, pa.int64())))
                placed.append(np.array(rows, np.int64).reshape(-1, 6))
        if owners:
            piece, start, length, crc, sequence, offset = np.concatenate(placed).T
            yield _placed_batch(pa.concat_arrays(owners), piece, start, length, crc, sequence, offset, np.array(gaps.gap), base)

    def again(round_):
        def run(frames):
            import pyarrow as pa

            frames = [f for f in frames if f.num_rows]
            if frames:
                table = pa.Table.from_batches(frames).combine_chunks()
                column = {c: table.column(c).to_numpy() for c in ("piece", "start", "length", "ids_crc32")}
                sequence, offset, gap = packed_again(column["length"], capacity)
                yield _placed_batch(table.column("doc_id").chunk(0), *column.values(), sequence, offset, gap, _base(round_))

        return run

    schema = PLACED.format(id=kind)
    placed = cut(docs.select("doc_id", "text").mapInArrow(first, schema))
    done, loose, before = placed.where(~F.col("open")), placed.where("open"), None
    for round_ in range(1, 6):
        n = loose.count()
        if n == 0 or n == before:
            break
        tasks, before = -(-n // TOGETHER), n
        new = cut(loose.repartition(tasks).mapInArrow(again(round_), schema))
        done, loose = done.unionByName(new.where(~F.col("open"))), new.where("open")
        if tasks == 1:
            break
    return done.unionByName(loose).drop("open")


def packed_sequences(docs: DataFrame, placed: DataFrame, vocabulary: str, capacity: int = 4096, separator: int = 1) -> DataFrame:
    """The training sequences themselves: sequence_id, ids (at most ``capacity``) and doc_ids, the owner of each piece in order."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(frames):
        import pyarrow as pa

        library = ids_of(spec.value)
        for frame in frames:
            for k in range(0, frame.num_rows, 256):
                part = frame.slice(k, 256)
                found = [(i, j, p) for i, ids in enumerate(library.of([t or "" for t in part.column("text").to_pylist()])) for j, p in enumerate(cut_pieces(ids, capacity, separator))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array([i for i, _, _ in found], pa.int64())), pa.array([j for _, j, _ in found], pa.int32()), pa.array([zlib.crc32(p) for _, _, p in found], pa.int64()),
                     pa.array([np.frombuffer(p, "<u4").tolist() for _, _, p in found], pa.list_(pa.int32()))], ["_d", "_piece", "_crc", "_ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(run, f"_d {kind}, _piece int, _crc long, _ids array<int>").dropDuplicates(["_d", "_piece", "_crc"])
    joined = placed.join(pieces, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("piece") == F.col("_piece")) & (F.col("ids_crc32") == F.col("_crc")))
    ordered = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "_ids"))).alias("_p"))
    return ordered.select("sequence_id", F.flatten(F.transform("_p", lambda p: p["_ids"])).alias("ids"), F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"))
