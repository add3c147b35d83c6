"""Token counts by a compiled finite-state transducer.

A byte-level BPE vocabulary with word ends (the kind whose pre-tokenizer cuts contractions, letter runs, single numbers and other runs)
is compiled into a deterministic transducer over characters. Its transitions carry how many tokens they add, so a text is counted by
table look-ups alone. The transducer rests on one property of BPE: a token sequence is the tokenization of its string exactly when each
neighbouring pair is the tokenization of its own string. So every prefix of a word ends in one certain token, and a state needs only the
last tokens at those earlier positions from which a vocabulary token may still reach past the end. States and transitions are compiled
when first met and kept for the life of the worker.

White space leads every state back to the start state. A chunk of text is therefore a state map with three parts: the head before its
first white space (to be run from whatever state comes in), a fixed count for its body, and the tail after its last white space, which
names the state that goes out. Maps compose associatively, so long texts are cut into chunks, mapped in parallel and composed by a scan.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-tokenizer pattern whose automaton is built here (fixed value of the vocabulary file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: Characters above this code point are left to the library; below it, the library itself says what each character is.
TABLE = 0x3000
#: Compiled states kept by a worker; when there are more, compilation begins anew.
MAX_STATES = 200_000
#: Characters per row of a long text, and per lane of the vectorised run.
CHUNK, LANE = 1 << 18, 256
BLANK = re.compile(r"[ \t\n\r]")
SPACE = 0
#: The state after a prefix that does not end in one certain token; the library counts such texts. None is known for proper BPE merges.
LOST = 1
LETTER, NUMBER, OTHER = 1, 2, 3


def byte_alphabet() -> list[str]:
    """Byte-level BPE writes each byte as a printable character: itself if printable in Latin-1, else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class Merges:
    """Vocabulary side: which strings are tokens, and whether two tokens may stand next to each other."""

    def __init__(self, model: dict):
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        tokens = list(model["vocab"])
        self.inner = {t for t in tokens if not t.endswith(END)}
        self.final = {t[: -len(END)] for t in tokens if t.endswith(END)}
        self.reach = {t[:k] for t in self.inner for k in range(1, len(t))} | {t[:k] for t in self.final for k in range(1, len(t) + 1)}
        self.known: dict[tuple[str, str, bool], bool] = {}

    def cut(self, symbols: list[str]) -> list[str]:
        """Plain BPE over a few symbols: merge the lowest ranked pair, leftmost first, until none is left."""
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            if (symbols[best], symbols[best + 1]) not in self.rank:
                break
            symbols = symbols[:best] + [symbols[best] + symbols[best + 1]] + symbols[best + 2:]
        return symbols

    def fits(self, left: str, right: str, final: bool) -> bool:
        """Whether ``left`` then ``right`` (the end of a word if ``final``) is the tokenization of their string; an empty left is a word start."""
        key = (left, right, final)
        if key not in self.known:
            last = [*right[:-1], right[-1] + END] if final else [*right]
            want = [left] * bool(left) + [right + END if final else right]
            self.known[key] = self.cut([*left, *last]) == want
        return self.known[key]


#: A state within a word: its kind, the bytes that may still matter, and for earlier positions (bytes back, last token there, tokens there less tokens here).
Word = tuple[int, str, tuple[tuple[int, str, int], ...]]


class Transducer:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.spec, data = spec, json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        steps = [p.get("pattern", {}).get("Regex") for p in data["pre_tokenizer"]["pretokenizers"]]
        names = [n["type"] for n in data["normalizer"]["normalizers"]]
        if PATTERN not in steps or names != ["NFC", "Replace", "Lowercase"] or data["model"].get("end_of_word_suffix") != END:
            raise ValueError("this transducer compiles BPE vocabularies with word ends and the pattern in PATTERN")
        self.special = [t["content"] for t in data["added_tokens"]]
        self.merges = Merges(data["model"])
        self.bytes = byte_alphabet()
        self.kind_of: dict[str, int] = {}
        self._reset()

    # --- compilation ---------------------------------------------------------------------------------------------

    def _reset(self) -> None:
        self.states: list = ["start", "lost"]
        self.number: dict = {"start": 0, "lost": LOST}
        self.classes: list[str] = [" "]
        self.class_of = np.full(TABLE, -1, np.int16)  # -1: not met yet, -2: left to the library
        self.width = 96
        self.next = np.full((1024, self.width), -1, np.int32)
        self.adds = np.zeros((1024, self.width), np.int16)

    def _learn(self, codes: np.ndarray) -> None:
        """Give classes to code points met for the first time; the library says how it normalises and cuts each of them."""
        pre, norm = self.library.pre_tokenizer.pre_tokenize_str, self.library.normalizer.normalize_str
        for code in codes.tolist():
            c = norm(chr(code))
            if len(c) != 1 or not unicodedata.is_normalized("NFC", c):
                self.class_of[code] = -2
                continue
            parts = len(pre(f"a{c}a"))
            kind = SPACE if c == " " or parts == 2 else LETTER if parts == 1 else OTHER if len(pre(f"!{c}")) == 1 else NUMBER
            self.kind_of[c] = kind
            if kind == SPACE:
                self.class_of[code] = 0
            else:
                if c not in self.classes:
                    self.classes.append(c)
                self.class_of[code] = self.classes.index(c)
        while len(self.classes) > self.width:
            self.width *= 2
            self.next = np.hstack([self.next, np.full_like(self.next, -1)])
            self.adds = np.hstack([self.adds, np.zeros_like(self.adds)])

    def _id(self, state) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            if len(self.states) > len(self.next):
                more = len(self.next) // 2
                self.next = np.vstack([self.next, np.full((more, self.width), -1, np.int32)])
                self.adds = np.vstack([self.adds, np.zeros((more, self.width), np.int16)])
        return self.number[state]

    def _grow(self, word: Word, char: str) -> tuple[Word, int]:
        """The state after one more character of the same word, and how many tokens more its bytes so far make."""
        kind, tail, entries = word
        added = 0
        for byte in char.encode():
            b = self.bytes[byte]
            tail += b
            cut = len(tail)
            found = [(back, last, rel) for back, last, rel in entries if tail[cut - back - 1:] in self.merges.inner and self.merges.fits(last, tail[cut - back - 1:], False)]
            if len(found) != 1:
                raise LookupError(f"{len(found)} tokens can end the prefix {tail!r}")
            back, _, rel = found[0]
            here = rel + 1
            kept = [(d + 1, last, r - here) for d, last, r in entries if tail[cut - d - 1:] in self.merges.reach]
            entries = ((0, tail[cut - back - 1:], 0), *kept)
            added += here
        far = max(d for d, _, _ in entries)
        return (kind, tail[len(tail) - far:], entries), added

    def _begin(self, kind: int, char: str) -> tuple[Word, int]:
        return self._grow((kind, "", ((0, "", 0),)), char)

    def _ending(self, word: Word) -> int:
        """How many tokens more a word has as a whole than its bytes so far make: its last byte now ends a word."""
        _, tail, entries = word
        found = [rel + 1 for back, last, rel in entries if back and tail[len(tail) - back:] in self.merges.final and self.merges.fits(last, tail[len(tail) - back:], True)]
        if len(found) != 1:
            raise LookupError(f"{len(found)} tokens can end the word {tail!r}")
        return found[0]

    def _whole(self, text: str) -> int:
        word, n = self._begin(OTHER, text[0])
        for c in text[1:]:
            word, more = self._grow(word, c)
            n += more
        return n + self._ending(word)

    def _step(self, state, char: str):
        """The transition function: (state, character) to (state, tokens added). A string state is a pending contraction."""
        kind = self.kind_of[char] if char != " " else SPACE
        if isinstance(state, tuple):
            if kind == state[0] and kind != NUMBER:
                return self._grow(state, char)
            after, more = self._step("start", char)
            return after, self._ending(state) + more
        if state == "start":
            if kind == SPACE:
                return "start", 0
            if kind == NUMBER:
                return "start", self._whole(char)
            return ("'", 0) if char == "'" else self._begin(kind, char)
        if state == "'":
            if char in "stmd":
                return "start", self._whole("'" + char)
            if char in "rvl":
                return "'" + char, 0
            if kind == OTHER:
                word, n = self._begin(OTHER, "'")
                word, more = self._grow(word, char)
                return word, n + more
        elif state + char in ("'re", "'ve", "'ll"):
            return "start", self._whole(state + char)
        else:
            word, n = self._begin(LETTER, state[1])
            after, more = self._step(word, char)
            return after, self._whole("'") + n + more
        after, more = self._step("start", char)
        return after, self._whole("'") + more

    def _compile(self, states: np.ndarray, classes: np.ndarray) -> None:
        for s, c in set(zip(states.tolist(), classes.tolist(), strict=True)):
            try:
                after, more = self._step(self.states[s], self.classes[c]) if s != LOST else ("lost", 0)
            except LookupError:
                after, more = "lost", 0
            to = self._id(after)
            self.next[s, c], self.adds[s, c] = to, more

    # --- running -------------------------------------------------------------------------------------------------

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text as the library counts them, without added special tokens."""
        out = [0] * len(texts)
        own = [k for k, t in enumerate(texts) if t and (t.isascii() or unicodedata.is_normalized("NFC", t)) and not any(s in t for s in self.special)]
        codes = [np.frombuffer((texts[k] + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for k in own]
        ok = [len(x) and int(x.max()) < TABLE for x in codes]
        foreign = set(range(len(texts))) - {k for k, good in zip(own, ok, strict=True) if good}
        own, codes = [k for k, good in zip(own, ok, strict=True) if good], [x for x, good in zip(codes, ok, strict=True) if good]
        if codes:
            if len(self.states) > MAX_STATES:
                self._reset()
            ends = np.cumsum([len(x) for x in codes])
            flat = np.concatenate(codes)
            if (new := np.unique(flat[self.class_of[flat] == -1])).size:
                self._learn(new)
            classes = self.class_of[flat]
            bad = np.unique(np.searchsorted(ends, np.flatnonzero(classes == -2), side="right"))
            foreign |= {own[i] for i in bad.tolist()}
            classes = np.where(classes < 0, 0, classes)
            totals, lost = self._run(classes, ends)
            foreign |= {own[i] for i in lost}
            for k, n in zip(own, totals.tolist(), strict=True):
                out[k] = n
        foreign = [k for k in sorted(foreign) if texts[k]]
        for k, e in zip(foreign, self.library.encode_batch([texts[k] for k in foreign], add_special_tokens=False), strict=True):
            out[k] = len(e.ids)
        return out

    def _run(self, classes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Run texts that each end in white space, as lanes that begin after white space and so in the start state.

        Gives the sum over the lanes of each text, and the texts in which some lane got lost.
        """
        blanks = np.flatnonzero(classes == 0)
        cuts = blanks[np.minimum(np.searchsorted(blanks, np.arange(LANE, len(classes), LANE)), len(blanks) - 1)] + 1
        stops = np.unique(np.concatenate([cuts, ends]))
        starts = np.concatenate([[0], stops[:-1]])
        order = np.argsort(starts - stops, kind="stable")  # longest first: the lanes still running are a prefix
        at, left = starts[order], (stops - starts)[order]
        state, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        alive = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right")
        for t, n in enumerate(alive.tolist()):
            c = classes[at[:n] + t]
            s = state[:n]
            to = self.next[s, c]
            if (gap := to < 0).any():
                self._compile(s[gap], c[gap])
                to = self.next[s, c]
            total[:n] += self.adds[s, c]
            state[:n] = to
        by_lane = np.empty(len(at), np.int64)
        by_lane[order] = total
        lost = np.searchsorted(ends, starts[order[state == LOST]], side="right")
        return np.add.reduceat(by_lane, np.concatenate([[0], np.searchsorted(stops, ends[:-1], side="right")])), set(lost.tolist())

    # --- state maps ----------------------------------------------------------------------------------------------

    def chunk_maps(self, chunks: list[str]) -> list[tuple[str, int, str | None]]:
        """The state map of each chunk: (head, tokens of the body, tail); a chunk without white space is all head and has no tail."""
        parts = []
        for c in chunks:
            first = BLANK.search(c)
            if first is None:
                parts.append((c, "", None))
            else:
                last = max(c.rfind(x) for x in " \t\n\r")
                parts.append((c[: first.start()], c[first.start(): last + 1], c[last + 1:]))
        return [(h, n, t) for (h, _, t), n in zip(parts, self.count([b for _, b, _ in parts]), strict=True)]

    def compose(self, maps: list[tuple[str, int, str | None]]) -> int:
        """Tokens of a text whose chunks have these maps, in order: bodies add up, each tail runs on through the next heads."""
        pending, joints, total = "", [], 0
        for head, body, tail in maps:
            pending += head
            if tail is not None:
                joints.append(pending)
                pending, total = tail, total + body
        return total + sum(self.count([*joints, pending]))


_COMPILED: dict[int, Transducer] = {}


def compiled(spec: str) -> Transducer:
    """The worker's transducer for a vocabulary file's text; its tables grow from task to task."""
    key = hash(spec)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(spec)
    return _COMPILED[key]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, batch_chars: int = 4_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``; ``vocabulary`` is the path of the vocabulary file on the driver.

    Null and empty texts have no tokens. Repeated rows are counted each. Texts longer than CHUNK characters are cut into rows whose state
    maps are composed per text. Other columns of ``docs`` are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64("text").alias("_key"), text.alias("_text"))
    rows = rows.withColumn("_parts", F.greatest(F.ceil(F.length("_text") / F.lit(CHUNK)), F.lit(1)).cast("int"))
    short = rows.where(F.col("_parts") == 1).select("doc_id", "n_bytes", "_text")
    long = rows.where(F.col("_parts") > 1).select("doc_id", "n_bytes", "_key", F.explode(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: F.struct(
        k.alias("part"), F.substr(F.col("_text"), k * CHUNK + 1, F.lit(CHUNK)).alias("text")))).alias("_c")).select("doc_id", "n_bytes", "_key", "_c.part", "_c.text")

    def batches(table, column):
        """Slices of an Arrow batch with about ``batch_chars`` characters."""
        import pyarrow.compute as pc

        if not table.num_rows:
            return
        size = np.cumsum(np.asarray(pc.binary_length(table.column(column)), dtype=np.int64))
        starts = [0, *np.flatnonzero(np.diff(size // batch_chars)).astype(int) + 1, table.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            if b > a:
                yield table.slice(a, b - a)

    def count(frames):
        import pyarrow as pa

        machine = compiled(spec.value)
        for frame in frames:
            for part in batches(frame, "_text"):
                n = machine.count(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    def maps(frames):
        import pyarrow as pa

        machine = compiled(spec.value)
        for frame in frames:
            for part in batches(frame, "text"):
                head, body, tail = zip(*machine.chunk_maps(part.column("text").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("doc_id", "n_bytes", "_key", "part")], pa.array(head, pa.string()), pa.array(body, pa.int64()), pa.array(tail, pa.string())],
                    ["doc_id", "n_bytes", "_key", "part", "head", "body", "tail"])

    def compose(pdf):
        import pandas as pd

        machine = compiled(spec.value)
        chunks = pdf.sort_values("part").drop_duplicates("part")
        n = machine.compose([(h, int(b), None if t is None else t) for h, b, t in zip(chunks["head"], chunks["body"], chunks["tail"], strict=True)])
        copies = len(pdf) // len(chunks)
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]] * copies, "n_bytes": [pdf["n_bytes"].iloc[0]] * copies, "n_tokens": [n] * copies})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"
    counted = short.mapInArrow(count, schema)
    mapped = long.mapInArrow(maps, f"doc_id {kind}, n_bytes long, _key long, part int, head string, body long, tail string")
    composed = mapped.groupBy("doc_id", "_key").applyInPandas(compose, schema)
    return counted.unionByName(composed).withColumn("over_limit", F.col("n_tokens") > limit)
