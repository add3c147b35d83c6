"""Benchmark decontamination: a broadcast set of normalised benchmark word windows probed by every window of the training texts.

DataFrame functions only. Words are runs of digits, letters a-z (A-Z lower-cased) and characters above U+007F. A window is ``n`` consecutive
words of a benchmark item; a shorter item is one window. Window hashes of a text are built by doubling (1, 2, 4, 8 words), so a position
costs a few hash calls, not ``n``. Every hash hit is verified against the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence_spark.llm.urls import ascii_lower

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows of the benchmark that are broadcast; beyond that they are joined by shuffle. 13 short words and their item ids take about 200 bytes.
BROADCAST_WINDOWS = 500_000


def words_of(text: Column) -> Column:
    """The words of a text; null and texts without words give an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def _powers(most: int) -> list[int]:
    out = [1]
    while out[-1] * 2 <= most:
        out.append(out[-1] * 2)
    return out


def _pieces(m: int) -> list[tuple[int, int]]:
    """Window length ``m`` as (offset, power of two), the largest first."""
    out, done = [], 0
    for p in reversed(_powers(m)):
        if m - done >= p:
            out.append((done, p))
            done += p
    return out


def _zipped(a: Column, b: Column, shift: int) -> Column:
    """Element i of ``a`` hashed with element i + shift of ``b``; past the end of ``b`` the value means nothing."""
    return F.zip_with(a, F.slice(b, shift + 1, F.size(b)), lambda x, y: F.xxhash64(x, y))


def window_hashes(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """Add ``_h<m>`` for each length m: the hash of every window of m consecutive words, in order of position.

    A window of m words is put together from windows whose lengths are powers of two, the largest first. All arrays have one element
    per word; those that would reach past the last word are cut off at the end.
    """
    out = df.withColumn("_p1", F.transform(words, lambda w: F.xxhash64(w)))
    for p in _powers(max(lengths))[1:]:
        out = out.withColumn(f"_p{p}", _zipped(F.col(f"_p{p // 2}"), F.col(f"_p{p // 2}"), p // 2))
    for m in lengths:
        (_, first), *rest = _pieces(m)
        done = F.col(f"_p{first}")
        for shift, p in rest:
            done = _zipped(done, F.col(f"_p{p}"), shift)
        out = out.withColumn(f"_h{m}", F.slice(done, 1, F.greatest(F.size(words) - (m - 1), F.lit(0))))
    return out.drop(*[f"_p{p}" for p in _powers(max(lengths))])


def window_hash(words: Column, m: int, start: int = 1) -> Column:
    """The hash that ``window_hashes`` gives the window of m words at ``start``, as one scalar expression."""
    def power(p: int, at: int) -> Column:
        return F.xxhash64(F.get(words, F.lit(at - 1))) if p == 1 else F.xxhash64(power(p // 2, at), power(p // 2, at + p // 2))

    (_, first), *rest = _pieces(m)
    done = power(first, start)
    for shift, p in rest:
        done = F.xxhash64(done, power(p, start + shift))
    return done


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Distinct windows: _gram (words), _len, _hash, _items (the ids of the items that hold it, as sorted strings). Items without words have none."""
    w = benchmark.select(F.col("item_id").cast("string").alias("_item"), words_of(F.col("text")).alias("_w")).where(F.size("_w") > 0)
    size = F.least(F.size("_w"), F.lit(n))
    grams = w.select("_item", F.explode(F.transform(F.sequence(F.lit(1), F.size("_w") - size + 1), lambda i: F.slice("_w", i, size))).alias("_gram"))
    return grams.groupBy("_gram").agg(F.array_sort(F.collect_set("_item")).alias("_items")).withColumn("_len", F.size("_gram"))


def _hashed_windows(windows: DataFrame, lengths: list[int]) -> DataFrame:
    pick = F.coalesce(*[F.when(F.col("_len") == m, window_hash(F.col("_gram"), m)) for m in lengths])
    return windows.select("_gram", "_len", "_items", pick.alias("_ghash"))


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13, keep: list[str] = ()) -> DataFrame:
    """One row per (doc_id, text): n_words, _copies (rows with that id and text), _hits (sorted positions and lengths of occurring windows), items.

    The documents are read once. Each text gives a marker row and a row per window; rows that are neither markers nor hits go at once.
    Null texts and texts without words have a marker only. Only the columns named here are read, so other columns of ``docs`` cannot clash.
    """
    grams = benchmark_windows(benchmark, n)
    found = grams.groupBy("_len").count().collect()  # at most n rows
    lengths, total = sorted(r["_len"] for r in found), sum(r["count"] for r in found)
    base = docs.select("doc_id", F.xxhash64("text").alias("_text_key"), words_of(F.col("text")).alias("_words"))
    if not lengths:
        lengths = [n]
    hashed = window_hashes(base, "_words", lengths)
    empty = F.array(F.lit(None).cast("long"))
    if len(lengths) == 1:
        rows = hashed.select("doc_id", "_text_key", "_words", F.lit(lengths[0]).alias("_m"), F.posexplode(F.concat(empty, F.col(f"_h{lengths[0]}"))).alias("_pos", "_hash"))
        marker = F.col("_pos") == 0
    else:
        sets = F.array(*[F.struct(F.lit(m).alias("m"), F.concat(empty, F.col(f"_h{m}")).alias("h")) for m in lengths])
        rows = hashed.select("doc_id", "_text_key", "_words", F.explode(sets).alias("_set")).select(
            "doc_id", "_text_key", "_words", F.col("_set.m").alias("_m"), F.posexplode("_set.h").alias("_pos", "_hash"))
        marker = (F.col("_pos") == 0) & (F.col("_m") == max(lengths))
    right = _hashed_windows(grams, lengths)
    same = (F.col("_hash") == F.col("_ghash")) & (F.col("_m") == F.col("_len"))
    if total <= BROADCAST_WINDOWS:
        right = F.broadcast(right)
        probed = rows.join(right, same, "left")
        verified = probed.withColumn("_hit", F.col("_gram").isNotNull() & (F.slice("_words", F.greatest(F.col("_pos"), F.lit(1)), F.col("_m")) == F.col("_gram")))
        kept = verified.where(marker | F.col("_hit")).select(
            "doc_id", "_text_key", F.when(marker, F.size("_words")).alias("_n"), F.when(F.col("_hit"), F.struct("_pos", "_m")).alias("_at"), F.when(F.col("_hit"), F.col("_items")).alias("_it"))
    else:
        # too many windows to broadcast: positions travel without their text, and only texts with hash hits are cut into words again
        slim = rows.where(~marker).select("doc_id", "_text_key", "_m", "_pos", "_hash")
        hits = slim.join(right, same).select(F.col("doc_id").alias("_d"), F.col("_text_key").alias("_k"), "_m", "_pos", "_gram", "_items").distinct()
        marked = base.groupBy("doc_id", "_text_key").agg(F.first("_words").alias("_words"), F.count(F.lit(1)).alias("_c"))
        joined = marked.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text_key") == F.col("_k")), "left")
        checked = joined.withColumn("_hit", F.col("_gram").isNotNull() & (F.slice("_words", F.greatest(F.col("_pos"), F.lit(1)), F.coalesce("_m", F.lit(1))) == F.col("_gram")))
        return checked.groupBy("doc_id", "_text_key").agg(
            F.max(F.size("_words")).cast("long").alias("n_words"), F.max("_c").alias("_copies"),
            F.array_sort(F.collect_set(F.when(F.col("_hit"), F.struct("_pos", "_m")))).alias("_hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("_hit"), F.col("_items")))))).alias("items"))
    return kept.groupBy("doc_id", "_text_key").agg(
        F.max("_n").cast("long").alias("n_words"), F.count("_n").alias("_copies"),
        F.array_sort(F.collect_set("_at")).alias("_hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_it")))).alias("items"))


def covered_words(hits: Column) -> Column:
    """How many words the sorted (position, length) windows cover together."""
    start = F.struct(F.lit(1).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(s, x):
        end = (x["_pos"] + x["_m"]).cast("long")
        return F.struct(F.greatest(s["end"], end).alias("end"), (s["n"] + F.greatest(end - F.greatest(s["end"], x["_pos"].cast("long")), F.lit(0).cast("long"))).alias("n"))

    return F.aggregate(hits, start, step, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated (a word in ``share`` or more lies in a benchmark window).

    Null and empty texts have no words and are never contaminated; repeated rows are judged alike and all returned. An empty benchmark
    hits nothing, an empty ``docs`` gives no rows.
    """
    spans = contaminated_spans(docs, benchmark, n).withColumn("n_hit", covered_words(F.col("_hits")))
    out = spans.select(
        "doc_id", "_text_key", "_copies", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"), "_hits")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copy", "_copies")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without contaminated documents, with its own columns. Rows with null ids are kept or dropped by their text like all others."""
    bad = contamination(docs, benchmark, n, share).where("contaminated").select(F.col("doc_id").alias("_bad"), F.col("_text_key").alias("_bad_key")).distinct()
    keyed = docs.withColumn("_own_key", F.xxhash64("text"))
    return keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad")) & (F.col("_own_key") == F.col("_bad_key")), "left_anti").select(*[docs[c] for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Per document the words that lie in no benchmark window, joined by spaces, as clean_text: for keeping the rest of a long text."""
    spans = contaminated_spans(docs, benchmark, n).select(F.col("doc_id").alias("_d"), F.col("_text_key").alias("_k"), "_hits")
    base = docs.select("doc_id", F.xxhash64("text").alias("_text_key"), words_of(F.col("text")).alias("_words"))
    joined = base.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text_key") == F.col("_k")))
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("out"))

    def step(s, x):
        gap = F.greatest(x["_pos"] - s["next"], F.lit(0))
        return F.struct(F.greatest(s["next"], x["_pos"] + x["_m"]).alias("next"), F.concat(s["out"], F.slice("_words", s["next"], gap)).alias("out"))

    tail = F.aggregate("_hits", start, step, lambda s: F.concat(s["out"], F.slice("_words", s["next"], F.greatest(F.size("_words") - s["next"] + 1, F.lit(0)))))
    return joined.select("doc_id", F.array_join(tail, " ").alias("clean_text"))
