"""Where a text comes from: ranges of raw sources behind units, records and evidence, and the hashes of these sources.

The lineage relation has a row per piece: keys, ``owner_id``, ``own_start`` and ``own_end`` (where the piece lies in the owner's text), ``source``,
``unit_id``, ``char_start`` and ``char_end`` (where it lies in the raw source). Positions count characters from 0, ends are exclusive.
Cutting a text into units, joining units and merging records each compose such maps, so every text made of raw text can be cut out of it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.operators.intervals import range_pairs
from evidence_spark.operators.scan import scan

#: One range of a record or of evidence; ``unit_id`` and the places are null where only the record is known.
RANGE = "struct<source:string,char_start:bigint,char_end:bigint,unit_id:string,range_precision:string>"
PLACES = ["owner_id", "own_start", "own_end", "source", "unit_id", "char_start", "char_end"]


def range_of(source: Column, start: Column, end: Column, unit_id: Column, precision: str = "exact") -> Column:
    return F.struct(source.cast("string").alias("source"), start.cast("long").alias("char_start"), end.cast("long").alias("char_end"),
                    unit_id.cast("string").alias("unit_id"), F.lit(precision).alias("range_precision"))


def no_ranges() -> Column:
    return F.array().cast(f"array<{RANGE}>")


def laid_out(rows: DataFrame, keys: Sequence[str], order: Sequence[str], owner: Column, source: Column, text: str = "text", gap: int = 1) -> DataFrame:
    """Lineage of rows whose texts, joined in order with ``gap`` characters between them, are the source of their keys. Null texts count as empty."""
    size = F.coalesce(F.length(text), F.lit(0))
    placed = scan(rows.withColumn("_size", size), keys, order, sums_before={"_before": F.col("_size") + gap})
    zero = F.lit(0).cast("long")
    start = F.coalesce("_before", zero)
    return placed.select(*keys, owner.cast("string").alias("owner_id"), zero.alias("own_start"), F.col("_size").cast("long").alias("own_end"), source.cast("string").alias("source"),
                         owner.cast("string").alias("unit_id"), start.cast("long").alias("char_start"), (start + F.col("_size")).cast("long").alias("char_end"))


def raw_sources(rows: DataFrame, keys: Sequence[str], order: Sequence[str], source: Column, text: str = "text", gap: str = "\n") -> DataFrame:
    """(keys, source, text) of the sources that ``laid_out`` describes: the texts of the rows, joined in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("_t")))), lambda r: r["_t"])
    return rows.withColumn("_source", source.cast("string")).groupBy(*keys, F.col("_source").alias("source")).agg(F.array_join(parts, gap).alias("text"))


def pieces(rows: DataFrame, owner_keys: Sequence[str], pattern: str, text: str = "text") -> DataFrame:
    """A row per trimmed, non-empty piece of each text, cut where ``pattern`` matches: ``piece_no`` (from 0, empty ones counted), ``piece``, ``start`` and ``end`` in the text."""
    cut_up = rows.withColumn("_parts", F.split(text, pattern)).withColumn("_gaps", F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)))
    each = cut_up.select(*[c for c in rows.columns], F.posexplode(F.arrays_zip("_parts", "_gaps")).alias("piece_no", "_p"))
    part = F.coalesce("_p._parts", F.lit(""))
    each = each.withColumn("_part", part).withColumn("_step", F.length(part) + F.coalesce(F.length("_p._gaps"), F.lit(0)))
    # the pieces of one row were cut in one task, so a window over that row is no larger
    before = F.sum("_step").over(Window.partitionBy(*owner_keys).orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("piece", F.regexp_replace("_part", r"(?U)^\s+|\s+$", ""))
    lead = F.length("_part") - F.length(F.regexp_replace("_part", r"(?U)^\s+", ""))
    start = (F.coalesce(before, F.lit(0)) + lead).cast("long")
    return each.withColumn("start", start).withColumn("end", F.col("start") + F.length("piece")).where(F.length("piece") > 0).drop("_p", "_part", "_step")


def compose(children: DataFrame, lineage: DataFrame, keys: Sequence[str], bucket: int = 4096) -> DataFrame:
    """Lineage of children (keys, child_id, owner_id, start, end in the owner's text) from that of their owners.

    Pairs meet by owner and by buckets of characters, so an owner of many pieces and children is many join keys.
    """
    inner = children.select(*keys, F.col("child_id").cast("string").alias("child_id"), F.col("owner_id").cast("string").alias("owner_id"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    met = range_pairs(inner, lineage, [*keys, "owner_id"], F.col("_s"), F.col("_e"), F.col("own_start"), F.col("own_end"), bucket,
                      (F.col("_s") < F.col("own_end")) & (F.col("own_start") < F.col("_e")))
    low, high = F.greatest("_s", "own_start"), F.least("_e", "own_end")
    return met.select(*keys, F.col("child_id").alias("owner_id"), (low - F.col("_s")).alias("own_start"), (high - F.col("_s")).alias("own_end"), "source", "unit_id",
                      (F.col("char_start") + low - F.col("own_start")).alias("char_start"), (F.col("char_end") - (F.col("own_end") - high)).alias("char_end"))


def merged(members: DataFrame, lineage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lineage of texts made of others: ``members`` (keys, parent_id, owner_id, at) tells at which character of the parent each one begins."""
    rows = members.select(*keys, F.col("parent_id").cast("string").alias("_parent"), F.col("owner_id").cast("string").alias("owner_id"), F.col("at").cast("long").alias("_at"))
    return rows.join(lineage, [*keys, "owner_id"]).select(
        *keys, F.col("_parent").alias("owner_id"), (F.col("own_start") + F.col("_at")).alias("own_start"), (F.col("own_end") + F.col("_at")).alias("own_end"), "source", "unit_id", "char_start", "char_end")


def cut_out(lineage: DataFrame, sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``lineage`` with ``cut``, the characters of the raw source at each range; null where the source is unknown or shorter."""
    inside = (F.col("char_start") >= 0) & (F.col("char_end") <= F.length("_raw"))
    whole = lineage.join(sources.select(*keys, "source", F.col("text").alias("_raw")), [*keys, "source"], "left")
    return whole.withColumn("cut", F.when(inside, F.substring("_raw", (F.col("char_start") + 1).cast("int"), (F.col("char_end") - F.col("char_start")).cast("int")))).drop("_raw")


def ranges_by_owner(lineage: DataFrame, keys: Sequence[str], precision: str = "exact") -> DataFrame:
    """(keys, owner_id, source_ranges): the ranges of each owner in the order of its text."""
    one = range_of(F.col("source"), F.col("char_start"), F.col("char_end"), F.col("unit_id"), precision)
    rows = F.array_sort(F.collect_list(F.struct("own_start", one.alias("range"))))
    return lineage.groupBy(*keys, "owner_id").agg(F.transform(rows, lambda r: r["range"]).alias("source_ranges"))


def source_hashes(sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, source_hashes): the SHA-256 of each source of a recording, by source."""
    entry = F.struct(F.col("source").alias("key"), F.sha2("text", 256).alias("value"))
    return sources.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("source_hashes"))


def with_lineage(rows: DataFrame, owner: str, lineage: DataFrame, sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with source_ranges and source_hashes; empty for rows and recordings without any."""
    ranges = ranges_by_owner(lineage, keys).withColumnRenamed("owner_id", "_owner")
    out = rows.withColumn("_owner", F.col(owner).cast("string")).join(ranges, [*keys, "_owner"], "left").join(source_hashes(sources, keys), list(keys), "left").drop("_owner")
    return out.withColumn("source_ranges", F.coalesce("source_ranges", no_ranges())).withColumn("source_hashes", F.coalesce("source_hashes", F.create_map().cast("map<string,string>")))


def traced(ids: Column, text: Column, ranges: Column, hashes: Column) -> Column:
    """Whether evidence has records, a text, ranges and source hashes behind it."""
    return F.coalesce((F.size(ids) > 0) & (text != "") & (F.size(ranges) > 0) & (F.size(F.map_keys(hashes)) > 0), F.lit(False))


def traceability(evidence: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of evidence and the share that is traced."""
    ok = traced(F.col("source_record_ids"), F.col("source_text"), F.col("source_ranges"), F.col("source_hashes"))
    return evidence.groupBy(*by).agg(F.count(F.lit(1)).alias("n_evidence"), F.round(F.avg(ok.cast("double")), 6).alias("traceability_rate"))
