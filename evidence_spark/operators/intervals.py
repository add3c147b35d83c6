"""Interval joins by time buckets, coverage, chapter assignment and candidate spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.functions.similarity import best_spans
from evidence_spark.operators.scan import scan
from evidence_spark.session import byte_batches, cut, spread


def range_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], l_lo: Column, l_hi: Column, r_lo: Column, r_hi: Column,
                bucket: float = 60.0, extra: Column | None = None) -> DataFrame:
    """All (left, right) rows of equal keys whose closed ranges touch, by an equi-join on buckets.

    Each side is listed once per bucket it touches; a pair is kept only in the later of the two first buckets, so
    no distinct is needed. Column names of the two sides must differ apart from ``keys``. A key is spread over
    its buckets, so a long recording is many join keys.
    """
    def listed(df, lo, hi, tag):
        first = F.floor(lo / bucket)
        return df.withColumn(f"_{tag}lo", lo).withColumn(f"_{tag}hi", hi).withColumn(f"_{tag}first", first).withColumn(
            "_cell", F.explode(F.sequence(first, F.greatest(first, F.floor(hi / bucket)))))

    a, b = listed(left, l_lo, l_hi, "l"), listed(right, r_lo, r_hi, "r")
    hit = (F.col("_llo") <= F.col("_rhi")) & (F.col("_rlo") <= F.col("_lhi")) & (F.col("_cell") == F.greatest("_lfirst", "_rfirst"))
    out = a.join(b, [*keys, "_cell"]).where(hit if extra is None else hit & extra)
    return out.drop("_cell", "_llo", "_lhi", "_lfirst", "_rlo", "_rhi", "_rfirst")


def interval_join(left: DataFrame, right: DataFrame, tol: float = 3.0, keys: Sequence[str] = ("media_id",), left_id: str = "seq",
                  bucket: float = 60.0) -> DataFrame:
    """Right intervals that overlap the left one; only if there are none, those within ``tol`` seconds.

    ``left`` has ``start_s, end_s``; ``right`` has ``r_start_s, r_end_s``.
    """
    near = range_pairs(left, right, keys, F.col("start_s") - tol, F.col("end_s") + tol, F.col("r_start_s"), F.col("r_end_s"), bucket)
    near = near.withColumn("strict", (F.col("r_end_s") > F.col("start_s")) & (F.col("r_start_s") < F.col("end_s")))
    certain = near.where("strict").select(*keys, left_id).distinct()
    loose = near.where(~F.col("strict")).join(certain, [*keys, left_id], "left_anti")
    return near.where("strict").unionByName(loose)


def overlap_coverage(pairs: DataFrame, keys: Sequence[str] = ("media_id", "seq"), right_id: str = "r_seq", bucket: float = 3600.0) -> DataFrame:
    """Share of each left interval covered by the union of its partners.

    Walking the partners by start, each one adds only what lies beyond the latest end so far. A left interval of
    zero length counts as covered when a partner starts at the same instant.
    """
    lo, hi = F.greatest("start_s", "r_start_s"), F.least("end_s", "r_end_s")
    rows = pairs.select(*keys, right_id, "start_s", "end_s", "r_start_s", lo.alias("_lo"), hi.alias("_hi"))
    real = F.col("_hi") > F.col("_lo")
    rows = scan(rows, keys, ["_lo", "_hi", right_id], maxes={"_seen": F.when(real, F.col("_hi"))}, block=F.floor(F.col("_lo") / bucket))
    gain = F.when(real, F.greatest(F.lit(0.0), F.col("_hi") - F.greatest("_lo", F.coalesce("_seen", "_lo")))).otherwise(0.0)
    total = rows.groupBy(*keys).agg(
        F.sum(gain).alias("_covered"), F.max(F.col("end_s") - F.col("start_s")).alias("_span"),
        F.max((F.col("r_start_s") == F.col("start_s")).cast("double")).alias("_same"))
    share = F.when(F.col("_span") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_covered") / F.col("_span")))).otherwise(F.col("_same"))
    return total.select(*keys, share.alias("coverage"))


def assign_interval(rows: DataFrame, chapters: DataFrame, keys: Sequence[str] = ("media_id",), row_id: str = "seq",
                    bucket: float = 300.0) -> DataFrame:
    """The chapter with the largest overlap (first one on a tie); ``chapters`` has ``chapter_no, c_start_s, c_end_s``."""
    extra = [c for c in chapters.columns if c not in keys]
    pairs = range_pairs(rows.select(*keys, row_id, "start_s", "end_s"), chapters, keys, F.col("start_s"), F.col("end_s"),
                        F.col("c_start_s"), F.col("c_end_s"), bucket, (F.col("c_end_s") > F.col("start_s")) & (F.col("c_start_s") < F.col("end_s")))
    overlap = F.least("end_s", "c_end_s") - F.greatest("start_s", "c_start_s")
    best = pairs.groupBy(*keys, row_id).agg(F.max_by(F.struct(*extra), F.struct(overlap, -F.col("chapter_no"))).alias("_c"))
    return rows.join(best, [*keys, row_id], "left").select(*rows.columns, *[F.col("_c." + c).alias(c) for c in extra])


def infer_speaker(rows: DataFrame, chapters: DataFrame, keys: Sequence[str] = ("media_id",), row_id: str = "seq", edge_s: float = 8.0) -> DataFrame:
    """Chapter speaker with a status: inferred, uncertain near a chapter edge in short talk, or unknown.

    ``chapters`` also has ``c_speaker``.
    """
    c = assign_interval(rows.drop("speaker"), chapters, keys, row_id)
    near = (F.abs(F.col("start_s") - F.col("c_start_s")) <= edge_s) | (F.abs(F.col("end_s") - F.col("c_end_s")) <= edge_s)
    short = (F.size(X.matches("text", R.LONG_WORD)) < 12) | X.has("text", R.TRANSITION)
    known = F.col("c_speaker").isNotNull() & (F.col("c_speaker") != "")
    status = F.when(~known | F.col("c_speaker").isNull(), "unknown").when(near & short, "boundary_uncertain").otherwise("section_inferred")
    out = c.withColumn("speaker_status", status)
    return out.withColumn("speaker", F.when(known, F.col("c_speaker"))).withColumn(
        "speaker_confidence", F.when(F.col("speaker_status") == "unknown", 0.0).when(F.col("speaker_status") == "boundary_uncertain", 0.45).otherwise(0.82)
    ).withColumn("attribution_scope", F.when(known, "section").otherwise("unknown")).withColumn("exact_quote_allowed", F.lit(False))


def time_prior(s: Column, e: Column, a: Column, b: Column) -> Column:
    """Overlap share and closeness of middles of a structure interval (s, e) and a span (a, b)."""
    overlap = F.greatest(F.lit(0.0), F.least(e, b) - F.greatest(s, a))
    span = F.greatest(F.lit(1.0), e - s)
    close = F.greatest(F.lit(0.0), 1.0 - F.abs((s + e) / 2 - (a + b) / 2) / F.greatest(F.lit(30.0), span * 2))
    return F.round(0.55 * F.least(F.lit(1.0), overlap / span) + 0.45 * close, 6)


def unit_runs(units: DataFrame, max_units: int = 6, keys: Sequence[str] = ("media_id",)) -> DataFrame:
    """For each unit, the ordered array of itself and the units after it, at most ``max_units``."""
    body = F.struct("unit_idx", "unit_start_s", "unit_end_s", F.trim("unit_text").alias("t"), *[c for c in (
        "char_start", "char_end", "boundary_start", "boundary_end", "seg_seq") if c in units.columns])
    member = units.select(*keys, body.alias("u"), F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("unit_idx") - (max_units - 1)), F.col("unit_idx"))).alias("run_start"))
    runs = member.groupBy(*keys, "run_start").agg(F.array_sort(F.collect_list("u")).alias("run"))
    return runs.where(F.element_at("run", 1)["unit_idx"] == F.col("run_start"))


def candidate_spans(structs: DataFrame, units: DataFrame, pad: float = 30.0, max_units: int = 6, k: int = 12,
                    keys: Sequence[str] = ("media_id",), bucket: float = 60.0) -> DataFrame:
    """Best ``k`` runs of 1..``max_units`` units starting in the padded band of each structure segment.

    ``structs`` has ``seq, start_s, end_s, text``; ranking is 0.65 lexical + 0.35 time prior, ties by start and end.
    Bounds of the lexical score drop spans that cannot reach the ``k`` best before blocks are matched.
    """
    byte_batches(structs.sparkSession)
    runs = unit_runs(units, max_units, keys).withColumn("u_start_s", F.element_at("run", 1)["unit_start_s"]).withColumn(
        "u_end_s", F.element_at("run", 1)["unit_end_s"])
    # a segment and the runs near it meet as one row, so texts of spans are made, bounded and scored inside the row and never shuffled
    structs = cut(structs.withColumn("_s", F.monotonically_increasing_id()))
    near = range_pairs(structs.select(*keys, "seq", "_s", "start_s", "end_s"), runs, keys, F.col("start_s") - pad, F.col("end_s") + pad, F.col("u_start_s"), F.col("u_end_s"), bucket)
    own = F.struct(*[c for c in structs.columns if c not in (*keys, "seq", "_s")])
    none = F.lit(None).cast(runs.schema["run"].dataType)
    both = near.select(*keys, "seq", "_s", F.lit(None).cast(structs.select(own.alias("o")).schema["o"].dataType).alias("_own"), "run_start", "run").unionByName(
        structs.select(*keys, "seq", "_s", own.alias("_own"), F.lit(None).cast(runs.schema["run_start"].dataType).alias("run_start"), none.alias("run")))
    rows = spread(both, *keys, "seq").groupBy(*keys, "seq", "_s").agg(
        F.first("_own", ignorenulls=True).alias("_own"), F.collect_list(F.when(F.col("run").isNotNull(), F.struct("run_start", "run"))).alias("_runs"))
    rows = rows.where(F.size("_runs") > 0).select(*keys, "seq", "_own.*", "_runs")

    def span(r, n):
        sel = F.slice(r["run"], F.lit(1), n)
        return F.struct(r["run_start"].alias("run_start"), n.alias("n_units"), sel.alias("sel"), F.trim(F.array_join(F.filter(F.transform(sel, lambda u: u["t"]), lambda t: t != ""), " ")).alias("span_text"),
                        F.element_at(sel, 1)["unit_start_s"].alias("span_start_s"), F.element_at(sel, -1)["unit_end_s"].alias("span_end_s"))

    spans = F.flatten(F.transform("_runs", lambda r: F.transform(F.sequence(F.lit(1), F.size(r["run"])), lambda n: span(r, n))))
    reach = lambda x: F.array_max(F.transform(x["sel"], lambda u: u["unit_start_s"]))
    rows = rows.withColumn("_spans", F.filter(spans, lambda x: ((x["n_units"] == 1) | (reach(x) <= F.col("end_s") + pad)) & (x["span_text"] != ""))).drop("_runs")
    prior = lambda x: time_prior(F.col("start_s"), F.col("end_s"), x["span_start_s"], x["span_end_s"])
    rows = rows.withColumn("_best", best_spans(X.norm_text("text"), F.transform("_spans", lambda x: X.norm_text(x["span_text"])), F.transform("_spans", prior),
                                               F.transform("_spans", lambda x: x["run_start"]), F.transform("_spans", lambda x: x["n_units"]), k))
    rows = rows.withColumn("_b", F.explode(F.transform("_best", lambda b: F.struct(F.get("_spans", b["at"]).alias("span"), b["lexical"].alias("lexical"))))).drop("_spans", "_best")
    rows = rows.select("*", "_b.span.*", "_b.lexical").drop("_b").withColumn("time_prior", time_prior(F.col("start_s"), F.col("end_s"), F.col("span_start_s"), F.col("span_end_s")))
    rows = rows.withColumn("prelim", 0.65 * F.col("lexical") + 0.35 * F.col("time_prior"))
    # segments that share a number share the k places; a row above gave at most k
    w = Window.partitionBy(*keys, "seq").orderBy(F.col("prelim").desc(), "run_start", "n_units")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("unit_end", F.col("run_start") + F.col("n_units"))


def units_in_ranges(ranges: DataFrame, units: DataFrame, keys: Sequence[str] = ("media_id",), bucket: float = 2000.0) -> DataFrame:
    """Units whose characters overlap the labelled range; half-open ranges ``char_start, char_end`` / ``u_start, u_end``."""
    return range_pairs(ranges, units, keys, F.col("char_start"), F.col("char_end"), F.col("u_start"), F.col("u_end"), bucket,
                       (F.col("u_end") > F.col("char_start")) & (F.col("u_start") < F.col("char_end")))
