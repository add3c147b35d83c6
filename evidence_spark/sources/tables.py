"""Record tables, re-runnable sinks, source choice, incremental ingest and file snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: source priority, best first
PRIORITY = ["official_transcript", "ulisten", "usetranscribe", "manual_markdown", "youtube_export"]
# fixed values: limitations named by the combination of sources
NOTE_OFFICIAL = "official text preferred over the secondary text"
NOTE_SINGLE = "official text used as the only source"
NOTE_NO_SPEAKER = "no speaker attribution until reviewed"
NOTE_RAW = "raw structure text kept without alignment confidence"
NOTE_NONE = "all sources missing"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _file, _line) of every line of text files, lines counted from 1 and blank ones included.

    Files are read in splits. The lines of a split are consecutive ids of one task, so a line's place in its split is its id less the split's
    first; what comes before the split is a running sum over the line counts of the file's splits, a row each.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("_file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("_file", "_split", (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_offset"))
    return lines.join(offsets, ["_file", "_split"]).select("value", "_file", (F.col("_id") + F.col("_offset")).alias("_line"))


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "fail") -> DataFrame:
    """JSON lines with an explicit schema; blank lines are skipped.

    ``fail`` stops at a malformed row or a row that is no object, with an error that names its file and line. ``report`` keeps going and
    returns rows with ``_corrupt`` (the line, null where it is good), ``_file`` and ``_line``.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields.fields, T.StructField("_corrupt", T.StringType())])
    rows = numbered_lines(spark, path).where(F.length(F.trim(F.translate("value", "\t\r", "  "))) > 0)
    rows = rows.withColumn("_row", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull() | ~F.ltrim("value").startswith("{")
    columns = [F.when(~bad, F.col("_row")[f.name]).alias(f.name) for f in fields.fields]
    if mode == "fail":
        where = F.concat(F.lit("malformed row in "), F.col("_file"), F.lit(" line "), F.col("_line").cast("string"))
        return rows.where(F.when(bad, F.raise_error(where).cast("boolean")).otherwise(F.lit(True))).select(*columns)
    return rows.select(*columns, F.when(bad, F.col("value")).alias("_corrupt"), "_file", "_line")


def write_records(df: DataFrame, path: str, order_by: Sequence[str], fmt: str = "parquet", partitions: int | None = None) -> None:
    """Overwrite ``path`` with rows range-partitioned and sorted by ``order_by``: the same input gives the same rows."""
    ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    ranged.sortWithinPartitions(*order_by).write.mode("overwrite").format(fmt).save(path)


def select_source(checks: DataFrame, priority: Sequence[str] = tuple(PRIORITY), key: str = "media_id") -> DataFrame:
    """Best ready source per media; else a source known only by URL; else unresolved.

    ``checks`` has ``media_id, provider, status``. A failed better source never blocks a ready one.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("provider"))
    ready = F.when((F.col("status") == "ready") & (rank > 0), F.struct(rank, "provider"))
    linked = F.when((F.col("status") == "url_only") & (rank > 0), F.struct(rank, "provider"))
    best = checks.groupBy(key).agg(F.min(ready).alias("_r"), F.min(linked).alias("_u"))
    return best.select(
        key, F.col("_r.provider").alias("provider"),
        F.when(F.col("_r").isNotNull(), "selected").when(F.col("_u").isNotNull(), "url_only").otherwise("unresolved").alias("resolution"),
        F.when(F.col("_r").isNull(), F.col("_u.provider")).alias("url_provider"))


def resolve_mode(sources: DataFrame, key: str = "media_id") -> DataFrame:
    """Which combination of structure, text and official source a media has, and what that means.

    ``sources`` has ``media_id, role`` with roles ``structure``, ``text`` and ``official``.
    """
    has = sources.groupBy(key).agg(*[F.coalesce(F.bool_or(F.col("role") == r), F.lit(False)).alias("_" + r) for r in ("structure", "text", "official")])
    s, t, o = F.col("_structure"), F.col("_text"), F.col("_official")
    mode = (F.when(s & o, "official_dual").when(s & t, "dual_source").when(o, "official_single").when(t, "text_single")
            .when(s, "structure_degraded").otherwise("failed"))
    out = has.withColumn("mode", mode)
    unused = F.array_compact(F.array(F.when(o & t, F.lit("text"))))
    notes = F.array_compact(F.array(
        F.when((F.col("mode") == "official_dual") & t, F.lit(NOTE_OFFICIAL)), F.when((F.col("mode") == "official_single") & t, F.lit(NOTE_SINGLE)),
        F.when(F.col("mode") == "text_single", F.lit(NOTE_NO_SPEAKER)), F.when(F.col("mode") == "structure_degraded", F.lit(NOTE_RAW)),
        F.when(F.col("mode") == "failed", F.lit(NOTE_NONE))))
    structure_source = F.when(s, "structure").when(o, "official").when(t, "text_timeline")
    text_source = F.when(o, "official").when(t, "text").when(s, "structure")
    return out.select(key, "mode", structure_source.alias("structure_source"), text_source.alias("text_source"), unused.alias("unused"), notes.alias("limitations"))


def ingest_increment(new: DataFrame, known: DataFrame, force: bool = False, key: str = "source_id", content: str = "content_hash") -> tuple[DataFrame, DataFrame]:
    """(rows still to process, conflicts): known rows are skipped, a changed hash under a known id is a conflict.

    With ``force`` the changed rows are processed again and there is no conflict.
    """
    held = known.select(key, F.col(content).alias("_held")).distinct()
    exact = known.select(key, content).distinct()
    fresh = new.join(exact, [key, content], "left_anti")
    changed = fresh.join(held, key, "left_semi")
    if force:
        return fresh, changed.limit(0)
    return fresh.join(held, key, "left_anti"), changed


def cursor(rows: DataFrame, at: str, key: str = "source_id") -> DataFrame:
    """Newest and oldest processed item."""
    return rows.agg(F.max_by(key, F.struct(at, key)).alias("newest"), F.min_by(key, F.struct(at, key)).alias("oldest"), F.count("*").alias("n_processed"))


def snapshot(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and SHA-256 of every file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "length")


def diff_snapshot(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """Files that changed, went missing or appeared since the frozen manifest."""
    a = frozen.select("path", F.col("sha256").alias("_a"))
    b = current.select("path", F.col("sha256").alias("_b"))
    both = a.join(b, "path", "full_outer")
    drift = F.when(F.col("_a").isNull(), "extra").when(F.col("_b").isNull(), "missing").when(F.col("_a") != F.col("_b"), "changed")
    return both.withColumn("drift", drift).where("drift is not null").select("path", "drift")
