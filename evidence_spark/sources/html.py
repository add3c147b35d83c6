"""Article pages to speaker turns with character ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.functions.text import norm_text, squeeze, strip
from evidence_spark.operators.scan import islands, scan
from evidence_spark.session import cut, small
from evidence_spark.sources.transcripts import MARK, unescape

# fixed values
BLOCK = r"(?is)<(h2|h3|p)\b([^>]*)>(.*?)</\1>"
TAG = r"(?s)<[^>]+>"
SPEAKER = r"(?s)^([^:]{1,60}):\s*(.*)$"


def html_blocks(pages: DataFrame, key: str = "source_id", html: str = "html", classes: dict[str, str] | None = None) -> DataFrame:
    """Heading and paragraph blocks with plain text and character range; tags go without leaving a space.

    ``classes`` can demand a word in a block's attributes, per tag.
    """
    parts = F.split(F.regexp_replace(html, BLOCK, MARK + "$0" + MARK), MARK)
    rows = pages.withColumn("_parts", parts)
    begin = F.aggregate("_parts", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    rows = rows.withColumn("_begin", begin).select(key, "_begin", F.posexplode("_parts").alias("block_no", "_b")).where("block_no % 2 = 1")
    tag = F.lower(F.regexp_extract("_b", BLOCK, 1))
    rows = rows.select(
        key, "block_no", tag.alias("tag"), F.regexp_extract("_b", BLOCK, 2).alias("attrs"),
        F.regexp_extract("_b", BLOCK, 3).alias("_body"), F.get("_begin", F.col("block_no")).alias("char_start"),
        (F.get("_begin", F.col("block_no")) + F.length("_b")).alias("char_end"))
    for name, word in (classes or {}).items():
        rows = rows.where((F.col("tag") != name) | F.contains("attrs", F.lit(word)))
    return rows.withColumn("text", squeeze(unescape(F.regexp_replace("_body", TAG, "")))).where("text <> ''").drop("_body", "attrs")


def turns_from_html(pages: DataFrame, aliases: DataFrame | None = None, key: str = "source_id", html: str = "html",
                    classes: dict[str, str] | None = None) -> DataFrame:
    """Speaker turns: headings reset section and speaker, a known ``Name:`` starts a turn, the speaker carries on.

    ``aliases`` has ``alias, speaker``; a name is looked up in lower case, letters and spaces only.
    """
    b = html_blocks(pages, key, html, classes)
    heading = F.col("tag").isin("h2", "h3")
    name = F.trim(F.regexp_replace(F.lower(F.regexp_extract("text", SPEAKER, 1)), "[^a-z ]", ""))
    b = b.withColumn("heading", heading).withColumn("_alias", F.when(~heading & (name != ""), name))
    if aliases is not None:
        # blocks without a name are most of all and match nothing: a salt deals them over the tasks
        salt = F.when(F.col("_alias").isNull(), F.xxhash64(key, "block_no")).otherwise(F.lit(0))
        known = small(cut(aliases.select(F.col("alias").alias("_alias"), F.col("speaker").alias("named"), F.lit(0).cast("long").alias("_salt"))))
        b = b.withColumn("_salt", salt).join(known, ["_alias", "_salt"], "left").drop("_salt")
    else:
        b = b.withColumn("named", F.lit(None).cast("string"))
    b = b.withColumn("body", F.when(F.col("named").isNotNull(), F.coalesce(
        F.nullif(strip(F.regexp_extract("text", SPEAKER, 2)), F.lit("")), F.col("text"))).otherwise(F.col("text")))
    b = cut(b)  # pages are parsed once, not for every running value below
    keys, order = [key], ["block_no"]
    speaker = F.when(F.col("heading"), F.struct(F.lit(None).cast("string").alias("s"))).when(F.col("named").isNotNull(), F.struct(F.col("named").alias("s")))
    title = F.when(F.col("heading"), F.col("text"))
    b = scan(b, keys, order, carry={"_sp": speaker, "section_title": title}, lags={"_after": F.struct("heading")})
    first = F.col("_after").isNull() | F.col("_after.heading") | F.col("named").isNotNull()
    b = islands(b.where(~F.col("heading")).withColumn("_new", first), keys, order, F.col("_new"), "section_order")
    turns = b.groupBy(key, "section_order").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "body"))), lambda r: r["body"]), "\n\n").alias("text"),
        F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.min_by("_sp", "block_no")["s"].alias("_who"),
        F.min_by(F.struct("section_title"), "block_no")["section_title"].alias("section_title"))
    return turns.select(
        key, "section_order", F.coalesce("section_title", F.lit("Introduction")).alias("section_title"),
        F.coalesce("_who", F.lit("unknown")).alias("speaker"),
        F.when(F.col("_who").isNull(), "unknown").otherwise("source_provided").alias("speaker_status"), "text", "char_start", "char_end",
        F.sha2(norm_text("text"), 256).alias("content_hash"))
