"""Queries for source ranges and hashes, and for bad lines of record files."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R
from evidence_spark.functions import text as X
from evidence_spark.operators import claims as C
from evidence_spark.operators import lineage as L
from evidence_spark.plans import duck as D
from evidence_spark.plans.extract import REC_SQL, records
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import joined, table
from evidence_spark.session import checkpoint_folder
from evidence_spark.sources.tables import numbered_lines, read_records

KEYS = ["media_id"]


def transcript(spark, sf):
    """Records, where each lies in its recording's whole transcript (turns joined by a line break), and these transcripts."""
    rows = records(spark, sf).drop("source_ranges", "source_hashes")
    name = F.lit("transcript")
    return rows, L.laid_out(rows, KEYS, ["seq"], F.col("record_id"), name), L.raw_sources(rows, KEYS, ["seq"], name)


PLACED_SQL = f"""{REC_SQL}, placed AS (SELECT *, (sum(length(text) + 1) OVER (PARTITION BY media_id ORDER BY seq) - length(text) - 1)::BIGINT AS char_start FROM rec),
raw AS (SELECT media_id, string_agg(text, chr(10) ORDER BY seq) AS raw FROM rec GROUP BY media_id)"""


@query("p1_source_ranges", f"""WITH {PLACED_SQL} SELECT record_id, 'transcript' AS source, char_start, char_start + length(text) AS char_end, md5(text) AS cut_md5, sha256(raw) AS source_sha256 FROM placed JOIN raw USING (media_id)""")
def _(spark, sf):
    rows, lineage, sources = transcript(spark, sf)
    known = L.with_lineage(rows, "record_id", lineage, sources, KEYS)
    each = known.select("media_id", "record_id", "source_hashes", F.explode("source_ranges").alias("r")).select("media_id", "record_id", "source_hashes", "r.*")
    cut = L.cut_out(each, sources, KEYS)
    return cut.select("record_id", "source", "char_start", "char_end", F.md5("cut").alias("cut_md5"), F.element_at("source_hashes", F.col("source")).alias("source_sha256"))


@query("w7_sentence_ranges", f"""WITH {PLACED_SQL}, parts AS (SELECT record_id, char_start, string_split(regexp_replace(text, '([.!?])({D.WS}+)', '\\1\\2' || chr(1), 'g'), chr(1)) AS ps FROM placed),
each AS (SELECT record_id, char_start, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS no FROM parts),
spot AS (SELECT *, char_start + sum(length(p)) OVER (PARTITION BY record_id ORDER BY no) - length(regexp_replace(p, '^{D.WS}+', '')) AS start, {D.strip('p')} AS piece FROM each)
SELECT record_id || '.' || no AS sentence_id, start::BIGINT AS char_start, (start + length(piece))::BIGINT AS char_end, md5(piece) AS cut_md5 FROM spot WHERE length(piece) > 0""")
def _(spark, sf):
    rows, lineage, sources = transcript(spark, sf)
    cut_up = L.pieces(rows.select("media_id", "record_id", "text"), ["media_id", "record_id"], R.SENTENCE_BREAK)
    children = cut_up.select("media_id", F.concat_ws(".", "record_id", "piece_no").alias("child_id"), F.col("record_id").alias("owner_id"), "start", "end")
    cut = L.cut_out(L.compose(children, lineage, KEYS), sources, KEYS)
    return cut.select(F.col("owner_id").alias("sentence_id"), "char_start", "char_end", F.md5("cut").alias("cut_md5"))


def bundled(spark, sf, sources_of=None):
    """Evidence over three turns each, last turn first, with ranges and hashes."""
    rows, lineage, sources = transcript(spark, sf)
    known = L.with_lineage(rows, "record_id", lineage, sources if sources_of is None else sources_of(rows, sources), KEYS)
    order = F.transform(F.sort_array(F.collect_list(F.struct("seq", "record_id")), asc=False), lambda x: x["record_id"])
    seeds = rows.groupBy("media_id", F.floor(F.col("seq") / 3).alias("seed_id")).agg(order.alias("record_ids"))
    return C.bundle_evidence(seeds, known), sources


_SEEDS = f"seed AS (SELECT media_id, seq // 3 AS seed, string_agg(nullif({D.strip('text')}, ''), ' ' ORDER BY seq DESC) AS source_text, string_agg(char_start || '-' || (char_start + length(text)), '|' ORDER BY seq DESC) AS ranges, bool_or(speaker = 'system') AS hidden, bool_and(speaker_status = 'source_provided') AS given FROM placed GROUP BY 1, 2)"


@query("g4_evidence_ranges", f"WITH {PLACED_SQL}, {_SEEDS} SELECT media_id, seed, ranges, md5(source_text) AS cut_md5, md5(source_text) AS text_md5, sha256(raw) AS source_sha256 FROM seed JOIN raw USING (media_id) WHERE source_text <> ''")
def _(spark, sf):
    evidence, sources = bundled(spark, sf)
    each = evidence.select("media_id", "seed_id", "source_text", "source_hashes", F.posexplode("source_ranges").alias("own_start", "r")).select("media_id", "seed_id", "source_text", "source_hashes", "own_start", "r.*")
    cut = L.cut_out(each, sources, KEYS).groupBy("media_id", "seed_id").agg(
        F.array_sort(F.collect_list(F.struct("own_start", "char_start", "char_end", X.strip("cut").alias("t")))).alias("_c"), F.first("source_text").alias("source_text"), F.first("source_hashes").alias("h"))
    text = F.array_join(F.filter(F.transform("_c", lambda r: r["t"]), lambda t: t != ""), " ")
    places = F.transform("_c", lambda r: F.concat_ws("-", r["char_start"].cast("string"), r["char_end"].cast("string")))
    return cut.select("media_id", F.col("seed_id").alias("seed"), joined(places).alias("ranges"), F.md5(text).alias("cut_md5"), F.md5("source_text").alias("text_md5"), F.element_at("h", "transcript").alias("source_sha256"))


@query("g14_traceability", f"""WITH {PLACED_SQL}, {_SEEDS}, odd AS (SELECT media_id, bool_or(speaker = 'system') AS lost FROM rec GROUP BY 1)
SELECT CASE WHEN given THEN 'source_provided' ELSE 'section_inferred' END AS speaker_status, count(*) AS n_evidence, round(avg(CASE WHEN lost THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS traceability_rate FROM seed JOIN odd USING (media_id) WHERE source_text <> '' GROUP BY 1""")
def _(spark, sf):
    """Recordings with a system turn have no hashed source, so their evidence does not count as traced."""
    def hashed(rows, sources):
        return sources.join(rows.where("speaker = 'system'").select("media_id").distinct(), "media_id", "left_anti")

    return L.traceability(bundled(spark, sf, hashed)[0], ["speaker_status"])


@query("s1_bad_lines", """WITH rows AS (SELECT lang, doc_id, source, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS line FROM documents)
SELECT lang, line, CASE WHEN source = 'src1' THEN 'cut' ELSE 'list' END AS kind FROM rows WHERE source IN ('src1', 'src3')""")
def _(spark, sf):
    """The documents as JSON lines, a folder per language whose files follow each other: those of one source are cut short, those of another are no objects, those of a third are blank."""
    path = f"{checkpoint_folder(spark)}/lines-{uuid.uuid4().hex}"
    line = F.to_json(F.struct("doc_id", "source", "text"))
    value = F.when(F.col("source") == "src1", F.substring(line, 1, 20)).when(F.col("source") == "src3", F.concat(F.lit("["), line, F.lit("]"))).when(F.col("source") == "src2", F.lit("  ")).otherwise(line)
    docs = table(spark, sf, "documents").repartitionByRange("lang", "doc_id").sortWithinPartitions("lang", "doc_id")
    docs.select(value.alias("value"), "lang").write.partitionBy("lang").text(path)
    rows = read_records(spark, path, "doc_id long, source string, text string", "report").where("_corrupt is not null")
    kind = F.when(F.startswith(F.col("_corrupt"), F.lit("[")), "list").otherwise("cut")
    folder = F.regexp_extract("_file", "lang=([^/]*)/", 1)
    # lines in the earlier files of a folder; a row a file
    sizes = numbered_lines(spark, path).groupBy("_file").agg(F.max("_line").alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(folder).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(sizes.select("_file", F.coalesce(earlier, F.lit(0)).alias("_earlier")), "_file")
    return rows.select(folder.alias("lang"), (F.col("_line") + F.col("_earlier")).alias("line"), kind.alias("kind"))
