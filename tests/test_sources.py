import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidence_spark.functions import keys as K
from evidence_spark.operators import quality as Q
from evidence_spark.sources import html as H
from evidence_spark.sources import tables as B
from evidence_spark.sources import transcripts as P


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "media_id long, content string")


def test_markdown_headers_and_inline_cues(spark):
    text = "# Title\n\n## [00:00-00:10] Ann Lee | Opening\n\nHello   there.\nMore words.\n\n## [00:10-00:12] Bob | Opening\n\n[00:20] Ann: inline talk\n[00:31] no colon here\n"
    got = P.cues_from_markdown(docs(spark, text)).orderBy("seq").collect()
    assert [(r.start_s, r.end_s, r.speaker, r.section, r.text) for r in got] == [
        (0.0, 10.0, "Ann Lee", "Opening", "Hello there. More words."), (20.0, 31.0, "Ann", None, "inline talk"), (31.0, 46.0, "unknown", None, "no colon here")]


def test_captions(spark):
    text = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\n<v Ann Lee>Hi &amp; <b>hello</b></v>\n\nNOTE x\n\n00:00:02,500 --> 00:00:04,000\n<v Ann Lee>Hi &amp; hello\n\n00:00:05.000 --> 00:00:06.000\nlast one\nsecond line\n"
    got = P.cues_from_captions(docs(spark, text)).orderBy("seq").collect()
    assert [(r.start_s, r.end_s, r.speaker, r.text) for r in got] == [(1.0, 4.0, "Ann Lee", "Hi & hello"), (5.0, 6.0, "unknown", "last one second line")]


def test_chaptered_turns_pair_ranges_with_headings(spark):
    text = "\n".join(["App", "0:00 - 1:00", "1:00 - 2:00", "#### First (https://x.org/a)", "Ann Lee0:05", "Jump", "abc", "def", "Bob0:30", "#### Second", "Ann Lee1:10", "ghi", "#### Third", "tail"])
    got = P.turns_from_chaptered_text(docs(spark, text), ["Jump"], ["App"]).orderBy("seq").collect()
    assert [(r.speaker, r.start_s, r.end_s, r.chapter, r.text) for r in got] == [
        ("Ann Lee", 5.0, 60.0, "First", "abcdef"), ("Bob", 30.0, 70.0, "Second", ""), ("Ann Lee", 70.0, 120.0, "Second", "ghitail")]
    assert got[0].reference_url == "https://x.org/a" and got[1].reference_url is None


def test_linked_cues_in_four_shapes(spark):
    text = "[00:01 - 00:04] range text\n[[0:05]](https://x.org/1)\nbody one\nbody two\n# heading\n[0:09](https://x.org/2) linked\n0:12 plain\n"
    d = docs(spark, text, text)
    durations = spark.createDataFrame([(0, 20.0)], "media_id long, duration_s double")
    got = P.cues_from_linked_text(d, durations).where("media_id = 0").orderBy("seq").collect()
    assert [(r.start_s, r.end_s, r.text) for r in got] == [(1.0, 4.0, "range text"), (5.0, 9.0, "body one body two"), (9.0, 12.0, "linked"), (12.0, 20.0, "plain")]
    assert all(r.speaker is None for r in got)
    open_ = P.cues_from_linked_text(d, durations).where("media_id = 1 and bad_interval").collect()
    assert len(open_) == 1


def test_html_turns(spark):
    page = ('<h1 class="t">x</h1><p class="b">Intro text</p><h2 class="h">Part <i>one</i></h2><p class="b"><b>Ann:</b> Hello &amp; hi<em>!</em></p><p class="b">More.</p>'
            '<p class="b">Bob: Yes</p><p>no class</p><h2 class="h">Part two</h2><p class="b">Nobody: speaks</p>')
    pages = spark.createDataFrame([(1, page)], "source_id long, html string")
    aliases = spark.createDataFrame([("ann", "Ann Lee"), ("bob", "Bob")], "alias string, speaker string")
    got = H.turns_from_html(pages, aliases, classes={"p": 'class="b"', "h2": 'class="h"'}).orderBy("section_order").collect()
    assert [(r.section_title, r.speaker, r.text) for r in got] == [
        ("Introduction", "unknown", "Intro text"), ("Part one", "Ann Lee", "Hello & hi!\n\nMore."), ("Part one", "Bob", "Yes"), ("Part two", "unknown", "Nobody: speaks")]
    assert page[got[1].char_start:got[1].char_end].startswith('<p class="b"><b>Ann') and page[got[1].char_start:got[1].char_end].endswith("More.</p>")


def test_records_round_trip_and_bad_rows(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], schema)
    for _ in range(2):
        B.write_records(df, str(tmp_path / "out"), ["id"], fmt="json", partitions=1)
        first = sorted(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    B.write_records(df.orderBy("t"), str(tmp_path / "again"), ["id"], fmt="json", partitions=1)
    assert first == sorted(p.read_text() for p in (tmp_path / "again").glob("*.json"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.jsonl").write_text('{"id": 1, "t": "a"}\n\n[1]\n{"id": oops}\n')
    report = B.read_records(spark, str(tmp_path / "bad"), schema, mode="report").cache()
    bad = report.where("_corrupt is not null").collect()
    assert report.where("_corrupt is null").count() == 1 and len(bad) == 2 and all(r._file.endswith("x.jsonl") for r in bad)
    with pytest.raises(Exception):
        B.read_records(spark, str(tmp_path / "bad"), schema).collect()


def test_snapshot_drift(spark, tmp_path):
    for n, t in (("a.txt", "1"), ("b.txt", "2"), ("c.txt", "3")):
        (tmp_path / n).write_text(t)
    frozen = spark.createDataFrame(B.snapshot(spark, str(tmp_path)).collect())
    (tmp_path / "a.txt").write_text("9")
    (tmp_path / "b.txt").unlink()
    (tmp_path / "d.txt").write_text("4")
    got = {r.path.rsplit("/", 1)[1]: r.drift for r in B.diff_snapshot(frozen, B.snapshot(spark, str(tmp_path))).collect()}
    assert got == {"a.txt": "changed", "b.txt": "missing", "d.txt": "extra"}


def test_media_keys_and_redaction(spark):
    urls = {"https://youtu.be/abcDEF_12?t=4": "yt_abcDEF_12", "https://www.youtube.com/watch?v=abcDEF_12&x=1": "yt_abcDEF_12", "http://m.youtube.com/shorts/abcDEF_12": "yt_abcDEF_12",
            "https://youtube.com/embed/abcDEF_12": "yt_abcDEF_12", "https://Site.org:80/A b/": "web_site.org_a-b", "https://site.org": "web_site.org_page", "ftp://x.org": None, "https://youtu.be/ab": None}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", K.media_key("u").alias("k"))
    assert {r.u: r.k for r in df.collect()} == urls
    row = spark.createDataFrame([("https://x.org/a?v=1&key=2#f", "see https://x.org/b?token=9 api_key=zz Bearer abc.def", "s3")], "page_url string, note string, api_token string")
    r = K.redact(row).first()
    assert r.page_url == "https://x.org/a?v=1" and r.api_token == "<redacted>"
    assert r.note == "see https://x.org/b api_key=<redacted> Bearer <redacted>"


def test_contract_stops_writers(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, t string")
    found = Q.violations(df, {"t": {"required": True}}, "id")
    assert [tuple(r) for r in found.collect()] == [(2, "t", "required")]
    with pytest.raises(Q.ContractError):
        Q.require_clean(found)
    Q.require_clean(found.limit(0))
