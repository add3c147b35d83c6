import base64
import hashlib
import html
import re
import tempfile

import numpy as np
import pytest

from evidence_spark.llm import extract as E
from evidence_spark.llm import vptree as V
from evidence_spark.llm import warc as W


def brute_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            near = sorted((-(q @ v), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


@pytest.mark.parametrize("shard", [8192, 300])
def test_exact_search_equals_brute_force(spark, shard):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0] * 8) for i in range(300)]  # one vector holds a quarter of all rows
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] + [1.0] * 7), (2080, [None] + [1.0] * 7), (None, [1.0] * 8), (2100, [1.0, 2.0]), (2101, [3.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<float>, rank int, score double")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {}
    for r in V.nearest(df, df.where("vec_id % 20 = 0"), k=20, shard=shard, per_task=25).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = brute_nearest(rows, 20)
    assert got.keys() == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert sorted(near) == list(range(1, len(want[q]) + 1))
        assert [near[k + 1][0] for k in range(len(near))] == [j for j, _ in want[q]]
        assert np.allclose([near[k + 1][1] for k in range(len(near))], [s for _, s in want[q]], atol=1e-12)


def test_factor_trades_recall_for_work():
    rng = np.random.default_rng(4)
    points = np.concatenate([c + 0.05 * rng.normal(size=(500, 3)) for c in rng.normal(size=(12, 3))])
    ids, top = np.arange(len(points)), float(np.linalg.norm(points, axis=1).max())
    tree = V.Tree(np.hstack([points, np.sqrt((top**2 - (points**2).sum(axis=1, keepdims=True)).clip(min=0))]), leaf=32)
    scores = points[::20] @ points.T
    scores[np.arange(300), ids[::20]] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    work, recall = [], []
    for factor in (1.0, 0.95, 0.8):
        found = V.Search(tree, ids, points, ids[::20], points[::20], 20, top, factor)
        work.append(found.compared)
        recall.append(np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.who.tolist(), best.tolist(), strict=True)]))
    assert recall[0] == 1 and work[0] < 0.5 * scores.size  # exact, and prunes
    assert work[0] > work[1] > work[2] and recall[1] >= recall[2]


def test_nothing_to_search(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (40, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert V.nearest(df.limit(0), df).count() == 0 and V.nearest(df, df.limit(0)).count() == 0
    assert sorted((r.query_id, r.vec_id) for r in V.nearest(df.union(df), df).collect()) == [(20, 40)] * 2 + [(40, 20)] * 2


PAGES = [(1, "http://a/x", "same"), (2, "http://b/y z", "same"), (3, None, None), (4, "http://c", ""), (5, "http://d", "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\nHTTP/1.1"), (5, "http://d", "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\nHTTP/1.1"),
         (None, "http://e", "same"), (None, "http://f", "zz"), (None, "http://g", "zz"), (-7, "é", "é日本"), (9, "http://h", "long " * 100_000)]


def brute_archive(rows, least=0):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = last.get(h or "") if len(data) >= least else None
        revisit = refers is not None and refers != i
        out.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_archives_round_trip(spark, least):
    df = spark.createDataFrame([(*r, "clash") for r in PAGES], "page_id long, url string, html string, payload string")
    got = W.archive_pages(df, tempfile.mkdtemp(prefix="warc-") + "/out", least).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute_archive(PAGES, least)
    path = tempfile.mkdtemp(prefix="warc-") + "/out"
    W.write_warc(W.mark_revisits(W.convert(W.arc_archives(df)), 0), path)
    back = {(r.page_id, bytes(r.payload).decode()) for r in W.read_warc(spark, path).where("record_type = 'response'").collect()}
    assert back == {(i, h or "") for i, _, h in PAGES if (str(i), "response") in {(x[0], x[3]) for x in brute_archive(PAGES)} and (i is not None or h == "zz")}
    assert W.archive_pages(df.limit(0), tempfile.mkdtemp(prefix="warc-") + "/out").count() == 0


def test_arc_versions_and_broken_files():
    records = [W.ArcRecord("http://x/a b", "1.2.3.4", "20010203040506", "text/html", "404", b"HTTP/1.0 404 No\r\nA: b\r\n\r\nhello\nfiledesc: x 1\n"), W.ArcRecord("dns:y", "0.0.0.0", "2001", "text/dns", None, b""), W.ArcRecord("http://z", "-", "bad", "-", None, bytes(range(256)))]
    for version in (1, 2):
        data = W.arc_file(records, version)
        got = list(W.parse_arc(data))
        assert [(r.url, r.ip, r.date, r.mime, r.content) for r in got] == [(r.url, r.ip, r.date, r.mime, r.content) for r in records]
        assert [r.result for r in got] == ([None] * 3 if version == 1 else ["404", "-", "-"])
        assert [r.content for r in W.parse_arc(data + data)] == [r.content for r in records] * 2
        assert len(list(W.parse_arc(data[:-20]))) == 2
    assert list(W.parse_arc(b"")) == [] and list(W.parse_arc(b"no header\n")) == []
    assert [W.warc_date(d) for d in ("20010203040506", "2001", "bad")] == ["2001-02-03T04:05:06Z", "2001-01-01T00:00:00Z", "1970-01-01T00:00:00Z"]


PAGE = """<html><body class="no-sidebar"><header><div>Site</div></header><div id=wrap><div class="menu">a<ul><li>x<li>y</ul></div><main><article class="post post-12"><header><h1>T &amp; U</h1></header>
<p>One<br>two   <b>three</b></p><div class="ad-box">buy</div><section><p>Four, five &lt;b&gt;<p>six</section><table><tr><td>c1<td>c2</table></article>
<section id="comments"><article>nice!</article></section></main></div><footer>f</footer><form>q<input></form><script>var t="<p>no</p>";</script>"""


def text(page):
    return E.text_at(E.page_blocks(page), None)


def test_blocks_without_boilerplate():
    assert text(PAGE) == "T & U\nOne two three\nFour, five <b>\nsix\nc1\nc2"
    cases = {"": "", "plain <b": "plain", "a<br>b": "a b", "<p>x</p>tail": "x\ntail", "<div class='menu'>only</div>": "only", "&nbsp; &lt;": "<", "<p>a &copy b": "a © b", "<!-- <p>x</p> --><p>y": "y", "<style>p{}": ""}
    assert {k: text(k) for k in cases} == cases


def test_hosts_agree_on_a_path(spark):
    page = "<html><body><div class='story s{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body></html>"
    rows = [(i, f"http://one.org/{i}", page.format(i, f"story {i} " * 20, "extra " * 3)) for i in range(6)]
    rows.append((6, "http://one.org/odd", page.format(6, "short story", "extra words that are longer than the story " * 5)))  # its own vote is outvoted
    rows += [(7, "http://two.org/", "<body><p>other host</p></body>"), (8, None, "<p>no host</p>"), (9, "http://one.org/z", "<body><p>no story here</p></body>"), (10, "http://one.org/", None), (11, "http://one.org/", ""), (7, "http://two.org/", "<body><p>other host</p></body>")]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "page_id long, url string, html string, text string, host int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in E.extract_pages(df).collect())
    want = [(i, ("story %d " % i * 20).strip()) for i in range(6)] + [(6, "short story"), (7, "other host"), (7, "other host"), (8, "no host"), (9, "no story here"), (10, ""), (11, "")]
    assert got == [(i, t, len(t)) for i, t in sorted(want)]
    assert E.extract_pages(df.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in E.extract_pages(df).collect()}
    for r in df.collect():
        article = r.html[r.html.index("<article>") + 9: r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
