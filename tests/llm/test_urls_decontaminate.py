import random
import re
from collections import Counter

from evidence_spark.llm import decontaminate as D
from evidence_spark.llm import urls as U
from evidence_spark.llm.queries import RULES

URLS = [
    "http://www.example.com/en/1?x#y", "https://EXAMPLE.com/en/", "https://example.com/en", "http://a.b.example.com/en/z", "http://www.example.com", "http://other.com/", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/1",
    "http://notexample.com/en/", "com/en/", "", None, "ftp://com?/en/", "http://com#/", "http:///path", "x://y://com/en/", "http://www.example.com:80/en/", "http://.com/", "http://example.com//en/", "http://ÉX.com/É/", "a\nb://q.com/\n/z",
    "http://" + "a." * 3000 + "com/" + "p/" * 3000,
]


def brute_rule(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def check(spark, rules, urls=URLS):
    df = spark.createDataFrame([(i % 9, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = Counter((r.url, r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(df, table).collect())
    known = [(h.lower(), p or "", v) for h, p, v in rules if h is not None and v is not None]
    assert got == Counter((u, *brute_rule(u, known)) for u in urls)


def test_rules_of_the_query(spark):
    check(spark, RULES)
    check(spark, RULES, URLS * 3)


def test_odd_rules(spark):
    check(spark, [("example.com", "/e", "block"), ("example.com", "", "allow"), ("com", None, "block"), (None, "/", "block"), ("net", "/es", "allow"), ("net", "/es", "block"), ("NET", "/fr/", "block"), ("a.b.example.com", "/en/z", "allow")])
    check(spark, [])
    check(spark, RULES, [])


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n):
    out = Counter()
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            m = min(n, len(p))
            grams = {tuple(p[i: i + m]) for i in range(len(p) - m + 1)} if m else set()
            for i in range(len(w) - m + 1):
                if m and tuple(w[i: i + m]) in grams:
                    hit |= set(range(i, i + m))
                    found.add(str(item))
        out[(doc_id, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


def table(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "日本", "Ab"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [(i, text(k)) for i, k in enumerate([30, 20, 13, 12, 5, 1, 0])] + [(7, None), (8, "!!! ..."), (2, text(14))]
    docs = [(i, " ".join([text(rng.randint(0, 40)), *(rng.sample([t for _, t in items if t], 1) if i % 3 else []), text(rng.randint(0, 60))])) for i in range(40)]
    docs += [(3, docs[4][1]), (4, docs[4][1]), (4, docs[4][1]), (90, None), (91, ""), (92, "?!"), (None, items[0][1].upper()), (93, "w1 " * 30_000 + items[0][1])]
    return docs, items


def test_windows_equal_brute_force(spark, monkeypatch):
    docs, items = table(spark)
    df = spark.createDataFrame([(*r, 1, "clash") for r in docs], "doc_id long, text string, n_words int, items string")
    bench = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, doc_id string")
    for n in (13, 4):
        want = brute(docs, items, n)
        for limit in (D.BROADCAST_WINDOWS, 0):  # broadcast, then the way for more windows than may be broadcast
            monkeypatch.setattr(D, "BROADCAST_WINDOWS", limit)
            got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in D.contamination(df, bench, n).collect())
            assert got == want, (n, limit, list((got - want).items())[:2], list((want - got).items())[:2])
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k[0]) for k, c in brute(docs, items, 13).items() for _ in range(c) if not k[5])


def test_spans_are_removed(spark):
    docs, items = [(1, "a b c d e f g"), (2, "x c d e y c d e"), (3, None)], [(1, "C, d. E")]
    got = {r.doc_id: r.clean_text for r in D.remove_spans(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: "a b f g", 2: "x y", 3: ""}


def test_empty_tables(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    assert D.contamination(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in D.contamination(docs, bench.limit(0)).collect())
    assert D.contamination(docs, bench).count() == docs.count()
