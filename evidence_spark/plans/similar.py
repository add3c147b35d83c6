"""Queries for duplicates, relations, matching and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence_spark.functions import text as X
from evidence_spark.operators import dedup as U
from evidence_spark.operators import matching as M
from evidence_spark.operators import tiles as L
from evidence_spark.operators import vectors as V
from evidence_spark.operators.scan import scan
from evidence_spark.plans import duck as D
from evidence_spark.plans.expressions import PAIRS_SQL, _grams_sql, turn_pairs
from evidence_spark.plans.extract import claims, sections, talk_claims
from evidence_spark.plans.registry import query
from evidence_spark.plans.tables import table
from evidence_spark.session import cut, small, spread


@query("c1_duplicate_clusters")
def _(spark, sf):
    return U.duplicate_clusters(sections(spark, sf))


@query("c2_canonical_claims")
def _(spark, sf):
    return U.canonical_claims(claims(spark, sf))[0]


@query("c2_claim_relations")
def _(spark, sf):
    return U.canonical_claims(claims(spark, sf))[1]


@query("c3_shared_upstream", f"""{PAIRS_SQL}, g AS (SELECT media_id, seq, na, nb, {_grams_sql('na', 8)} AS a, {_grams_sql('nb', 8)} AS b FROM (SELECT media_id, seq, {D.norm('prev')} AS na, {D.norm('text')} AS nb FROM pairs)),
r AS (SELECT media_id, seq, na, nb, CASE WHEN na = '' OR nb = '' THEN 0 ELSE round(len(list_intersect(a, b)) / greatest(1, len(a))::DOUBLE, 6) END::DOUBLE AS rate FROM g)
SELECT media_id, seq, rate AS shared_8gram_rate, CASE WHEN na = '' OR nb = '' THEN 'insufficient_text' WHEN rate >= 0.35 THEN 'likely_shared_upstream' ELSE 'independent_or_rewritten' END AS assessment FROM r""")
def _(spark, sf):
    return U.shared_upstream(turn_pairs(spark, sf), "prev", "text").select("media_id", "seq", "shared_8gram_rate", "assessment")


@query("c4_near_pairs")
def _(spark, sf):
    n = sections(spark, sf).select("family", F.col("section_id").alias("node"), X.norm_text("text").alias("norm")).where(F.length("norm") >= 80)
    first = n.groupBy("family", "norm").agg(F.min("node").alias("node"))
    return U.near_pairs(first, ["family"], 0.9, U.LONG_NGRAM)


@query("j7_relate_claims")
def _(spark, sf):
    return U.relate_claims(cut(talk_claims(spark, sf)))


@query("t2_block_ratio", f"""WITH b AS (SELECT item_id, {D.norm('text')} AS a FROM benchmark), d AS (SELECT doc_id, {D.norm('text')} AS b FROM documents)
SELECT item_id, doc_id, round(2.0 * least(length(a), length(b)) / (length(a) + length(b)), 6)::DOUBLE AS ratio FROM b JOIN d ON a <> '' AND contains(d.b, b.a)""")
def _(spark, sf):
    """Similarity of each benchmark passage with every document that holds its normalised text.

    A document that holds a passage holds its rarest 8-gram, so that one gram per passage finds them all; shorter passages are their own gram.
    """
    from evidence_spark.functions.similarity import block_ratio

    b = table(spark, sf, "benchmark").select("item_id", X.norm_text("text").alias("a")).where("a <> ''")
    d = table(spark, sf, "documents").select(F.col("doc_id"), X.norm_text("text").alias("b"))
    size = F.least(F.length("a"), F.lit(8))
    sizes = sorted(r[0] for r in b.select(size).distinct().collect())  # at most eight
    found = lambda c, n: F.regexp_extract_all(c, F.lit("(?=(.{%d}))" % n), F.lit(1))
    of_size = lambda c: F.coalesce(*[F.when(size == n, found(c, n)) for n in sizes])
    wanted = cut(b.select("item_id", F.explode(F.array_distinct(of_size("a") if sizes else found("a", 8))).alias("g")))
    # grams of no passage are dropped where they are made
    known = cut(wanted.select("g").distinct())
    have = d.select("doc_id", F.explode(F.array_distinct(F.flatten(F.array(*[found("b", n) for n in sizes or [8]])))).alias("g"))
    have = cut(have.join(small(known), "g", "left_semi").select("doc_id", "g"))
    common = have.groupBy("g").count()
    rarest = wanted.join(common, "g", "left").groupBy("item_id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "g"))["g"].alias("g"))
    hits = have.join(rarest, "g").select("item_id", "doc_id")
    rows = spread(hits.join(b, "item_id").join(d, "doc_id").where(F.contains("b", F.col("a"))), "item_id", "doc_id")
    return rows.select("item_id", "doc_id", F.round(block_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


# --- vectors and matching -----------------------------------------------------------------------

def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.unit(F.col("embedding")).alias("vector"))


def halves(spark, sf):
    """Vectors of low and of high labels."""
    v = vectors(spark, sf).withColumnRenamed("vec_id", "idx")
    return v.where("label < 5"), v.where("label >= 5")


_UNIT = "list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))))"
_COSINES = f"""u AS (SELECT vec_id, label, {_UNIT} AS v FROM embeddings), rect AS (SELECT a.vec_id AS "left", b.vec_id AS "right", round(greatest(-1, least(1, list_dot_product(a.v, b.v))), 6) AS score FROM u a, u b WHERE a.label < 5 AND b.label >= 5)"""


@query("v3_cosine", f'WITH {_COSINES} SELECT "left", "right", score FROM rect WHERE score >= 0.2')
def _(spark, sf):
    """All pairs of the rectangle with some likeness."""
    return L.similar_between(*halves(spark, sf), 0.2)


# the walk over the left rows in order: each takes its best right that is still free
@query("j12_greedy_match", f"""WITH RECURSIVE {_COSINES}, n AS (SELECT DISTINCT "left", dense_rank() OVER (ORDER BY "left") AS n FROM rect), s AS (SELECT n, "right", score FROM rect JOIN n USING ("left")),
walk AS (SELECT 0::BIGINT AS n, NULL::BIGINT AS "right", 0.0::DOUBLE AS score, []::BIGINT[] AS taken UNION ALL
 SELECT n, "right", score, CASE WHEN score >= 0.1 THEN list_append(taken, "right") ELSE taken END FROM (SELECT w.n + 1 AS n, arg_max(s."right", (s.score, -s."right")) AS "right", max(s.score) AS score, any_value(w.taken) AS taken
 FROM walk w JOIN s ON s.n = w.n + 1 AND NOT list_contains(w.taken, s."right") GROUP BY w.n))
SELECT "left", CASE WHEN walk.score >= 0.1 THEN walk."right" END AS "right", coalesce(walk.score, 0.0) AS score FROM n LEFT JOIN walk USING (n)""")
def _(spark, sf):
    return M.match_vectors(*halves(spark, sf), 0.1)


@query("k2_similar_pairs", f"""WITH u AS (SELECT vec_id, {_UNIT} AS v FROM embeddings) SELECT * FROM (SELECT a.vec_id AS "left", b.vec_id AS "right", round(greatest(-1, least(1, list_dot_product(a.v, b.v))), 6) AS similarity FROM u a JOIN u b ON a.vec_id < b.vec_id) WHERE similarity >= 0.25""")
def _(spark, sf):
    return L.similar_pairs(vectors(spark, sf), 0.25, idx="vec_id")


def prototypes(spark, sf):
    """Unit mean vector per label; as many rows as labels."""
    v = vectors(spark, sf).select("label", F.posexplode("vector").alias("d", "x")).groupBy("label", "d").agg(F.avg("x").alias("x"))
    rows = v.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda r: r["x"]).alias("m"))
    return rows.select("label", V.unit(F.col("m")).alias("vector"))


_PROTO = f"""u AS (SELECT vec_id, label, {_UNIT} AS v FROM embeddings), d AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM u), m AS (SELECT label, d, avg(x) AS x FROM d GROUP BY 1, 2),
p AS (SELECT label, list(x ORDER BY d) AS m FROM m GROUP BY 1), proto AS (SELECT label, list_transform(m, lambda x: x / sqrt(list_sum(list_transform(m, lambda y: y * y)))) AS pv FROM p),
scores AS (SELECT vec_id AS row_id, 'label' || proto.label AS query, greatest(0, least(1, list_dot_product(v, pv))) AS semantic, u.label / 10.0 AS importance, (u.label = proto.label) AS hit FROM u, proto),
recall AS (SELECT row_id, query, round(least(1, greatest(0, 0.82 * semantic + CASE WHEN hit THEN 0.08 ELSE 0 END + 0.02 * importance)), 6) AS score, importance FROM scores)"""


def recall(spark, sf):
    protos = [(f"label{r['label']}", r["vector"], [f"t{r['label']}"], []) for r in sorted(prototypes(spark, sf).collect(), key=lambda r: r["label"])]
    c = vectors(spark, sf).select(F.col("vec_id").alias("row_id"), F.lit("").alias("claim"), "vector", F.array(F.concat(F.lit("t"), F.col("label").cast("string"))).alias("themes"), (F.col("label") / 10.0).alias("importance"))
    return V.semantic_recall(c, protos)


@query("v6_semantic_recall", f"WITH {_PROTO} SELECT row_id, query, score FROM recall")
def _(spark, sf):
    return recall(spark, sf).select("row_id", "query", "score")


def _r2_sql():
    ctes, names = [], []
    for q in range(10):
        taken = " UNION ALL ".join(f"SELECT row_id FROM b{i}" for i in range(q))
        where = f" AND row_id NOT IN ({taken})" if taken else ""
        ctes.append(f"b{q} AS (SELECT row_id, query, score, 'balanced' AS method FROM recall WHERE query = 'label{q}'{where} ORDER BY score DESC, importance DESC, row_id LIMIT 8)")
        names.append(f"SELECT * FROM b{q}")
    taken = " UNION ALL ".join(names)
    return (f"WITH {_PROTO}, {', '.join(ctes)}, taken AS ({taken}), own AS (SELECT row_id, arg_max(query, (score, query = 'label0', query)) AS query, max(score) AS score, any_value(importance) AS importance FROM recall WHERE row_id NOT IN (SELECT row_id FROM taken) GROUP BY row_id), "
            "tail AS (SELECT *, row_number() OVER (ORDER BY score DESC, importance DESC, row_id) AS n FROM own) "
            "SELECT row_id, query, method FROM taken UNION ALL SELECT row_id, query, CASE WHEN n <= 20 THEN 'fill' ELSE 'boundary' END FROM tail WHERE n <= 45")


@query("r2_balanced_top_k", _r2_sql())
def _(spark, sf):
    return M.balanced_top_k(cut(recall(spark, sf)), [f"label{q}" for q in range(10)], k=8, total=100, boundary=25).select("row_id", "query", "method")


def proto_scores(spark, sf):
    return recall(spark, sf).select(F.substring("query", 6, 5).cast("long").alias("left"), F.col("row_id").alias("right"), "score")


def _greedy_sql(rows: str, least: float) -> str:
    """CTEs g0 to g9 and first: prototypes in order take their best free row of ``rows``."""
    ctes = []
    for q in range(10):
        taken = " UNION ALL ".join(f'SELECT "right" FROM g{i}' for i in range(q))
        where = f' AND row_id NOT IN ({taken})' if taken else ""
        ctes.append(f"""g{q} AS (SELECT {q}::BIGINT AS "left", row_id AS "right", score FROM {rows} WHERE query = 'label{q}' AND score >= {least}{where} ORDER BY score DESC, row_id LIMIT 1)""")
    return ", ".join(ctes) + ", first AS (" + " UNION ALL ".join(f"SELECT * FROM g{q}" for q in range(10)) + ")"


@query("r3_anchor_recall", f"""WITH {_PROTO}, taken AS (SELECT DISTINCT row_id FROM recall WHERE score >= 0.8), free AS (SELECT * FROM recall WHERE row_id NOT IN (SELECT row_id FROM taken)), {_greedy_sql('free', 0.2)},
n AS (SELECT *, row_number() OVER (ORDER BY "left") AS k FROM first) SELECT "left", "right", score FROM n WHERE k <= (SELECT greatest(0, 180 - count(*)) FROM taken)""")
def _(spark, sf):
    s = cut(proto_scores(spark, sf))
    taken = cut(s.where("score >= 0.8").select("right").distinct())
    return M.anchor_recall(s, taken, taken.count(), cap=180, min_score=0.2).select("left", "right", "score")


_ASSIGNED = f"""{_PROTO}, {_greedy_sql('recall', 0.3)}, rest AS (SELECT row_id AS "right", substr(query, 6)::BIGINT AS "left", score FROM recall WHERE row_id NOT IN (SELECT "right" FROM first)),
best AS (SELECT *, row_number() OVER (PARTITION BY "right" ORDER BY score DESC, "left") AS k FROM rest),
assigned AS (SELECT "right", "left", score, 1 AS pass FROM first UNION ALL SELECT "right", "left", score, 2 AS pass FROM best WHERE k = 1)"""


@query("r4_assign_prototypes", f'WITH {_ASSIGNED} SELECT "right", "left", score, pass FROM assigned')
def _(spark, sf):
    return M.assign_prototypes(cut(proto_scores(spark, sf)), 0.3)


@query("r4_prototype_rollup", f"""WITH {_ASSIGNED} SELECT "left", count(*) AS member_count, round(avg(score), 6) AS mean_similarity, arg_max("right", (score, -"right")) AS representative FROM assigned GROUP BY "left\"""")
def _(spark, sf):
    return M.prototype_rollup(M.assign_prototypes(cut(proto_scores(spark, sf)), 0.3))


@query("v1_hash_embed", """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY 1, 2), h AS (SELECT *, sha256(w) AS h FROM c),
s AS (SELECT doc_id, ('0x' || substr(h, 1, 4))::BIGINT % 128 AS slot, sum(n * CASE WHEN ('0x' || substr(h, 5, 2))::BIGINT % 2 = 1 THEN 1 ELSE -1 END)::DOUBLE AS v FROM h GROUP BY 1, 2), z AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM s GROUP BY 1)
SELECT doc_id, slot, round(v / n, 5) AS value FROM s JOIN z USING (doc_id) WHERE v <> 0""")
def _(spark, sf):
    v = V.hash_embed(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    return v.select("doc_id", F.posexplode("vector").alias("slot", "value")).where("value <> 0").select("doc_id", F.col("slot").cast("long").alias("slot"), F.round("value", 5).alias("value"))


@query("v2_embed_with_cache", """SELECT count(DISTINCT text) AS n_new, 0::BIGINT AS n_again FROM documents""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    _, new = V.embed(d, V.Scorer.hashed())
    _, again = V.embed(d, V.Scorer.hashed(), cache=new)
    both = new.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(again.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.agg(F.sum("a").cast("long").alias("n_new"), F.sum("b").cast("long").alias("n_again"))


def lines(spark, sf):
    """Vectors of one label as a line of positions."""
    v = vectors(spark, sf).withColumnRenamed("label", "media_id")
    return scan(v, ["media_id"], ["vec_id"], sums_before={"idx": F.lit(1).cast("long")})


@query("v4_pool_spans", f"""WITH u AS (SELECT label AS media_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, {_UNIT} AS v FROM embeddings), x AS (SELECT media_id, idx, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM u), """
       + ", ".join(f"s{c} AS (SELECT media_id, idx AS start, {c} AS count, d, sum(x) OVER w AS x, count(*) OVER w AS n FROM x WINDOW w AS (PARTITION BY media_id, d ORDER BY idx ROWS BETWEEN CURRENT ROW AND {c - 1} FOLLOWING))" for c in (1, 2, 3))
       + ", a AS (" + " UNION ALL ".join(f"SELECT * FROM s{c} WHERE n = {c}" for c in (1, 2, 3)) + ") SELECT media_id, start, count::BIGINT AS count, round(max(x) FILTER (d = 1) / sqrt(sum(x * x)), 5) AS v1, round(max(x) FILTER (d = 64) / sqrt(sum(x * x)), 5) AS v64 FROM a GROUP BY 1, 2, 3")
def _(spark, sf):
    p = V.pool_spans(lines(spark, sf).select("media_id", "idx", "vector"), 3)
    return p.select("media_id", "start", F.col("count").cast("long").alias("count"), F.round(F.element_at("vector", 1), 5).alias("v1"), F.round(F.element_at("vector", 64), 5).alias("v64"))


@query("v5_margin_scores", f"""WITH u AS (SELECT label AS media_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, {_UNIT} AS v FROM embeddings),
p AS (SELECT a.media_id, a.idx AS i, b.idx AS j, round(greatest(-1, least(1, list_dot_product(a.v, b.v))), 6) AS raw FROM u a JOIN u b ON a.media_id = b.media_id WHERE a.idx % 2 = 0 AND b.idx % 2 = 1),
ri AS (SELECT media_id, i, avg(raw) AS bi FROM (SELECT *, row_number() OVER (PARTITION BY media_id, i ORDER BY raw DESC) AS r FROM p) WHERE r <= 4 GROUP BY 1, 2), rj AS (SELECT media_id, j, avg(raw) AS bj FROM (SELECT *, row_number() OVER (PARTITION BY media_id, j ORDER BY raw DESC) AS r FROM p) WHERE r <= 4 GROUP BY 1, 2),
m AS (SELECT p.*, round(raw - (bi + bj) / 2, 9) AS margin FROM p JOIN ri USING (media_id, i) JOIN rj USING (media_id, j)), n AS (SELECT *, row_number() OVER (PARTITION BY media_id ORDER BY margin) - 1 AS rk, count(*) OVER (PARTITION BY media_id) AS c FROM m),
lo AS (SELECT media_id, margin AS lo FROM n WHERE rk = round_even((c - 1) * 0.02, 0)), hi AS (SELECT media_id, margin AS hi FROM n WHERE rk = round_even((c - 1) * 0.98, 0))
SELECT media_id, i, j, round(margin, 4) AS margin, round(score, 4) AS score FROM (SELECT media_id, i, j, margin, round(CASE WHEN hi <= lo + 1e-9 THEN 0.5 ELSE least(1, greatest(0, (margin - lo) / (hi - lo))) END, 6) AS score FROM m JOIN lo USING (media_id) JOIN hi USING (media_id)) WHERE score >= 0.7""")
def _(spark, sf):
    """The stronger cells of each recording's rectangle; baselines and ranks are those of all its cells."""
    v = lines(spark, sf).select("media_id", "idx", "vector")
    m = V.rectangle_margins(v.where("idx % 2 = 0"), v.where("idx % 2 = 1"), 0.7)
    return m.select("media_id", "i", "j", F.round("margin", 4).alias("margin"), F.round("score", 4).alias("score"))


@query("v5_rectangle_baselines", f"""WITH u AS (SELECT label AS media_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, {_UNIT} AS v FROM embeddings),
p AS (SELECT a.media_id, a.idx AS i, b.idx AS j, round(greatest(-1, least(1, list_dot_product(a.v, b.v))), 6) AS raw FROM u a JOIN u b ON a.media_id = b.media_id WHERE a.idx % 2 = 0 AND b.idx % 2 = 1)
SELECT media_id, 'a' AS side, i AS idx, round(avg(raw), 4) AS baseline FROM (SELECT *, row_number() OVER (PARTITION BY media_id, i ORDER BY raw DESC) AS r FROM p) WHERE r <= 4 GROUP BY media_id, i
UNION ALL SELECT media_id, 'b', j, round(avg(raw), 4) FROM (SELECT *, row_number() OVER (PARTITION BY media_id, j ORDER BY raw DESC) AS r FROM p) WHERE r <= 4 GROUP BY media_id, j""")
def _(spark, sf):
    v = lines(spark, sf).select("media_id", "idx", "vector")
    return V.rectangle_baselines(v.where("idx % 2 = 0"), v.where("idx % 2 = 1")).withColumn("baseline", F.round("baseline", 4))


@query("v5_rectangle_rank", f"""WITH u AS (SELECT label AS media_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, {_UNIT} AS v FROM embeddings),
p AS (SELECT a.media_id, round(1 - round(greatest(-1, least(1, list_dot_product(a.v, b.v))), 6), 9) AS cost FROM u a JOIN u b ON a.media_id = b.media_id WHERE a.idx % 2 = 0 AND b.idx % 2 = 1), n AS (SELECT *, row_number() OVER (PARTITION BY media_id ORDER BY cost) - 1 AS rk, count(*) OVER (PARTITION BY media_id) AS c FROM p WHERE cost > 1e-9)
SELECT media_id, round(cost, 5) AS gap FROM n WHERE rk = round_even((c - 1) * 0.2, 0)""")
def _(spark, sf):
    v = lines(spark, sf).select("media_id", "idx", "vector")
    return V.rectangle_rank(v.where("idx % 2 = 0"), v.where("idx % 2 = 1"), 0.2, "raw_cost", name="gap").withColumn("gap", F.round("gap", 5))
