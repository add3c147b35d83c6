"""Text expressions: normalising, token sets, conflicts, risks, topics, claim types and scores.

Everything here is a Column expression, so it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidence_spark.functions import rules as R


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body`` (also inside lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def empty() -> Column:
    return F.array().cast("array<string>")


def norm_text(c: str | Column) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "")


def strip(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: str | Column) -> Column:
    return strip(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def matches(c: str | Column, pattern: str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0))


def has(c: str | Column, pattern: str) -> Column:
    return _col(c).rlike(pattern)


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def lowered(c: Column) -> Column:
    return F.transform(c, lambda x: F.lower(x))


def sentences(c: str | Column, pattern: str = R.SENTENCE_BREAK) -> Column:
    """Trimmed, non-empty sentences in text order."""
    return F.filter(F.transform(F.split(_col(c), pattern), strip), lambda x: F.length(x) > 0)


# --- n-grams ------------------------------------------------------------------------------------

def grams(c: str | Column, n: int) -> Column:
    """Distinct character n-grams of the normalised text, first seen first.

    A look-ahead with a capture group gives the overlapping grams in one pass over the text.
    """
    return F.array_distinct(F.regexp_extract_all(norm_text(c), F.lit("(?=(.{%d}))" % n), F.lit(1)))


def gram_overlap(a: str | Column, b: str | Column, n: int = 8, mode: str = "smaller") -> Column:
    """Shared n-grams over the smaller gram set, or over the left (``left``) or right (``right``) one."""
    return gram_share(grams(a, n), grams(b, n), mode)


def gram_share(left: Column, right: Column, mode: str = "smaller") -> Column:
    base = {"smaller": F.least(F.size(left), F.size(right)), "left": F.size(left), "right": F.size(right)}[mode]
    return F.size(F.array_intersect(left, right)) / F.greatest(F.lit(1), base)


# --- token sets, conflicts, risks -----------------------------------------------------------------

def numbers(c, pattern: str = R.NUMBER) -> Column:
    return sorted_set(lowered(matches(c, pattern)))


def negations(c) -> Column:
    return sorted_set(lowered(matches(c, R.NEGATION)))


def models(c) -> Column:
    return sorted_set(lowered(matches(c, R.MODEL)))


def entities(c, stop: Sequence[str] = tuple(R.ENTITY_STOP)) -> Column:
    """Capitalised names that are distinctive: several words, an inner capital, a digit, a dot or a dash."""
    raw = F.filter(
        matches(c, R.ENTITY),
        lambda x: (~F.lower(x).isin(*stop)) & x.rlike(r"(?Us)\s|^.+\p{Lu}|\p{Nd}|[-.]"),
    )
    return sorted_set(lowered(raw))


def token_sets(c, pack: str = "text") -> Column:
    """STRUCT<numbers, models, negations, entities>; the ``fused`` pack has no entities."""
    if pack == "fused":
        return F.struct(
            fused_numbers(c).alias("numbers"), fused_models(c).alias("models"),
            fused_negations(c).alias("negations"), empty().alias("entities"),
        )
    return F.struct(
        numbers(c).alias("numbers"), models(c).alias("models"),
        negations(c).alias("negations"), entities(c).alias("entities"),
    )


def fused_numbers(c) -> Column:
    return sorted_set(lowered(matches(c, R.FUSED_NUMBER)))


def fused_models(c) -> Column:
    return sorted_set(F.transform(matches(c, R.FUSED_MODEL), norm_text))


def fused_negations(c) -> Column:
    words = lowered(matches(c, R.FUSED_WORD))
    return sorted_set(F.filter(words, lambda w: w.isin(*R.FUSED_NEGATIONS)))


def protected_terms(*cols) -> Column:
    """Words of names and titles that must appear on both sides or on neither."""
    words = lowered(matches(F.concat_ws(" ", *[_col(c) for c in cols]), R.FUSED_WORD))
    return sorted_set(F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*R.FUSED_STOPWORDS)))


CONFLICT = "array<struct<type:string,left:array<string>,right:array<string>,terms:array<string>>>"


def _conflict(kind: str, when: Column, left: Column, right: Column, terms: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("type"), left.alias("left"), right.alias("right"), terms.alias("terms")))


def _differ(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) > 0) | (F.size(F.array_except(b, a)) > 0)


def conflicts_structured(structure, text, *terms) -> Column:
    """Conflicts between the structure source and the text source of one span."""
    s, t = _col(structure), _col(text)
    ns, nt = fused_numbers(s), fused_numbers(t)
    ms, mt = fused_models(s), fused_models(t)
    gs, gt = fused_negations(s), fused_negations(t)
    one_sided = let(
        F.struct(norm_text(s).alias("s"), norm_text(t).alias("t")),
        lambda n: F.filter(protected_terms(*terms), lambda w: F.contains(n["s"], w) != F.contains(n["t"], w)),
    ) if terms else empty()
    return F.array_compact(F.array(
        _conflict("numeric_conflict", (F.size(ns) > 0) & (F.size(nt) > 0) & _differ(ns, nt), ns, nt, empty()),
        _conflict("model_name_conflict", _differ(ms, mt), ms, mt, empty()),
        _conflict("negation_conflict", _differ(gs, gt), gs, gt, empty()),
        _conflict("protected_term_conflict", F.size(one_sided) > 0, empty(), empty(), one_sided),
    )).cast(CONFLICT)


def conflicts_text(a, b) -> Column:
    """Conflicts between two texts of equal standing."""
    parts = []
    for kind, fn in (("numeric_conflict", numbers), ("negation_conflict", negations), ("model_name_conflict", models)):
        left, right = fn(a), fn(b)
        parts.append(_conflict(kind, _differ(left, right), left, right, empty()))
    left, right = entities(a), entities(b)
    parts.append(_conflict("entity_conflict", (F.size(left) > 0) & (F.size(right) > 0) & _differ(left, right), left, right, empty()))
    return F.array_compact(F.array(*parts)).cast(CONFLICT)


def risk_summary(c) -> Column:
    return F.struct(
        numbers(c).alias("numeric_risks"),
        F.array_sort(F.array_union(models(c), entities(c))).alias("entity_risks"),
        negations(c).alias("negation_risks"),
    )


# --- topics, types, values, scores --------------------------------------------------------------

def tag_topics(c, topics: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Topics of a regex rule pack with at least one matching pattern, in pack order."""
    topics = topics or R.DEFAULT_TOPICS
    return F.array_compact(F.array(*[
        F.when(_col(c).rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(topic))
        for topic, patterns in topics.items()
    ]))


def tag_keywords(c, keywords: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Themes of a substring pack, matched on the lower-cased text padded with spaces; sorted."""
    keywords = keywords or R.DEFAULT_KEYWORDS
    low = F.concat(F.lit(" "), F.lower(_col(c)), F.lit(" "))

    def hit(terms):
        out = F.contains(low, F.lit(terms[0]))
        for term in terms[1:]:
            out = out | F.contains(low, F.lit(term))
        return out

    return F.array_sort(F.array_compact(F.array(*[F.when(hit(list(terms)), F.lit(t)) for t, terms in keywords.items()])))


def claim_type(c, novelty=None, pack: str = "talk") -> Column:
    """First rule that applies. ``talk`` reads the novelty type too, ``corpus`` reads the text alone."""
    t = _col(c)
    if pack == "corpus":
        low = F.lower(t)
        out = F.when(strip(t).endswith("?"), F.lit("open_question"))
        for name, pattern in R.CORPUS_TYPES:
            out = out.when(low.rlike(pattern), F.lit(name))
        return out.otherwise(F.lit("opinion"))
    nov = _col(novelty)
    return (
        F.when(nov == "failure_mode", F.lit("failure_mode"))
        .when(t.rlike(R.QUESTION), F.lit("open_question"))
        .when(t.rlike(R.FUTURE), F.lit("prediction"))
        .when(t.rlike(R.CAUSAL), F.lit("causal_claim"))
        .when(t.rlike(R.CONDITIONAL), F.lit("conditional_conclusion"))
        .when(t.rlike(R.COMPARISON), F.lit("comparison"))
        .when(nov == "boundary_condition", F.lit("engineering_constraint"))
        .otherwise(F.lit("technical_mechanism"))
    )


def value_types(novelty, n_signals, n_numbers, agreement) -> Column:
    nov, agr = _col(novelty), _col(agreement)
    failure, boundary = nov == "failure_mode", nov == "boundary_condition"
    return F.array_sort(F.array_compact(F.array(
        F.lit("trend_signal"), F.lit("practical_implication"),
        F.when(_col(n_signals) > 0, F.lit("non_consensus")),
        F.when(_col(n_numbers) > 0, F.lit("quantitative_signal")),
        F.when(failure, F.lit("failure_case")),
        F.when(failure | boundary, F.lit("boundary_condition")),
        F.when(boundary, F.lit("hidden_assumption")),
        F.when(agr.isin("mixed", "conflict"), F.lit("cross_source_connection")),
    )))


def corpus_value_types(c, ctype) -> Column:
    t, kind = _col(c), _col(ctype)
    low = F.lower(t)
    return F.array_sort(F.array_compact(F.array(
        F.lit("trend_signal"),
        F.when(t.rlike(R.CORPUS_NUMBER), F.lit("quantitative_signal")),
        F.when(kind == "failure_mode", F.lit("failure_case")),
        F.when(kind.isin("failure_mode", "conditional_conclusion"), F.lit("boundary_condition")),
        F.when(kind == "conditional_conclusion", F.lit("hidden_assumption")),
        F.when(low.rlike(R.CORPUS_NON_CONSENSUS), F.lit("non_consensus")),
        F.when(low.rlike(R.CORPUS_ROUTE_CHANGE), F.lit("route_change")),
        F.when(kind.isin("causal_claim", "normative_claim", "strategic_advice"), F.lit("practical_implication")),
    )))


def non_consensus_score(novelty, n_signals) -> Column:
    return F.least(F.lit(1.0), F.lit(0.18) + F.lit(0.18) * _col(n_signals)
                   + F.when(_col(novelty) == "failure_mode", 0.18).otherwise(0.0))


def score_struct(novelty, n_signals, n_numbers, agreement) -> Column:
    """STRUCT<confidence, novelty_score, importance_score, non_consensus_score>, six decimals."""
    nov = _col(novelty)
    nc = non_consensus_score(novelty, n_signals)
    novelty_score = F.least(F.lit(1.0), F.lit(0.35) + F.lit(0.28) * nc
                            + F.when(nov.isin("failure_mode", "boundary_condition", "scaling_law"), 0.15).otherwise(0.0))
    importance = F.least(F.lit(1.0), F.lit(0.52) + F.when(_col(n_numbers) > 0, 0.10).otherwise(0.0)
                         + F.when(nov.isin("failure_mode", "boundary_condition"), 0.12).otherwise(0.0) + F.lit(0.16) * nc)
    conf = F.lit(None).cast("double")
    for name, value in R.AGREEMENT_CONFIDENCE.items():
        conf = F.when(_col(agreement) == name, F.lit(value)).otherwise(conf)
    return F.struct(
        F.coalesce(conf, F.lit(0.65)).alias("confidence"), F.round(novelty_score, 6).alias("novelty_score"),
        F.round(importance, 6).alias("importance_score"), F.round(nc, 6).alias("non_consensus_score"),
    )


def corpus_importance(c, ctype, themes) -> Column:
    t = _col(c)
    score = (
        F.lit(0.42) + F.least(F.lit(0.2), F.size(_col(themes)) * F.lit(0.03))
        + F.when(t.rlike(R.CORPUS_NUMBER), 0.1).otherwise(0.0)
        + F.when(_col(ctype).isin("prediction", "causal_claim", "failure_mode", "conditional_conclusion",
                                  "institutional_claim"), 0.12).otherwise(0.0)
        + F.when(F.length(t) >= 120, 0.06).otherwise(0.0)
    )
    return F.round(F.least(F.lit(0.96), score), 4)


def signals(c, pattern: str = R.NON_CONSENSUS) -> Column:
    return sorted_set(lowered(matches(c, pattern)))


def block_novelty(text, topic) -> Column:
    t = _col(text)
    return (
        F.when(t.rlike(R.FAILURE), F.lit("failure_mode"))
        .when(t.rlike(R.BOUNDARY), F.lit("boundary_condition"))
        .when(_col(topic).isin(*R.SCALING_TOPICS), F.lit("scaling_law"))
        .otherwise(F.lit("mechanism"))
    )


def atomic_novelty(c) -> Column:
    t = _col(c)
    return (
        F.when(t.rlike(R.ATOMIC_FAILURE), F.lit("failure_mode"))
        .when(t.rlike(R.CONDITIONAL) | t.rlike(R.ATOMIC_BOUNDARY), F.lit("boundary_condition"))
        .when(F.contains(F.lower(t), F.lit("scal")), F.lit("scaling_law"))
        .otherwise(F.lit("mechanism"))
    )


def is_valuable(c) -> Column:
    t = _col(c)
    return (
        t.rlike(R.NUMBER) | t.rlike(R.VALUE_SIGNAL) | t.rlike(R.CAUSAL) | t.rlike(R.COMPARISON)
        | (t.rlike(R.FUTURE) & t.rlike(R.ATOMIC_FUTURE_TERMS))
    )


def is_meaningful(c, lexicon: str = R.TECHNICAL) -> Column:
    """Ten words of four letters, or a term of the lexicon."""
    return (F.size(matches(c, R.LONG_WORD)) >= 10) | _col(c).rlike(lexicon)


def is_hedged(c, status=None) -> Column:
    """A statement worded as a view, or carrying a hedging status."""
    marker = F.lower(_col(c)).rlike(R.HEDGE)
    return marker | _col(status).isin(*R.HEDGE_STATUSES) if status is not None else marker


def best_sentence(c) -> Column:
    """Best sentence by non-consensus hit, boundary hit, number count, length, then position."""
    parts = sentences(c)
    keyed = F.transform(parts, lambda s, i: F.struct(
        s.rlike(R.NON_CONSENSUS).cast("int").alias("a"), s.rlike(R.BOUNDARY).cast("int").alias("b"),
        F.size(matches(s, R.NUMBER)).alias("n"), F.length(s).alias("l"), (-i).alias("p"), s.alias("s"),
    ))
    return F.coalesce(F.array_max(keyed).getField("s"), strip(c))


def agreement_band(score, has_a, has_b) -> Column:
    s, a, b = _col(score), _col(has_a), _col(has_b)
    return (
        F.when(a & ~b, F.lit("source_a_only")).when(b & ~a, F.lit("source_b_only"))
        .when(s.isNull(), F.lit("single_source")).when(s >= 0.85, F.lit("high"))
        .when(s >= 0.65, F.lit("medium")).otherwise(F.lit("low"))
    )
