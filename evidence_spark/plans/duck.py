"""Fragments of DuckDB SQL shared by the checks.

The engine's regex dialect has ASCII word boundaries and no look-behind. ``plain`` therefore turns
every non-ASCII letter into an underscore (a word character that no pattern uses) and every other
non-ASCII character into a space, after which ASCII boundaries are exact.
"""

from __future__ import annotations

from evidence_spark.functions import rules as R

WS = r"[\s\x0b\x85\p{Z}]"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    """A JVM pattern in the other dialect: only the flags differ."""
    if pattern.startswith("(?iU)"):
        pattern = "(?i)" + pattern[5:]
    elif pattern.startswith("(?U)"):
        pattern = pattern[4:]
    return quote(pattern)


def plain(c: str) -> str:
    return (f"regexp_replace(regexp_replace({c}, '[^\\x00-\\x7F\\p{{L}}\\p{{N}}\\p{{M}}×]', ' ', 'g'), "
            f"'[^\\x00-\\x7F×]', '_', 'g')")


def norm(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sentences(c: str) -> str:
    cut = f"string_split(regexp_replace({c}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({cut}, lambda s: {strip('s')}), lambda s: length(s) > 0)"


def found(c: str, pattern: str) -> str:
    return f"regexp_extract_all({plain(c)}, {re2(pattern)})"


def has(c: str, pattern: str) -> str:
    return f"regexp_matches({plain(c)}, {re2(pattern)})"


def lowset(c: str) -> str:
    return f"list_sort(list_distinct(list_transform({c}, lambda x: lower(x))))"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def numbers(c: str) -> str:
    return lowset(found(c, R.NUMBER))


def negations(c: str) -> str:
    return lowset(found(c, R.NEGATION))


def models(c: str) -> str:
    return lowset(found(c, R.MODEL))


def entities(c: str) -> str:
    kept = (f"list_filter({found(c, R.ENTITY)}, lambda x: lower(x) NOT IN {in_list(R.ENTITY_STOP)} "
            f"AND regexp_matches(x, '(?s)\\s|^.+[A-Z]|[0-9]|[-.]'))")
    return lowset(kept)


def fused_numbers(c: str) -> str:
    return lowset(f"regexp_extract_all({c}, {re2(R.FUSED_NUMBER)})")


def fused_models(c: str) -> str:
    return f"list_sort(list_distinct(list_transform(regexp_extract_all({c}, {re2(R.FUSED_MODEL)}), lambda x: {norm('x')})))"


def fused_negations(c: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({c}, {re2(R.FUSED_WORD)}), "
            f"lambda x: lower(x)), lambda x: x IN {in_list(R.FUSED_NEGATIONS)})))")


def differ(a: str, b: str) -> str:
    return f"({a}) <> ({b})"


def topics(c: str, pack=None) -> str:
    pack = pack or R.DEFAULT_TOPICS
    cases = []
    for topic, patterns in pack.items():
        joined = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
        cases.append(f"CASE WHEN regexp_matches({plain(c)}, {quote(joined)}) THEN {quote(topic)} END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def keywords(c: str, pack=None) -> str:
    pack = pack or R.DEFAULT_KEYWORDS
    cases = []
    for theme, terms in pack.items():
        hit = " OR ".join(f"contains(' ' || lower({c}) || ' ', {quote(t)})" for t in terms)
        cases.append(f"CASE WHEN {hit} THEN {quote(theme)} END")
    return f"list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"


def atomic_novelty(c: str) -> str:
    return (f"CASE WHEN {has(c, R.ATOMIC_FAILURE)} THEN 'failure_mode' "
            f"WHEN {has(c, R.CONDITIONAL)} OR {has(c, R.ATOMIC_BOUNDARY)} THEN 'boundary_condition' "
            f"WHEN contains(lower({c}), 'scal') THEN 'scaling_law' ELSE 'mechanism' END")


def claim_type(c: str, nov: str) -> str:
    return (f"CASE WHEN {nov} = 'failure_mode' THEN 'failure_mode' "
            f"WHEN regexp_matches({c}, '\\?{WS}*$') THEN 'open_question' "
            f"WHEN {has(c, R.FUTURE)} THEN 'prediction' WHEN {has(c, R.CAUSAL)} THEN 'causal_claim' "
            f"WHEN {has(c, R.CONDITIONAL)} THEN 'conditional_conclusion' WHEN {has(c, R.COMPARISON)} THEN 'comparison' "
            f"WHEN {nov} = 'boundary_condition' THEN 'engineering_constraint' ELSE 'technical_mechanism' END")


def corpus_type(c: str) -> str:
    whens = " ".join(f"WHEN {has(f'lower({c})', p)} THEN {quote(n)}" for n, p in R.CORPUS_TYPES)
    return f"CASE WHEN {strip(c)} LIKE '%?' THEN 'open_question' {whens} ELSE 'opinion' END"


def joined(c: str) -> str:
    return f"coalesce(array_to_string({c}, '|'), '')"
