"""Rule packs: fixed patterns and word lists, plus a neutral topic pack users replace with their own.

``(?U)`` makes ``\\b``, ``\\w``, ``\\d`` and ``\\s`` Unicode-aware in the JVM.
"""

from __future__ import annotations

# --- fixed values: token patterns of the structure-versus-text pack -------------------------
FUSED_NUMBER = r"(?iU)\d+(?:\.\d+)?(?:%|x)?"
FUSED_MODEL = r"(?iU)(?:GPT|Llama|DeepSeek|Claude|Gemini|H|A|B|o)\s*-?\s*\d[0-9A-Za-z.\-]*"
FUSED_WORD = r"[A-Za-z][A-Za-z0-9'\-]*"
FUSED_NEGATIONS = ["not", "no", "never", "cannot", "can't", "won't", "without"]
FUSED_STOPWORDS = ["the", "and", "from", "with", "under", "more", "into", "this", "that", "paper", "modeling"]

# --- fixed values: token patterns of the text-versus-text pack -------------------------------
NUMBER = r"(?iU)\b\d+(?:\.\d+)?(?:%|x|×)?\b"
NEGATION = r"(?iU)\b(?:not|no|never|cannot|can't|won't|without|fails?|failed|impossible)\b"
MODEL = (
    r"(?iU)\b(?:GPT[- ]?\w+|Llama[- ]?\w+|Claude[- ]?\w+|Gemini[- ]?\w+|DeepSeek[- ]?\w+|BGE[- ]?M3"
    r"|Diffusion[- ]?MPC|LeWorldModeling|PAC[- ]?Bayes)\b"
)
ENTITY = r"(?U)\b(?:[A-Z][A-Za-z0-9.-]+(?:\s+[A-Z][A-Za-z0-9().-]+){0,3})\b"
ENTITY_STOP = [
    "i", "the", "this", "that", "all", "and", "but", "so", "we", "you", "it", "um", "uh", "okay", "right", "cool",
    "today", "one", "two", "first", "then", "there", "here", "what", "when", "if", "as", "now", "basically", "obviously",
]
SENTENCE_BREAK = r"(?U)(?<=[.!?])\s+"
NON_CONSENSUS = (
    r"(?iU)\b(?:surprising|counterintuitive|contrary|instead|unlike|does not|do not|isn't|aren't|fails?|bottleneck"
    r"|limited by|only if|even when|rather than|not necessary|not enough)\b"
)
BOUNDARY = (
    r"(?iU)\b(?:depends? on|requires?|unless|only if|under infinite compute|data[- ]limited|compute[- ]limited"
    r"|verification|constraint|condition|trade[- ]?off)\b"
)
FAILURE = r"(?iU)fail|limitation|cannot|doesn't work|not work"

# --- fixed values: claim rules --------------------------------------------------------------
FUTURE = r"(?iU)\b(?:will|going to|expect|predict|future|may become|likely to)\b"
CAUSAL = r"(?iU)\b(?:because|causes?|leads? to|results? in|due to|drives?)\b"
CONDITIONAL = r"(?iU)\b(?:if|when|unless|only if|depends? on|under|condition)\b"
COMPARISON = r"(?iU)\b(?:better than|worse than|compared to|unlike|versus|more than|less than)\b"
QUESTION = r"(?U)\?\s*$"
VALUE_SIGNAL = (
    r"(?iU)\b(?:bottleneck|fail|failure|cannot|can't|unless|because|instead|better|worse|ensemble|compared"
    r"|counterintuitive|surprising|requires?|depends?|constraint|limited|overfit|faster|slower|efficiency"
    r"|improvement|downstream|IID)\b"
)
ATOMIC_SIGNALS = ["counterintuitive", "surprising", "instead", "not", "cannot", "can't", "bottleneck", "overfit"]
ATOMIC_FUTURE_TERMS = r"(?iU)\b(?:model|data|compute|training|inference|planning|scaling|verification|generalization)\b"
ATOMIC_FAILURE = r"(?iU)\b(?:fail|failure|cannot|can't|bottleneck|overfit|worse)\b"
ATOMIC_BOUNDARY = r"(?iU)\b(?:only|unless|requires?|constraint|limited)\b"

# --- fixed values: corpus claim rules, tried in this order ------------------------------------
CORPUS_TYPES = [
    ("normative_claim", r"(?U)\b(?:should|must|ought|have to)\b"),
    ("prediction", r"(?U)\b(?:will|going to|pretty soon|future)\b"),
    ("causal_claim", r"(?U)\b(?:because|therefore|so that|leads to|means that)\b"),
    ("conditional_conclusion", r"(?U)\b(?:if|unless|only when|as long as)\b"),
    ("comparison", r"(?U)\b(?:versus|compared|more than|less than|cheaper than)\b"),
    ("failure_mode", r"(?U)\b(?:failed|failure|bottleneck|can't|cannot|doesn't work|stuck)\b"),
    ("personal_experience", r"(?U)\b(?:i built|i learned|i used to|my observation|we built|we found)\b"),
    ("institutional_claim", r"(?U)\b(?:regulation|government|institution|faa)\b"),
]
CORPUS_NUMBER = (
    r"(?iU)\b\d+(?:\.\d+)?(?:x|%|\s*(?:percent|million|billion|trillion|years?|months?|weeks?|days?|hours?|minutes?))?\b"
)
CORPUS_NEGATION = (
    r"(?iU)\b(?:not|no|never|nothing|neither|nor|cannot|can't|won't|isn't|aren't|doesn't|don't|didn't|without|unless)\b"
)
CORPUS_NON_CONSENSUS = r"(?U)\b(?:controversial|everyone thinks|conventional|wrong|obsolete|dead)\b"
CORPUS_ROUTE_CHANGE = r"(?U)\b(?:change|shift|new kind|now|no longer|anymore)\b"
CORPUS_SENTENCE_BREAK = "(?U)(?<=[.!?])\\s+(?=[A-Z0-9\"“‘])"

# --- fixed values: speaker and span rules ----------------------------------------------------
LONG_WORD = r"[A-Za-z]{4,}"
TECHNICAL = (
    r"(?iU)\b(?:model|data|compute|training|inference|diffusion|world|scaling|verification|paper|algorithm|latent"
    r"|planning|PAC[- ]Bayes|generalization)\b"
)
TRANSITION = r"(?iU)\b(?:thank you|welcome|all right|okay|applause|music)\b"
UNIT_TOKEN = r"(?U)\b[A-Za-z0-9][A-Za-z0-9'_.%-]*\b"
UNIT_EVENT = r"(?i)\[(?:applause|audience applauding|clapping|laughter|laughs|music|on-hold music)\]"
CLAUSE_CONNECTIVE = r"(?iU)(?:,\s+|\s+)(?=(?:and|but|so|because|while|then|however|therefore)\b)"
CAPTION_TOKEN = r"\[[^\]]+\]|[A-Za-z0-9][A-Za-z0-9'_.%-]*"

SPEAKER_RANK = {
    "source_provided": 6, "audio_confirmed": 6, "section_inferred": 4, "probable": 3, "boundary_uncertain": 2, "unknown": 1,
}
AGREEMENT_CONFIDENCE = {
    "high": 0.9, "medium": 0.78, "mixed": 0.72, "conflict": 0.55, "source_a_only": 0.62, "source_b_only": 0.62,
    "single_source": 0.65,
}

# --- neutral defaults: a small topic pack over common function words of four languages ----------
DEFAULT_TOPICS = {
    "addition": [r"\band\b", r"\bund\b", r"\bet\b"],
    "condition": [r"\bif\b", r"\bwhen\b", r"\bunless\b"],
    "demonstrative": [r"\bthat\b", r"\bthis\b", r"\bque\b"],
    "origin": [r"\bfrom\b", r"\bvon\b", r"\bdes\b"],
    "scaling_law": [r"scal", r"\bdata\b"],
}
SCALING_TOPICS = ["scaling_law"]
DEFAULT_KEYWORDS = {
    "company": ["with ", " by "],
    "motion": [" to ", " zu "],
    "place": [" in ", " en "],
    "time": ["when", " was "],
}

# --- fixed values: hedging markers and statuses -----------------------------------------------
HEDGE = r"according to|argues that|suggests that|questions whether|may |might |could |待验证|认为|推测|可能"
HEDGE_STATUSES = ["hypothesis", "provisional"]

# --- fixed values: terms that turn or narrow a statement, and the local number pattern -----------
LOCAL_NUMBER = r"(?iU)(?<![\w.])\d+(?:\.\d+)?(?:%|x)?(?!\w)"
QUANTITY_WORDS = r"(?U)orders? of magnitude|\b(times|fold|percent(?:age)?)\b"
POLARITY_STEMS = ["declin", "decreas", "reduc", "abundan"]
POLARITY_WORDS = ["not", "no", "never", "without", "cannot", "can't", "less", "scarcity"]
POLARITY_PREFIXES = ["lack"]
EXTERNAL_TYPES = [
    "fact", "prediction", "causal_claim", "technical_mechanism", "engineering_constraint", "institutional_claim",
    "geopolitical_claim",
]
