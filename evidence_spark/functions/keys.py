"""Identity expressions: time stamps, content ids, media keys, deep links and redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: hosts that share one video key
SHORT_HOSTS = ["youtu.be", "www.youtu.be"]
VIDEO_HOSTS = ["youtube.com", "www.youtube.com", "m.youtube.com", "music.youtube.com"]
VIDEO_ID = r"^[A-Za-z0-9_-]{6,}$"
SENSITIVE_NAMES = ["token", "secret", "password", "authorization", "cookie"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_seconds(c) -> Column:
    """``m:ss(.f)`` or ``h:mm:ss(.f)`` to seconds; NULL for anything else."""
    parts = F.split(F.regexp_replace(F.trim(_col(c)), ",", "."), ":")
    n = F.size(parts)

    def at(i):
        return F.get(parts, F.lit(i)).try_cast("double")

    return F.when(n == 2, at(0) * 60 + at(1)).when(n == 3, at(0) * 3600 + at(1) * 60 + at(2))


def epoch(c) -> Column:
    """Seconds since 1970 of a timestamp's wall clock, whatever the session time zone."""
    t = _col(c)
    return (F.unix_date(t.cast("date")) * F.lit(86400.0) + F.hour(t) * 3600 + F.minute(t) * 60
            + F.extract(F.lit("SECOND"), t).cast("double"))


def to_stamp(c) -> Column:
    """Seconds to ``mm:ss``, or ``hh:mm:ss`` from one hour on."""
    total = F.floor(_col(c)).cast("long")
    h, m, s = F.floor(total / 3600).cast("long"), F.floor((total % 3600) / 60).cast("long"), total % 60
    return F.when(h > 0, F.format_string("%02d:%02d:%02d", h, m, s)).otherwise(F.format_string("%02d:%02d", m, s))


def deep_link(url, seconds) -> Column:
    u = _col(url)
    sep = F.when(F.contains(u, F.lit("?")), F.lit("&t=")).otherwise(F.lit("?t="))
    return F.concat(u, sep, F.floor(_col(seconds)).cast("long").cast("string"), F.lit("s"))


def stable_id(prefix: str, *cols) -> Column:
    """``prefix_`` and the first 16 hex digits of SHA-256 over the pipe-joined values."""
    joined = F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("None")) for c in cols])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 16))


def content_hash(c) -> Column:
    return F.sha2(_col(c), 256)


def short_quote(c, limit: int = 360) -> Column:
    """Whitespace squeezed and, beyond the limit, cut at a word boundary with an ellipsis."""
    from evidence_spark.functions.text import squeeze

    t = squeeze(c)
    head = F.substring(t, 1, limit)
    at_word = F.when(F.contains(head, F.lit(" ")), F.regexp_replace(head, r"(?s) [^ ]*$", "")).otherwise(head)
    clipped = F.concat(F.regexp_replace(at_word, r"[.,;:!? ]+$", ""), F.lit("…"))
    return F.when(F.length(t) <= limit, t).otherwise(clipped)


def media_key(url) -> Column:
    """One key per recording or page; NULL for anything that is not http(s) or has a bad video id."""
    u = F.trim(_col(url))
    web = u.rlike(r"^(?i)https?://")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^(?i)https?://([^/?#]*)", 1)), ":.*$", "")
    path = F.regexp_extract(u, r"^(?i)https?://[^/?#]*([^?#]*)", 1)
    short_id = F.regexp_extract(path, r"^/*([^/]*)", 1)
    watch_id = F.when(path == "/watch", F.regexp_extract(u, r"[?&]v=([^&#]*)", 1))
    clip_id = F.regexp_extract(path, r"^/(?:shorts|embed)/([^&]*)", 1)
    video = F.when(host.isin(*SHORT_HOSTS), short_id).when(
        host.isin(*VIDEO_HOSTS), F.coalesce(watch_id, clip_id)
    )
    slug = F.regexp_replace(F.regexp_replace(F.lower(path), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    page = F.concat(F.lit("web_"), host, F.lit("_"), F.when(slug == "", F.lit("page")).otherwise(slug))
    return F.when(~web, F.lit(None)).when(
        host.isin(*SHORT_HOSTS, *VIDEO_HOSTS), F.when(video.rlike(VIDEO_ID), F.concat(F.lit("yt_"), video))
    ).otherwise(page)


def safe_url(c) -> Column:
    """Drop the fragment and every query parameter except the first ``v``."""
    u = _col(c)
    base = F.regexp_replace(u, r"(?s)[?#].*$", "")
    v = F.regexp_extract(F.regexp_replace(u, r"(?s)#.*$", ""), r"[?&]v=([^&]+)", 1)
    return F.when(v != "", F.concat(base, F.lit("?v="), v)).otherwise(base)


# fixed values: what is masked inside free text
URL_QUERY_IN_TEXT = r"(https?://[^\s\]\[()<>\"'?#]*)(?:\?(?:[^\s\]\[()<>\"'#]*&)?(v=[^\s\]\[()<>\"'&#]+)[^\s\]\[()<>\"']*|[?#][^\s\]\[()<>\"']*)"
CREDENTIAL_IN_TEXT = r"(?iU)\b(token|secret|password|api[_-]?key|authorization)=([^\s&]+)"
BEARER_IN_TEXT = r"(?iU)\bBearer\s+[A-Za-z0-9._~+/-]+"


def safe_text(c) -> Column:
    """Strip URL queries inside text (keeping ``v``) and mask credentials and bearer tokens."""
    t = F.regexp_replace(_col(c), URL_QUERY_IN_TEXT, "$1<q>$2")
    t = F.regexp_replace(t, r"<q>(?=v=)", "?")
    t = F.regexp_replace(t, r"<q>", "")
    t = F.regexp_replace(t, CREDENTIAL_IN_TEXT, "$1=<redacted>")
    return F.regexp_replace(t, BEARER_IN_TEXT, "Bearer <redacted>")


def redact(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mask string columns by name and by content: sensitive names, ``*url`` columns, then text."""
    out = []
    for field in df.schema.fields:
        name, low = field.name, field.name.lower()
        if cols is not None and name not in cols:
            out.append(F.col(name))
        elif any(word in low for word in SENSITIVE_NAMES):
            out.append(F.lit("<redacted>").alias(name))
        elif isinstance(field.dataType, T.StringType):
            c = F.col(name)
            value = safe_url(c) if low.endswith("url") else F.when(c.rlike("^https?://"), safe_url(c)).otherwise(safe_text(c))
            out.append(value.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
