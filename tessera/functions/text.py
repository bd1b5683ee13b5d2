"""Scalar functions on strings, dates, identifiers and hashes, as Column expressions.

All of them stay inside the JVM but ``repair_mojibake``, which needs an
all-or-nothing decoding that Spark has no function for. Null gives null unless
a docstring says otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Named entities that the cleaner knows.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&laquo;": "«", "&raquo;": "»", "&amp;": "&"}
# Two-letter prefixes of the federal criminal court's dockets.
CRIMINAL_PREFIXES = "BB BG BH BK BN BP CA CB CR RR SK SN SP TP".split()
# Words whose number tells German, French and Italian apart.
LANGUAGE_WORDS = {
    "de": "der die das ein eine einer er sie ihn hat hatte hätte ist war sind".split(),
    "fr": "le lui elle je on vous nous leur qui quand parce que faire sont vont".split(),
    "it": "della del di casi una al questa più primo grado che diritto leggi corte".split(),
}


def blank_to_null(c: Column) -> Column:
    """Null for null, blank and 'None'."""
    return F.when(~F.trim(c).isin("", "None"), c)


@F.pandas_udf(StringType())
def repair_mojibake(texts: pd.Series) -> pd.Series:
    """UTF-8 that was read as Latin-1, read aright; any text that can't be one stays as it is."""

    def one(t: str | None) -> str | None:
        if not t or "Ã" not in t:
            return t
        try:
            fixed = t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return t
        return fixed if len(fixed) <= len(t) else t

    return texts.map(one, na_action="ignore")


def clean_text(c: Column, mojibake: bool = False) -> Column:
    """Without control characters and tags, with entities read and blanks collapsed; line breaks stay."""
    out = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    out = F.regexp_replace(out, r"<[^<>]+>", " ")
    for entity, text in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(text))
    if mojibake:
        out = repair_mojibake(out)
    return F.trim(F.regexp_replace(out, r"[ \t]+", " "))


def dedup_signature(c: Column, read: int = 8000, keep: int = 4000) -> Column:
    """The ASCII letters and digits of the text's head, in lower case and without tags."""
    return F.substring(F.regexp_replace(F.lower(F.regexp_replace(F.substring(c, 1, read), r"<[^>]+>", " ")), r"[^a-z0-9]+", ""), 1, keep)


def whole_signature(c: Column) -> Column:
    """All letters and digits of a text without its tags, in lower case: what ``dedup_signature`` is the beginning of."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, "<[^>]+>", " ")), "[^a-z0-9]+", "")


def docket_spaces(c: Column) -> Column:
    """Line breaks, tabs and runs of spaces as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"[\n\r\t ]+", " "))


def with_host(url: Column, host: Column) -> Column:
    """A URL without scheme behind its host."""
    return F.when(url.startswith("http"), url).when(F.trim(url) == "", url).otherwise(F.concat(host, F.when(url.startswith("/"), url).otherwise(F.concat(F.lit("/"), url))))


def sane_date(c: Column, as_of: str) -> Column:
    """Null for years 0000, ISO dates before 1700 and more than a year after ``as_of``; other strings as they are."""
    iso = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    last = F.date_format(F.date_add(F.lit(as_of).cast("date"), 365), "yyyy-MM-dd")
    return F.when(c.startswith("0000") | (iso & ((c < "1700-01-01") | (c > last))), None).otherwise(c)


def not_before(published: Column, decided: Column, days: int = 31) -> Column:
    """``published`` unless it lies more than ``days`` before ``decided``."""
    return F.when(F.datediff(published.try_cast("date"), decided.try_cast("date")) < -days, None).otherwise(published)


def docket_year(c: Column) -> Column:
    """The registration year at a docket's end, or after its series; null for none in 1800-2100."""
    year = F.coalesce(F.nullif(F.regexp_extract(c, r"[/_. ](\d{4})$", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"^[A-Z]{1,6}[._ ](\d{4})[._ ]", 1), F.lit(""))).cast("int")
    return F.when(year.between(1800, 2100), year)


def synthetic_date(c: Column) -> Column:
    """True for null, blank and first-of-January dates."""
    return F.coalesce((c == "") | c.endswith("-01-01"), F.lit(True))


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts, null as empty."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def joined_hash(*parts: Column) -> Column:
    """SHA-256 of the parts with bars between them, null as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def canonical_key(court: Column, docket: Column, date: Column) -> Column:
    """court|DOCKET|yyyymmdd; the series' prefix is dropped for its own court."""
    bare = F.regexp_replace(F.upper(F.coalesce(docket, F.lit(""))), r"[^A-Z0-9]", "")
    bare = F.when(court == "bge", F.regexp_replace(bare, r"^(?:CH)?(?:BGE|ATF|DTF)", "")).otherwise(bare)
    return F.concat_ws("|", court, bare, F.substring(F.regexp_replace(F.coalesce(date, F.lit("")), "-", ""), 1, 8))


def id_docket(c: Column) -> Column:
    """The docket as part of an id: slashes as underscores."""
    return F.regexp_replace(F.trim(c), r"[/\\]", "_")


def graph_docket(c: Column) -> Column:
    """The docket as the graph's key: the series with single blanks, all else with underscores."""
    raw = F.upper(F.trim(c))
    series = r"^(BGE|ATF|DTF)\s+(\d{1,3})\s+([IVX]{1,4})\s+(\d{1,4})$"
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"[-./ ]", "_"), r"_+", "_"), r"^_|_$", "")
    return F.when(raw.rlike(series), F.regexp_replace(raw, r"\s+", " ")).when(out.rlike(r"^\d{1,3}_[IVX]{1,4}_\d{1,4}$"), F.replace(out, F.lit("_"), F.lit(" "))).otherwise(F.coalesce(out, F.lit("")))


def token_docket(c: Column) -> Column:
    """The docket as extracted from a text: as ``graph_docket``, but inner blanks stay."""
    raw = F.upper(F.trim(c))
    bare = F.regexp_replace(raw, r"\s+", " ")
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"[-./]", "_"), r"_+", "_"), r"^_|_$", "")
    return F.when(bare.rlike(r"^\d{1,3} [IVX]{1,4} \d{1,4}$"), bare).otherwise(out)


def docket_key(c: Column) -> Column:
    """The federal form 1B_243/2022 within ``c``, or null."""
    found = F.regexp_extract(F.upper(c), r"(\d[A-Z])[_. ](\d{1,5})/(\d{4})", 0)
    return F.when(found != "", F.regexp_replace(found, r"[. ]", "_"))


def reference_tokens(c: Column) -> Column:
    """A key in which separators make no difference: bge:v:d:p or d:a:b:c for exactly three tokens, else null."""
    tokens = F.filter(F.split(F.regexp_replace(F.upper(c), r"^(?:BGE|ATF|DTF)[^A-Z0-9]+", ""), r"[^A-Z0-9]+"), lambda t: t != "")
    key = F.concat_ws(":", tokens)
    return F.when(F.size(tokens) != 3, None).when(key.rlike(r"^\d{1,3}:[IVX]{1,4}:\d{1,4}$"), F.concat(F.lit("bge:"), key)).otherwise(F.concat(F.lit("d:"), key))


def court_of_docket(c: Column) -> Column:
    """The federal court that a normalised docket's form tells, or null."""
    return F.when(c.rlike(r"^[1-9][A-Z]_\d"), "bger").when(c.rlike(r"^[A-F]_\d{1,6}_\d{4}$"), "bvger").when(c.rlike(rf"^(?:{'|'.join(CRIMINAL_PREFIXES)})_"), "bstger")


def citation_confidence(source: dict[str, Column], target: dict[str, Column], ref: Column, rank: Column, count: Column) -> Column:
    """Confidence in 0.05-0.99 that a reference means a target; ``source`` and ``target`` have court, canton, date."""
    told = court_of_docket(ref)
    iso = lambda x: F.when(F.trim(x).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(x).try_cast("date"))
    days = F.datediff(iso(source["date"]), iso(target["date"]))
    nothing = F.lit(0.0)

    def same(a: Column, b: Column, worth: float) -> Column:
        return F.when((a != "") & (a == b), F.lit(worth)).otherwise(nothing)

    score = (
        F.lit(0.55)
        + F.when(told.isNotNull() & (target["court"] != ""), F.when(told == target["court"], F.lit(0.20)).otherwise(F.lit(-0.20))).otherwise(nothing)
        + same(source["canton"], target["canton"], 0.10)
        + same(source["court"], target["court"], 0.08)
        + F.when(days >= 0, F.lit(0.15)).when(days < 0, F.lit(-0.15)).otherwise(nothing)
        + F.when(F.abs(days) <= 365, F.lit(0.10)).when(F.abs(days) <= 3 * 365, F.lit(0.05)).otherwise(nothing)
        + F.when(rank == 1, F.lit(0.05)).when(rank == 2, F.lit(0.02)).otherwise(nothing)
        - F.when(count > 1, F.least(F.lit(0.15), 0.03 * (count - 1))).otherwise(nothing)
    )
    return F.greatest(F.lit(0.05), F.least(F.lit(0.99), F.round(score, 4)))


def language_of(c: Column, read: int = 5000) -> Column:
    """de, fr or it by the number of common words in the head; ties in this order; de for a text without any."""
    head = F.substring(c, 1, read)
    counts = [(code, F.size(F.regexp_extract_all(head, F.lit(rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}_])"), F.lit(0)))) for code, words in LANGUAGE_WORDS.items()]
    most = F.greatest(*[n for _, n in counts])
    out = F.lit(None).cast("string")
    for code, n in reversed(counts):
        out = F.when(n == most, F.lit(code)).otherwise(out)
    return F.when(c.isNotNull(), out)


def iso_week(c: Column) -> Column:
    """YYYY-Www."""
    return F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), c), F.weekofyear(c))


def window_key(c: Column, grain: str) -> Column:
    """The month or ISO week of a time."""
    return F.date_format(c, "yyyy-MM") if grain == "month" else iso_week(c)


def clip(c: Column, width: int = 220) -> Column:
    """Blanks collapsed, cut to ``width`` with an ellipsis."""
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(flat) > width, F.concat(F.rtrim(F.substring(flat, 1, width - 1)), F.lit("…"))).otherwise(flat)


def xml_legal(c: Column) -> Column:
    """Without characters that XML forbids."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "")


def snippet(c: Column, word: Column, before: int = 100, after: int = 200) -> Column:
    """The surroundings of the first occurrence of ``word``, else the head."""
    at = F.instr(F.lower(c), F.lower(word))
    start = F.when(at > 0, F.greatest(F.lit(1), at - before)).otherwise(F.lit(1))
    piece = F.substring(c, start, F.lit(before + after))
    return F.concat(F.when(start > 1, F.lit("...")).otherwise(F.lit("")), piece, F.when(start + before + after <= F.length(c), F.lit("...")).otherwise(F.lit("")))


def cohort(ip: Column, time: Column, agent: Column | None = None) -> Column:
    """Eight digits that tell visitors of a month apart, by address and, if given, agent."""
    return F.substring(F.sha2(F.concat_ws("|", *[x for x in (ip, agent) if x is not None], F.date_format(time, "yyyy-MM")), 256), 1, 8)


# Kinds of visitors by their agents; the first that fits counts.
AGENTS = [
    ("ai_crawler", r"gptbot|chatgpt|oai-searchbot|claudebot|claude-web|anthropic|perplexity|ccbot|bytespider|google-extended|amazonbot|applebot-extended|meta-externalagent|cohere-ai|diffbot"),
    ("search_engine", r"googlebot|bingbot|duckduckbot|yandex|baiduspider|applebot|seznambot|qwant|petalbot"),
    ("seo", r"ahrefs|semrush|mj12bot|dotbot|blexbot|dataforseo"), ("monitor", r"uptimerobot|pingdom|statuscake|zabbix|nagios|healthcheck"), ("script", r"curl|wget|python|aiohttp|httpx|go-http|okhttp|axios|node-fetch|java/|libwww|postman"),
    ("mcp_client", r"mcp|modelcontextprotocol"), ("headless", r"headless|phantomjs|puppeteer|playwright|selenium"), ("bot", r"bot\b|crawler|spider|slurp"), ("mobile", r"iphone|android|mobile"), ("browser", r"mozilla|opera|safari|firefox|chrome|edg/"),
]


def agent_class(agent: Column) -> Column:
    """The kind of visitor that an agent's name tells; none for null or blank, other for any that fits nothing."""
    low = F.lower(agent)
    return F.when(F.trim(F.coalesce(agent, F.lit(""))) == "", "none").otherwise(F.coalesce(*[F.when(low.rlike(p), F.lit(n)) for n, p in AGENTS], F.lit("other")))


def stable_id(c: Column) -> Column:
    """A 48-bit number from a name."""
    return F.conv(F.substring(F.sha1(c), 1, 12), 16, 10).cast("bigint")


def status_bucket(c: Column) -> Column:
    """2xx, 3xx, 404, 429, 4xx, 5xx or other."""
    return F.when(c.between(200, 299), "2xx").when(c.between(300, 399), "3xx").when(c == 404, "404").when(c == 429, "429").when(c.between(400, 499), "4xx").when(c.between(500, 599), "5xx").otherwise("other")


def as_boolean(c: Column) -> Column:
    """1, true, t and yes are true, null and blank stay null, all else is false."""
    return F.when(c.isNull() | (c == ""), None).otherwise(F.lower(F.trim(c)).isin("1", "true", "t", "yes"))


def level(court: Column, canton: Column) -> Column:
    """federal or cantonal; an unknown court is federal without a canton and cantonal with any, 'CH' included."""
    return F.when(court.isin("bger", "bvger", "bstger", "bpatger", "bge", "emark"), "federal").when(F.coalesce(canton, F.lit("")) == "", "federal").otherwise("cantonal")


def ecli(court: Column, year: Column, docket: Column) -> Column:
    """ECLI:CH:<court>:<year>:<id>; null without a year."""
    return F.when(year.isNotNull(), F.concat_ws(":", F.lit("ECLI:CH"), F.upper(F.regexp_replace(court, "[^A-Za-z0-9]", "")), year.cast("string"), F.upper(F.regexp_replace(docket, r"[^A-Za-z0-9]+", "."))))


def national_id(court: Column, docket: Column) -> Column:
    """cli:ch:<court>:<docket>."""
    return F.concat(F.lit("cli:ch:"), F.lower(court), F.lit(":"), F.regexp_replace(F.lower(F.trim(docket)), r"[^a-z0-9]+", "-"))


def parse_national_id(c: Column) -> Column:
    """struct<court, docket, version, language, pinpoint>; null for any other string."""
    pattern = r"^cli:ch:([a-z_]+):([a-z0-9-]+)(?:@(\d+))?(?:\?lang=([a-z]{2}))?(?:#(.+))?$"
    part = lambda i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    return F.when(c.rlike(pattern), F.struct(part(1).alias("court"), part(2).alias("docket"), part(3).alias("version"), part(4).alias("language"), part(5).alias("pinpoint")))


def wilson(good: Column, n: Column, z: float = 1.96) -> Column:
    """struct<low, high> of Wilson's interval; null without observations."""
    p, zz = good / n, z * z
    middle = (p + zz / (2 * n)) / (1 + zz / n)
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return F.when(n > 0, F.struct((middle - half).alias("low"), (middle + half).alias("high")))
