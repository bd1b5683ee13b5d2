"""A registry of data-quality checks and gates.

A check is a filter or an aggregate with a threshold. All checks over the same
table share one scan: their conditions become columns of one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL, WARNING, INFO = "critical", "warning", "info"


@dataclass(frozen=True)
class Check:
    """``metric`` is an aggregate; it passes if it lies within [low, high]."""

    name: str
    metric: Column
    high: float | None = None
    low: float | None = None
    severity: str = WARNING


def run(df: DataFrame, checks: list[Check], by: str | None = None) -> DataFrame:
    """check, [by,] severity, metric, low, high, passed: one row for each check (and group).

    All checks share one scan. A check that can't be worked out on ``df`` is a
    critical failure without a metric; the others are run all the same.
    """
    keys = [by] if by else []
    good, broken = [], []
    for k in checks:
        try:
            df.agg(k.metric.cast("double")).schema  # noqa: B018
            good.append(k)
        except AnalysisException:
            broken.append(k)
    told = lambda k, severity, metric: F.struct(F.lit(k.name).alias("check"), F.lit(severity).alias("severity"), metric.alias("metric"), F.lit(k.low).cast("double").alias("low"), F.lit(k.high).cast("double").alias("high"))
    wide = df.groupBy(*keys).agg(F.lit(1).alias("_"), *[k.metric.cast("double").alias(k.name) for k in good])
    rows = F.array(*[told(k, k.severity, F.col(k.name)) for k in good], *[told(k, CRITICAL, F.lit(None).cast("double")) for k in broken])
    long = wide.select(*keys, F.explode(rows).alias("r")).select("r.check", *keys, "r.severity", "r.metric", "r.low", "r.high")
    inside = F.coalesce(F.col("metric") <= F.col("high"), F.lit(True)) & F.coalesce(F.col("metric") >= F.col("low"), F.lit(True))
    return long.withColumn("passed", inside & F.col("metric").isNotNull())


#: Groups of checks by name, filled by ``group_of_checks``.
GROUPS: dict[str, Callable[..., list[Check]]] = {}


def group_of_checks(f: Callable[..., list[Check]]) -> Callable[..., list[Check]]:
    """Makes a function that gives checks known under its name."""
    GROUPS[f.__name__] = f
    return f


def discovered(group: str, as_of: str = "2024-12-31", critical_only: bool = False) -> list[Check]:
    """The checks of a group; with ``critical_only`` the critical ones."""
    f = GROUPS[group]
    checks = f(as_of) if f.__code__.co_argcount else f()
    return [k for k in checks if k.severity == CRITICAL or not critical_only]


def safe_to_publish(report: DataFrame) -> bool:
    """True if no critical check failed."""
    return report.where((F.col("severity") == CRITICAL) & ~F.col("passed")).isEmpty()


def row_gate(new: int, live: int, fraction: float = 0.95) -> bool:
    """False if the new snapshot has shrunk below ``fraction`` of the live one; an empty live one lets anything through."""
    return live == 0 or new >= fraction * live


def group_gate(new: DataFrame, live: DataFrame, by: str, fraction: float = 0.8, least: int = 500) -> DataFrame:
    """by, live, new of the groups with at least ``least`` live rows that fall below ``fraction``."""
    a = live.groupBy(by).agg(F.count("*").alias("live")).where(F.col("live") >= least)
    b = new.groupBy(by).agg(F.count("*").alias("new"))
    return a.join(b, by, "left").withColumn("new", F.coalesce("new", F.lit(0))).where(F.col("new") < fraction * F.col("live"))


def _empty(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@group_of_checks
def decision_checks(as_of: str) -> list[Check]:
    """The checks of the decisions table; counts unless a name ends in _pct."""
    n, c = F.count_if, F.col
    date = F.coalesce("decision_date", F.lit(""))
    iso = date.rlike(ISO)
    share = lambda x: F.count_if(x) * 100.0 / F.count("*")
    text = F.coalesce("full_text", F.lit(""))
    reg = F.coalesce("regeste", F.lit(""))
    limit = F.date_format(F.date_add(F.lit(as_of).cast("date"), 365), "yyyy-MM-dd")
    return [
        Check("no_null_or_empty_court", n(_empty("court")), 0, severity=CRITICAL),
        Check("canonical_court_code", n(~F.coalesce(c("court").rlike("^[a-z0-9_]+$"), F.lit(False))), 0),
        Check("required_columns_not_null", n(c("decision_id").isNull() | c("court").isNull()), 0, severity=CRITICAL),
        Check("decision_id_uniqueness", F.count("*") - F.countDistinct("decision_id"), 0, severity=CRITICAL),
        Check("corpus_total_count", F.count("*"), low=1, severity=CRITICAL),
        Check("canton_field_consistency", n(c("court").rlike("^[a-z]{2}_") & (F.upper(F.substring("court", 1, 2)) != F.coalesce("canton", F.lit("")))), 0),
        Check("year_0000_dates", n(date.startswith("0000")), 0, severity=CRITICAL),
        Check("far_future_dates", n(iso & (date > limit)), 0),
        Check("future_dates_window", n(iso & (date > F.lit(as_of)) & (date <= limit)), 50),
        Check("pre_1700_dates", n(iso & (date < "1700-01-01") & ~date.startswith("0000")), 0),
        Check("invalid_date_format", n((date != "") & ~iso), 0),
        Check("total_null_dates", n(date == ""), 200),
        Check("publication_before_decision", n(iso & F.coalesce(c("publication_date").rlike(ISO), F.lit(False)) & (c("publication_date") < date)), 0),
        Check("docket_year_plausibility", n(iso & (F.regexp_extract("docket_number", r"/(\d{4})$", 1) != "") & (F.substring(date, 1, 4).try_cast("int") < F.regexp_extract("docket_number", r"/(\d{4})$", 1).try_cast("int") - 1)), 0),
        Check("whitespace_in_docket", n(c("docket_number") != F.trim("docket_number")), 0),
        Check("internal_newlines_in_docket", n(c("docket_number").contains("\n")), 0),
        Check("empty_docket_pct", share(_empty("docket_number")), 5),
        Check("excessively_long_docket", n(F.length("docket_number") > 50), 0),
        Check("unexpected_language_values", n(c("language").isNotNull() & ~c("language").isin("de", "fr", "it", "rm")), 0),
        Check("null_language_pct", share(c("language").isNull()), 0.5),
        Check("german_share_pct", share(c("language") == "de"), 70, 20),
        Check("regeste_present_pct", share(F.trim(reg) != ""), low=1),
        Check("regeste_excessive_length", n(F.length(reg) > 5000), 0),
        Check("regeste_too_short", n(F.length(reg).between(1, 19)), 100),
        Check("short_full_text", n(F.length(text) < 500), 100),
        Check("short_text_floor", n(F.length(text).between(1, 499)), 64),
        Check("control_chars", n(text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")), 0),
        Check("extraction_artefacts", n(text.rlike(r"\(cid:\d+\)|�{3,}|<[a-z]+ [a-z]+=")), 0),
        Check("excessive_whitespace_ratio", n((F.length(text) > 1000) & (F.length(text) - F.length(F.regexp_replace(text, r"\s+", "")) > 0.25 * F.length(text))), 0),
        Check("no_relative_source_urls", n(~_empty("source_url") & ~c("source_url").rlike("^https?://")), 0),
        Check("http_source_urls", n(c("source_url").startswith("http://")), 0, severity=INFO),
        Check("decision_id_url_safe", n(c("decision_id").rlike(r"[^A-Za-z0-9_.\-/]")), 0),
        Check("decision_id_has_whitespace", n(c("decision_id").rlike(r"\s")), 0),
        Check("text_length_agrees", n(F.coalesce("text_length", F.lit(0)) != F.length(text)), 0, severity=INFO),
    ]


@group_of_checks
def graph_checks() -> list[Check]:
    """The checks of the citation table."""
    c = F.col
    return [
        Check("total_edge_count", F.count("*"), low=1, severity=CRITICAL),
        Check("blank_references", F.count_if(F.coalesce(F.trim("target_ref"), F.lit("")) == ""), 0),
        Check("untyped_references", F.count_if(c("target_type").isNull()), 0),
        Check("repeated_edges", F.count("*") - F.countDistinct(F.struct("source_decision_id", "target_ref")), 0),
        Check("top_cited", F.count_if(c("target_ref") == "BGE 111 I 14"), low=1),
    ]
