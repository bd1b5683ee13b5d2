"""Queries of the quality checks and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.registry import Registry
from tessera.sources.tables import table

R = Registry()
c = F.col
_ISO = "regexp_matches(coalesce(decision_date, ''), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')"
_METRICS = {
    "no_null_or_empty_court": "count(*) FILTER (WHERE coalesce(trim(court), '') = '')",
    "canonical_court_code": "count(*) FILTER (WHERE NOT coalesce(regexp_matches(court, '^[a-z0-9_]+$'), false))",
    "required_columns_not_null": "count(*) FILTER (WHERE decision_id IS NULL OR court IS NULL)",
    "decision_id_uniqueness": "count(*) - count(DISTINCT decision_id)",
    "corpus_total_count": "count(*)",
    "canton_field_consistency": "count(*) FILTER (WHERE regexp_matches(court, '^[a-z]{2}_') AND upper(left(court, 2)) <> coalesce(canton, ''))",
    "year_0000_dates": "count(*) FILTER (WHERE starts_with(decision_date, '0000'))",
    "far_future_dates": f"count(*) FILTER (WHERE {_ISO} AND decision_date > '2025-12-31')",
    "future_dates_window": f"count(*) FILTER (WHERE {_ISO} AND decision_date > '2024-12-31' AND decision_date <= '2025-12-31')",
    "pre_1700_dates": f"count(*) FILTER (WHERE {_ISO} AND decision_date < '1700-01-01' AND NOT starts_with(decision_date, '0000'))",
    "invalid_date_format": f"count(*) FILTER (WHERE coalesce(decision_date, '') <> '' AND NOT {_ISO})",
    "total_null_dates": "count(*) FILTER (WHERE coalesce(decision_date, '') = '')",
    "publication_before_decision": f"count(*) FILTER (WHERE {_ISO} AND regexp_matches(publication_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND publication_date < decision_date)",
    "docket_year_plausibility": rf"count(*) FILTER (WHERE {_ISO} AND regexp_extract(docket_number, '/(\d{{4}})$', 1) <> '' AND try_cast(left(decision_date, 4) AS INT) < try_cast(regexp_extract(docket_number, '/(\d{{4}})$', 1) AS INT) - 1)",
    "whitespace_in_docket": "count(*) FILTER (WHERE docket_number <> trim(docket_number))",
    "internal_newlines_in_docket": "count(*) FILTER (WHERE contains(docket_number, chr(10)))",
    "empty_docket_pct": "count(*) FILTER (WHERE coalesce(trim(docket_number), '') = '') * 100.0 / count(*)",
    "excessively_long_docket": "count(*) FILTER (WHERE length(docket_number) > 50)",
    "unexpected_language_values": "count(*) FILTER (WHERE language IS NOT NULL AND language NOT IN ('de', 'fr', 'it', 'rm'))",
    "null_language_pct": "count(*) FILTER (WHERE language IS NULL) * 100.0 / count(*)",
    "german_share_pct": "count(*) FILTER (WHERE language = 'de') * 100.0 / count(*)",
    "regeste_present_pct": "count(*) FILTER (WHERE trim(coalesce(regeste, '')) <> '') * 100.0 / count(*)",
    "regeste_excessive_length": "count(*) FILTER (WHERE length(regeste) > 5000)",
    "regeste_too_short": "count(*) FILTER (WHERE length(regeste) BETWEEN 1 AND 19)",
    "short_full_text": "count(*) FILTER (WHERE length(coalesce(full_text, '')) < 500)",
    "short_text_floor": "count(*) FILTER (WHERE length(full_text) BETWEEN 1 AND 499)",
    "control_chars": r"count(*) FILTER (WHERE regexp_matches(full_text, '[\x00-\x08\x0b\x0c\x0e-\x1f]'))",
    "extraction_artefacts": r"count(*) FILTER (WHERE regexp_matches(full_text, '\(cid:\d+\)|�{3,}|<[a-z]+ [a-z]+='))",
    "excessive_whitespace_ratio": r"count(*) FILTER (WHERE length(full_text) > 1000 AND length(full_text) - length(regexp_replace(full_text, '\s+', '', 'g')) > 0.25 * length(full_text))",
    "no_relative_source_urls": "count(*) FILTER (WHERE coalesce(trim(source_url), '') <> '' AND NOT regexp_matches(source_url, '^https?://'))",
    "http_source_urls": "count(*) FILTER (WHERE starts_with(source_url, 'http://'))",
    "decision_id_url_safe": r"count(*) FILTER (WHERE regexp_matches(decision_id, '[^A-Za-z0-9_.\-/]'))",
    "decision_id_has_whitespace": r"count(*) FILTER (WHERE regexp_matches(decision_id, '\s'))",
    "text_length_agrees": "count(*) FILTER (WHERE coalesce(text_length, 0) <> length(coalesce(full_text, '')))",
}


@R.add(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", round(({m})::DOUBLE, 6) AS metric FROM decisions" for k, m in _METRICS.items()))
def qc_decision_checks(s: SparkSession, d: str) -> DataFrame:
    return Q.run(table(s, d, "decisions"), Q.decision_checks("2024-12-31")).select("check", F.round("metric", 6).alias("metric"))


@R.add()
def qc_decision_report(s: SparkSession, d: str) -> DataFrame:
    return Q.run(table(s, d, "decisions"), Q.decision_checks("2024-12-31"))


_BY_COURT = ("short_full_text", "short_text_floor", "total_null_dates", "corpus_total_count", "control_chars", "regeste_present_pct")


@R.add(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", court, round(({_METRICS[k]})::DOUBLE, 6) AS metric FROM decisions GROUP BY 2" for k in _BY_COURT))
def qc_checks_by_court(s: SparkSession, d: str) -> DataFrame:
    some = [k for k in Q.decision_checks("2024-12-31") if k.name in _BY_COURT]
    return Q.run(table(s, d, "decisions"), some, "court").select("check", "court", F.round("metric", 6).alias("metric"))


@R.add("""SELECT 'total_edge_count' AS "check", count(*)::DOUBLE AS metric FROM decision_citations UNION ALL SELECT 'blank_references', (count(*) FILTER (WHERE coalesce(trim(target_ref), '') = ''))::DOUBLE FROM decision_citations UNION ALL SELECT 'untyped_references', (count(*) FILTER (WHERE target_type IS NULL))::DOUBLE FROM decision_citations UNION ALL SELECT 'repeated_edges', (count(*) - (SELECT count(*) FROM (SELECT DISTINCT source_decision_id, target_ref FROM decision_citations)))::DOUBLE FROM decision_citations UNION ALL SELECT 'top_cited', (count(*) FILTER (WHERE target_ref = 'BGE 111 I 14'))::DOUBLE FROM decision_citations""")
def qc_graph_checks(s: SparkSession, d: str) -> DataFrame:
    return Q.run(table(s, d, "decision_citations"), Q.graph_checks()).select("check", "metric")


@R.add("""SELECT DISTINCT court FROM decisions WHERE court IN ('bger', 'bvger', 'bstger')""")
def qc_expected_courts_present(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "court").where(c("court").isin("bger", "bvger", "bstger")).distinct()


@R.add("""SELECT decision_id, count(DISTINCT court) AS courts FROM decisions GROUP BY 1 HAVING count(DISTINCT court) > 1""")
def qc_ids_across_courts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court").groupBy("decision_id").agg(F.countDistinct("court").alias("courts")).where("courts > 1")


@R.add(r"""SELECT DISTINCT x.source_decision_id, x.target_ref FROM decision_citations x JOIN (SELECT decision_id, max(decision_date) AS date FROM decisions WHERE regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') GROUP BY 1) a ON a.decision_id = x.source_decision_id WHERE try_cast(nullif(regexp_extract(x.target_ref, '/(\d{4})$', 1), '') AS INT) > try_cast(left(a.date, 4) AS INT) + 1""")
def qc_anachronistic_citations(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "decisions", "decision_id", "decision_date").where(c("decision_date").rlike(Q.ISO)).groupBy(c("decision_id").alias("source_decision_id")).agg(F.max("decision_date").alias("date"))
    year = F.nullif(F.regexp_extract("target_ref", r"/(\d{4})$", 1), F.lit("")).try_cast("int")
    return table(s, d, "decision_citations", "source_decision_id", "target_ref").join(a, "source_decision_id").where(year > F.substring("date", 1, 4).try_cast("int") + 1).select("source_decision_id", "target_ref").distinct()


@R.add(r"""SELECT DISTINCT target_ref FROM decision_citations x WHERE regexp_matches(target_ref, '^BGE \d+ [IV]+ \d+$') AND NOT EXISTS (SELECT 1 FROM bge_register b WHERE b.volume = regexp_extract(x.target_ref, '^BGE (\d+) ([IV]+) \d+$', 1)::INT AND b.division = regexp_extract(x.target_ref, '^BGE (\d+) ([IV]+) \d+$', 2))""")
def qc_nonexistent_volumes(s: SparkSession, d: str) -> DataFrame:
    p = r"^BGE (\d+) ([IV]+) \d+$"
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct().select("target_ref", F.regexp_extract("target_ref", p, 1).cast("int").alias("volume"), F.regexp_extract("target_ref", p, 2).alias("division"))
    return x.join(table(s, d, "bge_register", "volume", "division"), ["volume", "division"], "left_anti").select("target_ref")


@R.add("""SELECT court, l.n AS live, coalesce(w.n, 0) AS new FROM (SELECT court, count(*) AS n FROM decisions GROUP BY 1 HAVING count(*) >= 50) l LEFT JOIN (SELECT court, count(*) AS n FROM decisions WHERE has_full_text AND text_length > 1500 GROUP BY 1) w USING (court) WHERE coalesce(w.n, 0) < 0.8 * l.n""")
def qc_shrink_gate(s: SparkSession, d: str) -> DataFrame:
    live = table(s, d, "decisions", "court", "has_full_text", "text_length")
    return Q.group_gate(live.where("has_full_text and text_length > 1500"), live, "court", least=50)


@R.add("""WITH n AS (SELECT court, left(scraped_at::VARCHAR, 7) AS m, count(*)::DOUBLE AS v FROM decisions GROUP BY 1, 2), md AS (SELECT court, median(v) AS middle, count(*) AS k FROM n GROUP BY 1), b AS (SELECT court, middle, median(abs(v - middle)) AS mad FROM n JOIN md USING (court) WHERE k >= 3 GROUP BY 1, 2) SELECT court, middle, middle - greatest(5 * mad, 0.05 * middle) AS low, middle + greatest(5 * mad, 0.05 * middle) AS high, (SELECT count(*) FROM n WHERE n.court = b.court AND (v < middle - greatest(5 * mad, 0.05 * middle) OR v > middle + greatest(5 * mad, 0.05 * middle))) AS outside FROM b""")
def qc_drift_band(s: SparkSession, d: str) -> DataFrame:
    """The band of each court's monthly rows, and how many months lie outside."""
    from tessera.operators.aggregates import mad_band

    n = table(s, d, "decisions", "court", "scraped_at").groupBy("court", F.date_format("scraped_at", "yyyy-MM").alias("m")).agg(F.count("*").cast("double").alias("v"))
    band = mad_band(n, ["court"], "v")
    return n.join(band, "court").groupBy("court", "middle", "low", "high").agg(F.count_if((c("v") < c("low")) | (c("v") > c("high"))).alias("outside"))
