"""Queries p2 and p3 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.orphans import citation_references, orphan_report, orphans
from tessera.operators.timestamps import NORMAL, normalised
from tessera.sources.tables import first_versions, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """decisions' dates that are not in the normal form: decision_id, field_name, utc_form."""
    decisions = table(spark, d, "decisions", "decision_id", "court", "source", "decision_date", "publication_date", "scraped_at")
    rows = first_versions(decisions, "court", "source", "decision_date", "publication_date")
    return normalised(rows, "decision_id", ["decision_date", "publication_date"], ["court", "source"], "scraped_at").where(~F.col("value").rlike(NORMAL)).select("decision_id", "field_name", F.col("form").alias("utc_form"))


def p2_notations(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each field and notation the decisions hold."""
    decisions = table(spark, d, "decisions", "decision_id", "court", "source", "decision_date", "publication_date", "scraped_at")
    rows = first_versions(decisions, "court", "source", "decision_date", "publication_date")
    return normalised(rows, "decision_id", ["decision_date", "publication_date"], ["court", "source"], "scraped_at").groupBy("field_name", "notation").agg(F.count("*").alias("n_values"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references: table_name, source_decision_id, target_ref, ref_month, status."""
    references = citation_references(table(spark, d, "decision_citations", "source_decision_id", "target_ref", "extracted_at"), table(spark, d, "citation_gaps", "target_ref", "checked_at"))
    return orphans(references, table(spark, d, "decisions", "decision_id", "docket_number", "scraped_at"), table(spark, d, "bge_register", "bge_reference", "docket_number_2", "decision_id"), table(spark, d, "version_removals", "decision_id", "docket_number"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, month and status."""
    return orphan_report(p3_found(spark, d))


def _key_sql(ref: str) -> str:
    """The rule of a reference's key, written out for itself."""
    return rf"""CASE WHEN {ref} IS NULL THEN NULL
      WHEN regexp_matches(lower({ref}), '^[^\p{{L}}\p{{N}}_]*(?:cons|consid|considérant|erw|erwägung|e|rz|rn|ziff|doc|dok|act|akt|p|pp|pag|pagina|page|s|seite|n|nr|no|ch|cf|fn|note|beilage|pièce|allegato|annexe|art|§|abs|al|cpv|lit|let|bl)[^\p{{L}}\p{{N}}_]*\d+[a-z]?(?:[.,-]\d{{1,3}})*[^\p{{L}}\p{{N}}_]*(?:ss|sgg|seg|segg|ff|f|s)?[^\p{{L}}\p{{N}}_]*$') THEN NULL
      WHEN regexp_matches(regexp_replace(lower({ref}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '^ ?(?:(?:bge|atf|dtf) ?)?\d{{1,3}} ?(?:iii|ii|iv|ia|ib|i|v) ?\d{{1,4}} ?$')
        THEN 'bge' || regexp_replace(regexp_replace(lower({ref}), '[^\p{{L}}\p{{N}}]+', '', 'g'), '^(?:bge|atf|dtf)', '')
      WHEN regexp_matches({ref}, '\d[^\d]+\d|\d{{6}}') THEN regexp_replace(lower({ref}), '[^\p{{L}}\p{{N}}]+', '', 'g') END"""


_ORPHANS_SQL = f"""
WITH refs AS (
  SELECT 'decision_citations' AS table_name, coalesce(source_decision_id, '') AS source_decision_id, target_ref, extracted_at AS seen_at FROM decision_citations
  UNION ALL SELECT 'citation_gaps', '', target_ref, checked_at FROM citation_gaps),
keyed AS (SELECT *, {_key_sql("target_ref")} AS key FROM refs),
d AS (SELECT {_key_sql("ref")} AS key, min(scraped_at) AS since FROM (SELECT docket_number AS ref, scraped_at FROM decisions UNION ALL SELECT decision_id, scraped_at FROM decisions) GROUP BY 1),
b AS (SELECT DISTINCT {_key_sql("ref")} AS key FROM (SELECT bge_reference AS ref FROM bge_register UNION ALL SELECT docket_number_2 FROM bge_register UNION ALL SELECT decision_id FROM bge_register)),
v AS (SELECT DISTINCT {_key_sql("ref")} AS key FROM (SELECT docket_number AS ref FROM version_removals UNION ALL SELECT decision_id FROM version_removals)),
found AS (
  SELECT DISTINCT table_name, source_decision_id, target_ref, strftime(seen_at, '%Y-%m') AS ref_month,
    CASE WHEN b.key IS NOT NULL THEN NULL WHEN d.key IS NOT NULL THEN CASE WHEN seen_at < d.since THEN 'late' END WHEN v.key IS NOT NULL THEN 'deleted' ELSE 'missing' END AS status
  FROM keyed LEFT JOIN d USING (key) LEFT JOIN b USING (key) LEFT JOIN v USING (key) WHERE keyed.key IS NOT NULL)
"""

QUERIES = {"p2_found": p2_found, "p2_notations": p2_notations, "p3_found": p3_found, "p3_report": p3_report}
SQL = {
    "p3_found": _ORPHANS_SQL + "SELECT * FROM found WHERE status IS NOT NULL",
    "p3_report": _ORPHANS_SQL + "SELECT table_name, ref_month, status, count(*) AS n_references, count(DISTINCT target_ref) AS n_targets FROM found WHERE status IS NOT NULL GROUP BY ALL",
}
