"""Queries of the training-data operators and, where DuckDB can express them on whole tables, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import first_versions, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in decisions.full_text: decision_id, pii_type, pii_text."""
    from tessera.llm import pii

    decisions = table(spark, d, "decisions", "decision_id", "full_text")
    return pii.find_all(decisions, "decision_id", "full_text", pii.learn(decisions, "full_text"))


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every row of decisions with typed placeholders in full_text."""
    from tessera.llm import pii

    decisions = table(spark, d, "decisions", "decision_id", "full_text")
    return pii.redact_all(decisions, "full_text", pii.learn(decisions, "full_text"))


def p1_numbered(spark: SparkSession, d: str) -> DataFrame:
    """As ``p1_redacted``, with placeholders that tell the pieces of a text apart."""
    from tessera.llm import pii

    decisions = table(spark, d, "decisions", "decision_id", "full_text")
    return pii.redact_all(decisions, "full_text", pii.learn(decisions, "full_text"), numbered=True)


QUERIES = {"p1_found": p1_found, "p1_redacted": p1_redacted, "p1_numbered": p1_numbered}
SQL: dict[str, str] = {}


def _p4(spark: SparkSession, d: str) -> DataFrame:
    from tessera.llm import language

    decisions = table(spark, d, "decisions", "decision_id", "language", "full_text")
    return language.segments(decisions, "decision_id", "language", "full_text", language.fit(decisions, "decision_id", "language", "full_text"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Missing or wrong labels (seg -1) and paragraphs in another language: decision_id, seg, lang."""
    from tessera.llm import language

    return language.corrections(_p4(spark, d)).select(F.col("id").alias("decision_id"), "seg", "lang").distinct()


def p4_languages(spark: SparkSession, d: str) -> DataFrame:
    """The language and confidence of each decision and each paragraph of running text."""
    return _p4(spark, d).select(F.col("id").alias("decision_id"), "seg", "lang", F.round("confidence", 3).alias("confidence")).distinct()


QUERIES |= {"p4_found": p4_found, "p4_languages": p4_languages}


def _p5(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        table(spark, d, "decisions", "decision_id", "title", "regeste", "full_text", "judges", "pdf_url", "source", "scraped_at"),
        table(spark, d, "decision_representations", "canonical_decision_id", "member_decision_id"),
        table(spark, d, "data_sources", "source", "trust_rank"),
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The decision whose value survives, for each group and field: group_id, field_name, decision_id."""
    from tessera.llm import survivors

    return survivors.winners(survivors.ballots(*_p5(spark, d))).select("group_id", "field_name", "decision_id")


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record for each group."""
    from tessera.llm import survivors

    return survivors.records(*_p5(spark, d))


QUERIES |= {"p5_found": p5_found, "p5_records": p5_records}

_VALUE = "CASE WHEN lower(trim({0})) IN ('', 'none', 'n/a', '-') THEN NULL ELSE {0} END"
SQL["p5_found"] = f"""
WITH RECURSIVE ends AS (SELECT canonical_decision_id AS u, member_decision_id AS v FROM decision_representations UNION SELECT member_decision_id, canonical_decision_id FROM decision_representations),
reach(u, v) AS (SELECT u, u FROM ends UNION SELECT r.u, e.v FROM reach r JOIN ends e ON r.v = e.u),
root AS (SELECT u AS decision_id, min(v) AS root FROM reach GROUP BY 1),
since AS (SELECT decision_id, min(scraped_at) AS scraped_at FROM decisions GROUP BY 1),
versions AS (
  SELECT decision_id, scraped_at, min(source) AS source, max(length({_VALUE.format("full_text")})) AS size, max({_VALUE.format("full_text")}) AS full_text,
    max({_VALUE.format("title")}) AS title, max({_VALUE.format("regeste")}) AS regeste, max({_VALUE.format("judges")}) AS judges, max({_VALUE.format("pdf_url")}) AS pdf_url
  FROM decisions JOIN since USING (decision_id, scraped_at) GROUP BY ALL),
members AS (SELECT *, coalesce(trust_rank, 1000000) AS trust FROM versions JOIN root USING (decision_id) LEFT JOIN data_sources USING (source)),
named AS (SELECT *, min(decision_id) OVER (PARTITION BY root) AS group_id FROM members),
long AS (
  SELECT group_id, decision_id, 'full_text' AS field_name, -size::BIGINT AS a, 0 AS b FROM named WHERE full_text IS NOT NULL
  UNION ALL SELECT group_id, decision_id, 'title', -epoch(scraped_at)::BIGINT, 0 FROM named WHERE title IS NOT NULL
  UNION ALL SELECT group_id, decision_id, 'regeste', -epoch(scraped_at)::BIGINT, 0 FROM named WHERE regeste IS NOT NULL
  UNION ALL SELECT group_id, decision_id, 'judges', trust, -epoch(scraped_at)::BIGINT FROM named WHERE judges IS NOT NULL
  UNION ALL SELECT group_id, decision_id, 'pdf_url', trust, -epoch(scraped_at)::BIGINT FROM named WHERE pdf_url IS NOT NULL)
SELECT group_id, field_name, decision_id FROM long QUALIFY row_number() OVER (PARTITION BY group_id, field_name ORDER BY a, b, decision_id) = 1
"""


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of documents.text under byte_bpe_50k: doc_id, ids."""
    from tessera.llm import tokens

    return tokens.encode(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def _p8(spark: SparkSession, d: str) -> DataFrame:
    from tessera.llm import mixing, tokens

    sized = tokens.counts(table(spark, d, "documents", "doc_id", "source", "text"), ["doc_id", "source"], "text")
    return mixing.mixture(sized, table(spark, d, "data_sources", "source", "target_share", "max_repeats"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture of documents to data_sources.target_share: doc_id, copy, source, n_tokens, slot, position, source_short."""
    return _p8(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mixture."""
    from tessera.llm import mixing

    return mixing.shares(_p8(spark, d), table(spark, d, "data_sources", "source", "target_share"))


QUERIES |= {"p7_ids": p7_ids, "p8_mixture": p8_mixture, "p8_shares": p8_shares}


def _p9(spark: SparkSession, d: str) -> DataFrame:
    from tessera.llm import residue

    documents = table(spark, d, "documents", "doc_id", "text")
    return residue.score(documents, "doc_id", "text", residue.fit(documents, "doc_id", "text"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold residue in place of a court text: doc_id."""
    return _p9(spark, d).where("residue").select("doc_id").distinct()


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """All documents that are no residue, whole."""
    from tessera.llm import residue

    documents = table(spark, d, "documents", "doc_id", "text", "lang", "source")
    return residue.keep(documents, "text", residue.fit(documents, "doc_id", "text"))


QUERIES |= {"p9_found": p9_found, "p9_kept": p9_kept}


def _p6(spark: SparkSession, d: str, texts: bool) -> DataFrame:
    from tessera.llm import scans

    decisions = table(spark, d, "decisions", "decision_id", "docket_number", "full_text", "content_text")
    fields = ["full_text", "content_text"]
    return scans.repairs(decisions, "decision_id", "docket_number", fields, scans.lexicon(decisions, fields), texts)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Repairs of scanned texts: decision_id, field_name, kind, item."""
    return _p6(spark, d, texts=False)


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every text of decisions as continuous paragraphs."""
    return _p6(spark, d, texts=True)


QUERIES |= {"p6_found": p6_found, "p6_repaired": p6_repaired}
