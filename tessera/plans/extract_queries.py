"""Queries of table-generating functions over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import extract as E
from tessera.plans.registry import Registry
from tessera.sources.tables import table

R = Registry()
c = F.col


def _texts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull())


def _full_texts(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "full_text", *columns).where(c("full_text").isNotNull())


def _statutes_sql() -> str:
    p, q = E.STATUTE.replace("'", "''"), E.STATUTE_PARAGRAPH.replace("'", "''")
    squeezed = lambda x: rf"lower(regexp_replace({x}, '\s+', '', 'g'))"
    words = ", ".join(f"'{w}'" for w in sorted(E.NO_LAWS))
    return rf"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{p}')) AS m FROM documents),
g AS (SELECT doc_id, {squeezed(f"regexp_extract(m, '{p}', 1)")} AS article, nullif({squeezed(f"regexp_extract(regexp_extract(m, '{p}', 2), '{q}', 1)")}, '') AS paragraph, regexp_extract(m, '{p}', 3) AS written FROM m),
f AS (SELECT *, length(regexp_replace(written, '[^A-Z]', '', 'g')) AS capitals FROM g)
SELECT DISTINCT doc_id, upper(written) AS law, article, paragraph, concat_ws('.', 'ART', article, 'ABS.' || paragraph, upper(written)) AS normalised FROM f
WHERE capitals > 0 AND NOT (capitals = 1 AND length(written) > 3) AND upper(written) NOT IN ({words})"""


@R.add(_statutes_sql())
def tvf_01_statutes(s: SparkSession, d: str) -> DataFrame:
    """Every provision of every text, in all languages and forms."""
    return _texts(s, d).select("doc_id", F.explode(E.statutes(c("text"))).alias("r")).select("doc_id", "r.law", "r.article", "r.paragraph", "r.normalised")


@R.add(r"""WITH series AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\b(?:BGE|ATF|DTF)\s+\d{1,3}\s+[IVX]{1,4}\s+\d{1,4}\b')) AS m FROM documents),
dockets AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '\b[A-Z0-9]{1,4}[._-]\d{1,6}[/_]\d{4}\b')) AS m FROM documents
  UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '\b[A-Z]{1,6}\.\d{4}\.\d{1,6}\b')) FROM documents
  UNION ALL SELECT doc_id, m FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?:(?:[Bb][Gg][Ee]|[Aa][Tt][Ff]|[Dd][Tt][Ff])\s)?\b\d{1,3}\s+[IVX]{1,4}\s+\d{1,4}\b')) AS m FROM documents) WHERE regexp_matches(m, '^\d')),
plain AS (SELECT doc_id, upper(trim(m)) AS raw, regexp_replace(upper(trim(m)), '\s+', ' ', 'g') AS bare FROM dockets)
SELECT DISTINCT doc_id, 'bge' AS kind, upper(regexp_replace(m, '^\w+\s+(\d+)\s+(\w+)\s+(\d+)$', 'BGE \1 \2 \3')) AS normalised FROM series
UNION ALL SELECT DISTINCT doc_id, 'docket', CASE WHEN regexp_matches(bare, '^\d{1,3} [IVX]{1,4} \d{1,4}$') THEN bare ELSE trim(regexp_replace(raw, '[-./_]+', '_', 'g'), '_') END FROM plain""")
def tvf_02_citations(s: SparkSession, d: str) -> DataFrame:
    """Every citation of every text: the published series, both docket forms, and the series without its name."""
    return _texts(s, d).select("doc_id", F.explode(E.citations(c("text"))).alias("r")).select("doc_id", "r.kind", "r.normalised")


@R.add(r"""SELECT DISTINCT doc_id, x AS citation FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b\d[A-Z][_.]\d+/\d{4}\b')) AS x FROM documents UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '\b[A-F]-\d+/\d{4}\b')) FROM documents UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '\b[A-Z]{2}\.\d{4}\.\d+\b')) FROM documents UNION ALL SELECT doc_id, regexp_replace(m, '^(?:BGE|ATF) +(\d+) +(\w+) +(\d+)$', 'BGE \1 \2 \3') FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b(?:BGE|ATF) +\d{1,3} +(?:I{1,3}[AV]?|V) +\d+\b')) AS m FROM documents))""")
def tvf_05_plain_citations(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("doc_id", F.explode(E.plain_citations(c("text"))).alias("citation"))


@R.add()
def tvf_07_sections(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("doc_id", E.sections_udf()(c("text")).alias("s")).select("doc_id", "s.method", F.length("s.facts").alias("facts"), F.length("s.reasons").alias("reasons"), F.length("s.orders").alias("orders"))


@R.add()
def tvf_08_numbered_paragraphs(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("doc_id", F.explode(E.paragraphs_udf()(c("text"))).alias("p")).select("doc_id", "p.number", "p.depth", "p.parent", F.md5("p.text").alias("text_hash"))


@R.add()
def tvf_11_chunks(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("doc_id", F.posexplode(E.chunks_udf()(c("text"))).alias("n", "chunk"))


@R.add()
def tvf_11_all_chunks(s: SparkSession, d: str) -> DataFrame:
    """Every document whole, in chunks."""
    from pyspark.sql.types import ArrayType, StringType

    return _texts(s, d).select("doc_id", F.posexplode(E.as_udf(E.all_chunks, ArrayType(StringType()))(c("text"))).alias("n", "chunk"))


@R.add(r"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(left(text, 600), '\b[A-Z]{2}\.\d{4}\.\d{1,6}\b'))) AS docket FROM documents""")
def tvf_20_header_dockets(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.substring("text", 1, 600), F.lit(r"\b[A-Z]{2}\.\d{4}\.\d{1,6}\b"), F.lit(0)))).alias("docket"))


@R.add("""SELECT decision_id, channel, key FROM (SELECT DISTINCT decision_id, unnest(['url', 'docket', 'hash']) AS channel, unnest([source_url, docket_number, content_hash]) AS key FROM decisions) WHERE coalesce(key, '') <> ''""")
def tvf_16_identity_channels(s: SparkSession, d: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("channel"), c(k).alias("key")) for n, k in (("url", "source_url"), ("docket", "docket_number"), ("hash", "content_hash"))])
    return table(s, d, "decisions", "decision_id", "source_url", "docket_number", "content_hash").select("decision_id", F.explode(pairs).alias("p")).select("decision_id", "p.channel", "p.key").where(F.coalesce("key", F.lit("")) != "").distinct()


@R.add("""SELECT doc_id, generate_subscripts(p, 1) - 1 AS n, length(unnest(p)) AS n_chars FROM (SELECT doc_id, list_filter(string_split(text, E'\\n\\n'), lambda x: length(x) >= 20) AS p FROM documents WHERE text IS NOT NULL)""".replace("\\\\", "\\"))
def tvf_18_blank_line_paragraphs(s: SparkSession, d: str) -> DataFrame:
    parts = F.filter(F.split("text", "\n\n"), lambda x: F.length(x) >= 20)
    return _texts(s, d).select("doc_id", F.posexplode(parts).alias("n", "p")).select("doc_id", c("n").cast("bigint").alias("n"), F.length("p").cast("bigint").alias("n_chars"))


def _prior_texts(s: SparkSession, d: str) -> DataFrame:
    """Decisions behind a made-up appeal against another one of the same table."""
    refs = table(s, d, "decision_citations", "source_decision_id", "target_ref").where(c("target_ref").rlike(r"^\d[A-Z]_\d+/\d{4}$")).groupBy(c("source_decision_id").alias("decision_id")).agg(F.min("target_ref").alias("ref"))
    return refs.select("decision_id", "ref", F.concat(F.lit("Beschwerde gegen den Entscheid des Obergerichts vom 3. Mai 2020 ("), "ref", F.lit(").\nSachverhalt:\nA.")).alias("t"))


@R.add(r"""SELECT source_decision_id AS decision_id, min(target_ref) AS prior FROM decision_citations WHERE regexp_matches(target_ref, '^\d[A-Z]_\d+/\d{4}$') GROUP BY 1""")
def tvf_03_prior_instances(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.types import ArrayType, StringType

    return _prior_texts(s, d).select("decision_id", F.explode(E.as_udf(E.prior_instances, ArrayType(StringType()))(c("t"))).alias("prior"))


@R.add()
def tvf_03_all_prior_instances(s: SparkSession, d: str) -> DataFrame:
    """The dockets that the full texts themselves name as appealed against."""
    from pyspark.sql.types import ArrayType, StringType

    return _full_texts(s, d).select("decision_id", F.explode(E.as_udf(E.prior_instances, ArrayType(StringType()))(c("full_text"))).alias("prior")).distinct()


@R.add()
def tvf_04_dockets_in_brackets(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.types import ArrayType, StringType

    brackets = _full_texts(s, d).select("decision_id", F.explode(F.regexp_extract_all("full_text", F.lit(r"\(([^)]+)\)"), F.lit(1))).alias("content"))
    return brackets.select("decision_id", "content", F.explode(E.as_udf(E.dockets_in_brackets, ArrayType(StringType()))(c("content"))).alias("docket")).distinct()


@R.add()
def tvf_06_joined_dockets(s: SparkSession, d: str) -> DataFrame:
    rows = _full_texts(s, d, "docket_number").where(c("docket_number").isNotNull())
    return rows.select("decision_id", c("docket_number").alias("lead"), F.explode(E.joined_dockets_udf()(c("full_text"), c("docket_number"))).alias("docket")).distinct()


@R.add()
def tvf_10_orders(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.types import ArrayType, StringType

    found = E.sections_udf()(c("text"))
    return _texts(s, d).select("doc_id", found.alias("s")).select("doc_id", F.posexplode(E.as_udf(E.orders, ArrayType(StringType()))(c("s.orders"))).alias("n", "order"))


@R.add()
def tvf_13_trilingual_headnotes(s: SparkSession, d: str) -> DataFrame:
    """The head-notes of the decisions of a court, one for each language, as one text; split again."""
    from pyspark.sql.types import MapType, StringType

    notes = table(s, d, "decisions", "court", "language", "regeste").where("language in ('de', 'fr', 'it') and length(trim(regeste)) >= 20").groupBy("court", "language").agg(F.min(F.regexp_replace("regeste", r"\s+", " ")).alias("n"))
    whole = notes.groupBy("court").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("Regeste ("), "language", F.lit(")\n"), "n"))), "\n").alias("t"))
    return whole.select("court", F.explode(E.as_udf(E.split_headnote, MapType(StringType(), StringType()))(c("t"))).alias("language", "note"))


@R.add("""SELECT court FROM (SELECT court, language, min(regexp_replace(regeste, '\\s+', ' ', 'g')) AS n FROM decisions WHERE language IN ('de', 'fr', 'it') AND length(trim(regeste)) >= 20 GROUP BY 1, 2) GROUP BY 1 HAVING count(*) >= 2""".replace("\\\\", "\\"))
def tvf_14_parallel_rows(s: SparkSession, d: str) -> DataFrame:
    return tvf_13_trilingual_headnotes(s, d).groupBy("court").agg(F.count("*").alias("n")).where("n >= 2").select("court")


@R.add("""SELECT decision_id, round(length(regeste)::DOUBLE / length(full_text), 4) AS ratio FROM (SELECT DISTINCT decision_id, regeste, full_text, title FROM decisions) WHERE length(regeste) >= 60 AND length(full_text) >= 500 AND regeste <> coalesce(title, '')""")
def tvf_15_summary_pairs(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "decisions", "decision_id", "regeste", "full_text", "title").where((F.length("regeste") >= 60) & (F.length("full_text") >= 500) & (c("regeste") != F.coalesce("title", F.lit(""))))
    light = rows.select("decision_id", F.round(F.length("regeste") / F.length("full_text"), 4).alias("ratio"), F.md5("regeste").alias("r"), F.xxhash64("full_text").alias("t"), F.md5(F.coalesce("title", F.lit("\0"))).alias("n"))
    return light.distinct().select("decision_id", "ratio")


# Words of one concept in three languages.
GLOSSARY = [("mietvertrag", "de", 1), ("contrat de bail", "fr", 1), ("contratto di locazione", "it", 1), ("kündigung", "de", 2), ("congé", "fr", 2), ("disdetta", "it", 2), ("strafzumessung", "de", 3), ("fixation de la peine", "fr", 3), ("commisurazione della pena", "it", 3)]


@R.add("WITH g AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{lang}', {k})" for t, lang, k in GLOSSARY) + """) t(term, lang, concept)), a AS (SELECT DISTINCT decision_id, term AS asked, concept FROM decisions JOIN g ON contains(lower(title), term)) SELECT decision_id, asked, g.term AS other, g.lang FROM a JOIN g USING (concept) WHERE asked <> g.term""")
def tvf_17_equivalents(s: SparkSession, d: str) -> DataFrame:
    """For the glossary's words in each title those of the other languages."""
    g = s.createDataFrame(GLOSSARY, "other string, lang string, concept int")
    words = F.array(*[F.struct(F.lit(t).alias("asked"), F.lit(k).alias("concept")) for t, _, k in GLOSSARY])
    asked = table(s, d, "decisions", "decision_id", "title").select("decision_id", F.explode(F.filter(words, lambda x: F.lower("title").contains(x["asked"]))).alias("a")).select("decision_id", "a.*").distinct()
    return asked.join(F.broadcast(g), "concept").where("asked <> other").select("decision_id", "asked", "other", "lang")


@R.add()
def tvf_19_amendments(s: SparkSession, d: str) -> DataFrame:
    """Every reference in decisions.full_text and documents.text; repeated ones stay."""
    from pyspark.sql.types import ArrayType

    texts = _full_texts(s, d).select(F.lit("decisions").alias("table_name"), c("decision_id").alias("id"), c("full_text").alias("t")).union(_texts(s, d).select(F.lit("documents"), c("doc_id").cast("string"), "text"))
    return texts.select("table_name", "id", F.explode(E.as_udf(E.amendments, ArrayType(E.AMENDMENT))(c("t"))).alias("a")).select("table_name", "id", "a.kind", "a.year", "a.page", "a.context")


@R.add()
def tvf_21_paragraph_hints(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.types import ArrayType, StringType

    notes = table(s, d, "decisions", "decision_id", "regeste").where(c("regeste").isNotNull())
    return notes.select("decision_id", F.explode(E.as_udf(E.paragraph_hints, ArrayType(StringType()))(c("regeste"))).alias("number")).distinct()
