"""Queries of dates, keys, comparisons of extractors, retrieval scores, samples and further checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import documents as D
from tessera.functions import extract as E
from tessera.functions import text as T
from tessera.operators import dedup
from tessera.operators import quality as Q
from tessera.operators import search as S
from tessera.operators.aggregates import mad_band, percentiles
from tessera.plans import extract_queries, graph_queries
from tessera.plans.registry import Registry
from tessera.plans.search_queries import _BM25, _POSTINGS
from tessera.sources.tables import table

R = Registry()
c = F.col
_ISO = "regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
# Abbreviations of one law in several languages.
ALIASES = {
    "BGG/LTF": ["BGG", "LTF"], "BV/Cst./Cost.": ["BV", "CST", "COST"], "ZGB/CC": ["ZGB", "CC"], "OR/CO": ["OR", "CO"], "StGB/CP": ["STGB", "CP"], "StPO/CPP": ["STPO", "CPP"], "ZPO/CPC": ["ZPO", "CPC"],
    "VwVG/PA": ["VWVG", "PA"], "ATSG/LPGA": ["ATSG", "LPGA"], "AsylG/LAsi": ["ASYLG", "LASI"], "AIG/LEI": ["AIG", "AUG", "LEI"], "UVG/LAA": ["UVG", "LAA", "LAINF"], "IVG/LAI": ["IVG", "LAI"],
    "AHVG/LAVS": ["AHVG", "LAVS"], "AVIG/LACI": ["AVIG", "LACI", "LADI"], "KVG/LAMal": ["KVG", "LAMAL"], "EMRK/CEDH": ["EMRK", "CEDH", "CEDU"], "SchKG/LP": ["SCHKG", "LP", "LEF"], "BVG/LPP": ["BVG", "LPP"], "VGG/LTAF": ["VGG", "LTAF"],
}
_STATUTES = extract_queries.R.sql["tvf_01_statutes"]


def _decisions(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", *columns)


def _provisions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", F.explode(E.statutes(c("text"))).alias("r")).select("doc_id", "r.*")


@R.add()
def scl_13_docket_date(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "full_text").select("decision_id", D.docket_date(c("full_text")).alias("x")).where(c("x").isNotNull()).select("decision_id", "x.docket", "x.day").distinct()


@R.add(f"""WITH x AS (SELECT decision_id, CASE WHEN {_ISO.format("decision_date")} THEN decision_date END AS a, CASE WHEN {_ISO.format("publication_date")} THEN publication_date END AS b FROM decisions) SELECT DISTINCT decision_id, CASE WHEN NOT coalesce(ends_with(a, '-01-01'), false) THEN a END AS decided, coalesce(b, CASE WHEN ends_with(a, '-01-01') THEN a END) AS published, CASE WHEN b IS NOT NULL THEN 'stored' WHEN ends_with(a, '-01-01') THEN 'volume_year' END AS origin FROM x""")
def scl_15_demux_dates(s: SparkSession, d: str) -> DataFrame:
    """Without a day read from the text, so that SQL can follow."""
    iso = lambda x: F.when(c(x).rlike(Q.ISO), c(x))
    rows = _decisions(s, d, "decision_date", "publication_date")
    return rows.select("decision_id", D.demux_dates(iso("decision_date"), iso("publication_date"), F.lit(None).cast("string")).alias("x")).select("decision_id", "x.*").distinct()


@R.add()
def scl_17_decision_day(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "full_text", "decision_date").where(c("full_text").isNotNull()).select("decision_id", D.decision_day(c("full_text"), c("decision_date")).alias("x")).select("decision_id", "x.*").distinct()


@R.add()
def scl_35_remedy(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "full_text").select("decision_id", D.remedy(c("full_text")).alias("remedy")).where(c("remedy").isNotNull()).distinct()


@R.add("""SELECT DISTINCT source, CASE WHEN contains(m, '.cantonal.') THEN 'cantonal_court' WHEN starts_with(m, 'scrapers.') THEN 'federal_or_authority' ELSE 'unknown' END AS kind FROM (SELECT source, CASE WHEN starts_with(source, 'canton') THEN 'scrapers.cantonal.' ELSE '' END || CASE WHEN contains(source, '_') THEN 'scrapers.' ELSE 'x.' END || source AS m FROM data_sources)""")
def scl_41_source_kind(s: SparkSession, d: str) -> DataFrame:
    module = F.concat(F.when(c("source").startswith("canton"), "scrapers.cantonal.").otherwise(""), F.when(c("source").contains("_"), "scrapers.").otherwise("x."), c("source"))
    return table(s, d, "data_sources", "source").select("source", D.source_kind(module).alias("kind")).distinct()


@R.add(r"""SELECT DISTINCT decision_id, CASE WHEN regexp_matches(trim(docket_number), '^\d{2,3}[ .]\d{4}[ .]\d{1,5}$') THEN 'publication_page' ELSE 'judgment' END AS role FROM decisions""")
def scl_49_representation_role(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "docket_number").select("decision_id", D.representation_role(c("docket_number")).alias("role")).distinct()


@R.add("""SELECT DISTINCT decision_id, 3 * contains(t, 'anfechtung der kündigung')::INT + 2 * contains(r, 'anfechtung der kündigung')::INT + (contains(t, 'anfechtung') OR contains(r, 'anfechtung') OR contains(l, 'anfechtung'))::INT + (contains(t, 'kündigung') OR contains(r, 'kündigung') OR contains(l, 'kündigung'))::INT AS score FROM (SELECT decision_id, lower(coalesce(title, '')) AS t, lower(coalesce(regeste, '')) AS r, lower(coalesce(legal_area, '')) AS l FROM decisions)""")
def scl_57_topic_score(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "title", "regeste", "legal_area").select("decision_id", D.topic_score("Anfechtung der Kündigung", c("title"), c("regeste"), c("legal_area")).alias("score")).distinct()


@R.add("""SELECT key, count(DISTINCT decision_id) AS n FROM (SELECT decision_id, concat_ws('|', coalesce(nullif(court, ''), '?'), regexp_replace(upper(coalesce(docket_number, '')), '[^0-9A-Z]', '', 'g'), coalesce(nullif(decision_date, ''), '?')) AS key FROM decisions UNION ALL SELECT decision_id, 'bge|' || volume || '|' || upper(division) || '|' || first_page FROM bge_register) GROUP BY 1""")
def scl_58_regroup_key(s: SparkSession, d: str) -> DataFrame:
    """How many ids fall under each key, over decisions and the published series."""
    own = _decisions(s, d, "court", "docket_number", "decision_date").select("decision_id", D.regroup_key(c("court"), c("docket_number"), c("decision_date")).alias("key"))
    series = table(s, d, "bge_register", "decision_id", "bge_reference", "decision_date").select("decision_id", D.regroup_key(F.lit("bge"), c("bge_reference"), c("decision_date")).alias("key"))
    return own.unionByName(series).groupBy("key").agg(F.countDistinct("decision_id").alias("n"))


@R.add(f"""SELECT DISTINCT law, regexp_replace(replace(lower(trim(law)), 'ß', 'ss'), '[\\s.]+', '', 'g') AS key FROM ({_STATUTES})""")
def scl_61_fold_name(s: SparkSession, d: str) -> DataFrame:
    return _provisions(s, d).select("law", D.fold_name(c("law")).alias("key")).distinct()


@R.add(r"""SELECT DISTINCT decision_id, regexp_replace(list_filter(regexp_extract_all(left(full_text, 4000), '\b\d[A-Z][._ ]\d+/\d{4}\b'), lambda x: y IS NULL OR regexp_extract(x, '(\d{4})$', 1)::INT BETWEEN y - 3 AND y + 1)[1], '^(\d[A-Z])[._ ]', '\1_') AS docket FROM (SELECT *, try_cast(regexp_extract(decision_date, '^\d{4}') AS INT) AS y FROM decisions WHERE full_text IS NOT NULL)""")
def scl_64_docket_behind(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d, "full_text", "decision_date").where(c("full_text").isNotNull()).select("decision_id", D.docket_behind(c("full_text"), c("decision_date")).alias("docket")).distinct()


@R.add()
def scl_19_cut_headnote(s: SparkSession, d: str) -> DataFrame:
    """Head-notes as they are to be kept, by length."""
    cut = D.cut_headnote(c("regeste"), c("full_text"))
    return _decisions(s, d, "regeste", "full_text").where(c("regeste").isNotNull()).select("decision_id", F.length("regeste").alias("had"), F.length(cut).alias("kept")).distinct()


@R.add()
def tvf_12_study_sections(s: SparkSession, d: str) -> DataFrame:
    """Lettered parts of the facts, and how good the parse of each document is."""
    parsed = table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", E.study_udf()(c("text")).alias("x"))
    return parsed.select("doc_id", c("x.quality").alias("quality"), F.explode_outer("x.parts").alias("p")).select("doc_id", "quality", "p.letter", F.length("p.text").alias("n_chars"))


@R.add(f"""WITH a AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, vs in ALIASES.items() for v in vs)}) t(name, law)) SELECT coalesce(name, law) AS name, count(*) AS n, count(DISTINCT doc_id) AS docs FROM ({_STATUTES}) LEFT JOIN a USING (law) GROUP BY 1""")
def grf_12_aliases_of_laws(s: SparkSession, d: str) -> DataFrame:
    """Provisions by law, whatever language its abbreviation is in."""
    names = s.createDataFrame([(k, v) for k, vs in ALIASES.items() for v in vs], "name string, law string")
    return _provisions(s, d).join(F.broadcast(names), "law", "left").groupBy(F.coalesce("name", "law").alias("name")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@R.add("""WITH g AS (SELECT canonical_key, count(DISTINCT decision_id) AS size, count(DISTINCT court) AS courts FROM decisions WHERE canonical_key IS NOT NULL GROUP BY 1) SELECT count(*) AS groups, count(*) FILTER (WHERE size = 1) AS single, max(size) AS largest, sum(size)::BIGINT AS ids, count(*) FILTER (WHERE courts > 1) AS over_courts, (SELECT count(*) FROM decisions WHERE canonical_key IS NULL) AS without FROM g""")
def agg_44_key_diagnostics(s: SparkSession, d: str) -> DataFrame:
    rows = _decisions(s, d, "canonical_key", "court")
    g = rows.where(c("canonical_key").isNotNull()).groupBy("canonical_key").agg(F.countDistinct("decision_id").alias("size"), F.countDistinct("court").alias("courts"))
    out = g.agg(F.count("*").alias("groups"), F.count_if(c("size") == 1).alias("single"), F.max("size").alias("largest"), F.sum("size").alias("ids"), F.count_if(c("courts") > 1).alias("over_courts"))
    return out.withColumn("without", F.lit(rows.where(c("canonical_key").isNull()).count()))


_OLD, _NEW = r"\b(?:BGE|ATF) \d{1,3} [IVX]{1,4} \d{1,4}\b", r"(?i)\b(?:BGE|ATF|DTF)\s\d{1,3}\s[IVX]{1,4}\s\d{1,4}\b"


@R.add(rf"""WITH x AS (SELECT doc_id, coalesce(lang, '') AS lang, list_distinct(regexp_extract_all(text, '{_OLD}')) AS a, list_distinct(regexp_extract_all(text, '{_NEW}')) AS b FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, lang, 'lost' AS change, unnest(list_filter(a, lambda v: NOT list_contains(b, v))) AS ref FROM x UNION ALL SELECT doc_id, lang, 'new', unnest(list_filter(b, lambda v: NOT list_contains(a, v))) FROM x)
SELECT lang, change, count(*) AS n, array_to_string(list_slice(list_sort(list(DISTINCT ref)), 1, 50), ';') AS examples FROM t GROUP BY 1, 2""")
def agg_45_extraction_diff(s: SparkSession, d: str) -> DataFrame:
    """What one extractor finds and another does not, by language, with at most fifty examples."""
    found = lambda p: F.array_distinct(F.regexp_extract_all("text", F.lit(p), F.lit(0)))
    x = table(s, d, "documents", "doc_id", "lang", "text").where(c("text").isNotNull()).select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), found(_OLD).alias("a"), found(_NEW).alias("b"))
    both = F.concat(F.transform(F.array_except("a", "b"), lambda v: F.struct(F.lit("lost").alias("change"), v.alias("ref"))), F.transform(F.array_except("b", "a"), lambda v: F.struct(F.lit("new").alias("change"), v.alias("ref"))))
    t = x.select("lang", F.explode(both).alias("t")).select("lang", "t.change", "t.ref").groupBy("lang", "change", "ref").agg(F.count("*").alias("n"))
    # the fifty least spellings of each kind, kept by a bounded window
    few = t.withColumn("r", F.row_number().over(Window.partitionBy("lang", "change").orderBy("ref"))).where("r <= 50").groupBy("lang", "change").agg(F.array_join(F.array_sort(F.collect_list("ref")), ";").alias("examples"))
    return t.groupBy("lang", "change").agg(F.sum("n").alias("n")).join(few, ["lang", "change"])


@R.add("""WITH l AS (SELECT l_suppkey AS query, l_partkey AS doc, max(l_linenumber % 4) AS grade FROM lineitem GROUP BY 1, 2), r AS (SELECT l_suppkey AS query, l_partkey AS doc, row_number() OVER (PARTITION BY l_suppkey ORDER BY max(l_extendedprice) DESC, l_partkey) AS rank FROM lineitem GROUP BY 1, 2),
f AS (SELECT query, grade, rank FROM r JOIN l USING (query, doc) WHERE rank <= 10),
p AS (SELECT query, max(CASE WHEN grade >= 2 THEN 1.0 / rank END) AS rr, count(*) FILTER (WHERE grade >= 2) AS hits, sum((pow(2, grade) - 1) / log2(rank + 1)) AS dcg FROM f GROUP BY 1),
i AS (SELECT query, count(*) FILTER (WHERE grade >= 2) AS n_rel, sum(CASE WHEN k <= 10 THEN (pow(2, grade) - 1) / log2(k + 1) END) AS best FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY grade DESC) AS k FROM l) GROUP BY 1),
q AS (SELECT query, query % 5 AS stratum, coalesce(rr, 0) AS rr, coalesce(hits, 0) / least(greatest(n_rel, 1), 10) AS recall, coalesce(dcg, 0) / CASE WHEN best > 0 THEN best ELSE 1 END AS ndcg FROM i LEFT JOIN p USING (query))
SELECT stratum, count(*) AS n, round(avg(rr), 4) AS mrr, round(avg(recall), 4) AS recall, round(avg(ndcg), 4) AS ndcg FROM q GROUP BY 1""")
def agg_47_graded_scores(s: SparkSession, d: str) -> DataFrame:
    """Retrieval scores at true ranks by stratum; only grades of two and more are relevant."""
    from tessera.operators.aggregates import graded_scores

    rows = table(s, d, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", "l_extendedprice").toDF("query", "doc", "line", "price")
    labels = rows.groupBy("query", "doc").agg(F.max(c("line") % 4).alias("grade"))
    runs = rows.groupBy("query", "doc").agg(F.max("price").alias("price")).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(c("price").desc(), "doc")))
    per = graded_scores(runs, labels).withColumn("stratum", c("query") % 5)
    return per.groupBy("stratum").agg(F.count("*").alias("n"), *[F.round(F.avg(k), 4).alias(k) for k in ("mrr", "recall", "ndcg")])


@R.add("""SELECT o_orderkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 40""")
def top_09_keyset_page(s: SparkSession, d: str) -> DataFrame:
    """The page behind a key."""
    return table(s, d, "orders", "o_orderkey").where("o_orderkey > 1000").orderBy("o_orderkey").limit(40)


@R.add("""SELECT n_name AS target, CASE WHEN n_nationkey = 0 THEN 0 ELSE 1 END AS depth FROM nation WHERE n_regionkey = 0""")
def top_10_build_order(s: SparkSession, d: str) -> DataFrame:
    """Targets in an order in which each comes after what it needs; here all of a region need its first nation."""
    from tessera.operators.aggregates import topological_order

    names = {r["n_nationkey"]: r["n_name"] for r in table(s, d, "nation", "n_nationkey", "n_name", "n_regionkey").where("n_regionkey = 0").collect()}
    order = topological_order({n: [] if k == 0 else [names[0]] for k, n in names.items()})
    return s.createDataFrame([(n, 0 if k == 0 else 1) for k, n in enumerate(order)], "target string, depth int")


@R.add("""WITH n AS (SELECT decision_id, min(docket_number) AS docket, max(regeste) AS regeste FROM decisions GROUP BY 1), x AS (SELECT DISTINCT a.decision_id AS source, b.decision_id AS target, left(a.regeste, 200) AS query FROM decision_citations JOIN n a ON a.decision_id = source_decision_id JOIN n b ON b.docket = target_ref WHERE a.decision_id <> b.decision_id AND length(a.regeste) >= 50 AND length(b.regeste) >= 50)
SELECT source, target, query FROM x ORDER BY md5(source || '-' || target || '-#42'), source, target LIMIT 500""")
def top_11_citation_pairs(s: SparkSession, d: str) -> DataFrame:
    """A seeded sample of citing and cited decisions that both have a head-note."""
    n = _decisions(s, d, "docket_number", "regeste").groupBy("decision_id").agg(F.min("docket_number").alias("docket"), F.max("regeste").alias("regeste")).where(F.length("regeste") >= 50)
    a = n.select(c("decision_id").alias("source"), F.substring("regeste", 1, 200).alias("query"))
    b = n.select(c("decision_id").alias("target"), c("docket").alias("target_ref"))
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref").distinct().withColumnRenamed("source_decision_id", "source")
    pairs = x.join(b, "target_ref").where("source <> target").join(a, "source").select("source", "target", "query").distinct()
    return pairs.orderBy(F.md5(F.concat_ws("-", "source", "target", F.lit("#42"))), "source", "target").limit(500)


_CHANNELS = {"url": "source_url", "hash": "content_hash", "docket": "court || '|' || nullif(docket_number, '') || '|' || nullif(decision_date, '')", "key": "canonical_key", "source": "source || '|' || nullif(source_id, '')"}


@R.add("WITH k AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS method, {e} AS key, decision_id FROM decisions WHERE coalesce({e}, '') <> ''" for n, e in _CHANNELS.items()) + """),
h AS (SELECT method, key, min(decision_id) AS canonical FROM k GROUP BY 1, 2 HAVING count(*) > 1), p AS (SELECT canonical, decision_id AS member, method FROM k JOIN h USING (method, key) WHERE decision_id <> canonical)
SELECT member, min(canonical) AS canonical, array_to_string(list_sort(list(DISTINCT method)), ',') AS methods FROM p GROUP BY 1""")
def ded_05_derived_representations(s: SparkSession, d: str) -> DataFrame:
    """Records of one decision by five identifiers; each member belongs to one canonical record, the least of those met."""
    parts = {"url": c("source_url"), "hash": c("content_hash"), "docket": F.concat(c("court"), F.lit("|"), F.nullif("docket_number", F.lit("")), F.lit("|"), F.nullif("decision_date", F.lit(""))), "key": c("canonical_key"), "source": F.concat(c("source"), F.lit("|"), F.nullif("source_id", F.lit("")))}
    rows = _decisions(s, d, "source_url", "content_hash", "court", "docket_number", "decision_date", "canonical_key", "source", "source_id")
    return dedup.representations(rows, "decision_id", parts).select("member", "canonical", F.array_join("methods", ",").alias("methods"))


@R.add(r"""SELECT count(*) AS refs, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM bge_register WHERE bge_reference = ref) OR EXISTS (SELECT 1 FROM decisions WHERE docket_number = ref)) AS resolved FROM (SELECT DISTINCT target_ref AS ref FROM decision_citations WHERE coalesce(trim(target_ref), '') <> '')""")
def qc_resolution_rate(s: SparkSession, d: str) -> DataFrame:
    """How many of the different references name a decision as they are written."""
    refs = table(s, d, "decision_citations", "target_ref").where(F.coalesce(F.trim("target_ref"), F.lit("")) != "").distinct()
    known = table(s, d, "bge_register", "bge_reference").toDF("target_ref").union(table(s, d, "decisions", "docket_number")).where(c("target_ref").isNotNull()).distinct().withColumn("held", F.lit(1))
    return refs.join(known, "target_ref", "left").agg(F.count("*").alias("refs"), F.count("held").alias("resolved"))


@R.add("""WITH n AS (SELECT court, count(*) FILTER (WHERE coalesce(decision_date, '') = '') AS now, count(*) FILTER (WHERE coalesce(decision_date, '') = '' AND scraped_at < TIMESTAMP '2023-12-01') AS before FROM decisions GROUP BY 1) SELECT court, before, now, now <= greatest(before * 1.1, before + 5) AS passed FROM n""")
def qc_null_dates_floor(s: SparkSession, d: str) -> DataFrame:
    """Missing dates of each court against an earlier state."""
    missing, early = F.coalesce("decision_date", F.lit("")) == "", c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")
    n = _decisions(s, d, "court", "decision_date", "scraped_at").groupBy("court").agg(F.count_if(missing & early).alias("before"), F.count_if(missing).alias("now"))
    return n.select("court", "before", "now", (c("now") <= F.greatest(c("before") * 1.1, c("before") + 5.0)).alias("passed"))


@R.add(r"""SELECT target_ref, count(DISTINCT source_decision_id) AS sources FROM decision_citations WHERE regexp_matches(target_ref, '^[1-9][A-Z]_\d+/\d{4}$') AND right(target_ref, 4)::INT >= 2008 AND target_ref NOT IN (SELECT docket_number FROM decisions WHERE docket_number IS NOT NULL) GROUP BY 1""")
def qc_unresolved_recent(s: SparkSession, d: str) -> DataFrame:
    """Federal dockets of the years that are held nearly whole, and yet are missing."""
    x = table(s, d, "decision_citations", "target_ref", "source_decision_id").where(c("target_ref").rlike(r"^[1-9][A-Z]_\d+/\d{4}$") & (F.right("target_ref", F.lit(4)).try_cast("int") >= 2008))
    held = table(s, d, "decisions", "docket_number").toDF("target_ref").distinct()
    return x.join(held, "target_ref", "left_anti").groupBy("target_ref").agg(F.countDistinct("source_decision_id").alias("sources"))


@R.add(f"""SELECT l.law, coalesce(n, 0) AS n, coalesce(n, 0) >= 10 AS passed FROM (SELECT unnest(['BV', 'ZGB', 'OR', 'STGB', 'STPO', 'ZPO', 'BGG']) AS law) l LEFT JOIN (SELECT law, count(*) AS n FROM ({_STATUTES}) GROUP BY 1) USING (law)""")
def qc_top_laws_present(s: SparkSession, d: str) -> DataFrame:
    """The laws that any corpus cites."""
    n = _provisions(s, d).groupBy("law").agg(F.count("*").alias("n"))
    asked = s.createDataFrame([(x,) for x in ("BV", "ZGB", "OR", "STGB", "STPO", "ZPO", "BGG")], "law string")
    zero = F.lit(0).cast("bigint")
    return asked.join(n, "law", "left").select("law", F.coalesce("n", zero).alias("n"), (F.coalesce("n", zero) >= 10).alias("passed"))


@R.add("""WITH n AS (SELECT court, strftime(scraped_at, '%Y-%m') AS m, (count(*) FILTER (WHERE coalesce(decision_date, '') = ''))::DOUBLE AS v FROM decisions WHERE scraped_at IS NOT NULL GROUP BY 1, 2), md AS (SELECT court, median(v) AS middle, count(*) AS k FROM n GROUP BY 1), b AS (SELECT court, middle, median(abs(v - middle)) AS mad FROM n JOIN md USING (court) WHERE k >= 3 GROUP BY 1, 2) SELECT court, m, v AS missing FROM n JOIN b USING (court) WHERE v > middle + greatest(5 * mad, 0.05 * middle)""")
def qc_null_date_drift(s: SparkSession, d: str) -> DataFrame:
    """Months in which a court misses more dates than its band allows."""
    rows = _decisions(s, d, "court", "decision_date", "scraped_at").where(c("scraped_at").isNotNull())
    n = rows.groupBy("court", F.date_format("scraped_at", "yyyy-MM").alias("m")).agg(F.count_if(F.coalesce("decision_date", F.lit("")) == "").cast("double").alias("missing"))
    return n.join(mad_band(n, ["court"], "missing"), "court").where("missing > high").select("court", "m", "missing")


@R.add()
def qc_structure(s: SparkSession, d: str) -> DataFrame:
    """Documents and numbered paragraphs, numbers that can't be sorted, and judgments without any, by kind of document."""
    parsed = table(s, d, "documents", "doc_kind", "text").where(c("text").isNotNull()).select("doc_kind", E.paragraphs_udf()(c("text")).alias("p"))
    odd = F.size(F.filter("p", lambda x: ~x["number"].rlike(r"^\d+(\.\d+)*$")))
    return parsed.groupBy("doc_kind").agg(F.count("*").alias("documents"), F.sum(F.size("p")).alias("paragraphs"), F.sum(odd).alias("not_sortable"), F.count_if(F.size("p") == 0).alias("without"))


_TABLES = ["decisions", "decision_citations", "citation_gaps", "decision_representations", "version_removals", "bge_register", "data_sources", "documents", "embeddings"]


@R.add(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n, count(*) > 0 AS passed FROM {t}" for t in _TABLES))
def qc_tables_present(s: SparkSession, d: str) -> DataFrame:
    """Every table that others depend on is there and not empty."""
    from functools import reduce

    from tessera.session import exists

    parts = [table(s, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n", (c("n") > 0).alias("passed")) if exists(s, f"{d}/{t}.parquet") else s.createDataFrame([(t, 0, False)], "name string, n bigint, passed boolean") for t in _TABLES]
    return reduce(DataFrame.unionByName, parts)


@R.add("""WITH b AS (SELECT court, docket_number FROM (SELECT DISTINCT court, docket_number, source_url FROM decisions WHERE source_url IS NOT NULL) GROUP BY ALL), u AS (SELECT source_url, count(DISTINCT court) AS courts FROM decisions WHERE source_url IS NOT NULL GROUP BY 1) SELECT source_url, courts FROM u WHERE courts > 1""")
def qc_dual_attribution(s: SparkSession, d: str) -> DataFrame:
    """Pages that stand under more than one court."""
    return table(s, d, "decisions", "source_url", "court").where(c("source_url").isNotNull()).groupBy("source_url").agg(F.countDistinct("court").alias("courts")).where("courts > 1")


@R.add("""SELECT month, source, n FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY n DESC, source) AS r FROM (SELECT strftime(scraped_at, '%Y-%m') AS month, coalesce(source, '') AS source, count(*) AS n FROM decisions WHERE scraped_at IS NOT NULL GROUP BY 1, 2)) WHERE r <= 25""")
def agg_37_top_of_each_month(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "decisions", "source", "scraped_at").where(c("scraped_at").isNotNull()).groupBy(F.date_format("scraped_at", "yyyy-MM").alias("month"), F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("month").orderBy(c("n").desc(), "source"))).where("r <= 25").drop("r")


@R.add("""SELECT event_type, max(CASE WHEN i = least(floor(0.5 * n), n - 1) THEN value END) AS p50, max(CASE WHEN i = least(floor(0.95 * n), n - 1) THEN value END) AS p95, max(CASE WHEN i = least(floor(0.99 * n), n - 1) THEN value END) AS p99 FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) GROUP BY 1""")
def agg_49_latencies(s: SparkSession, d: str) -> DataFrame:
    return percentiles(table(s, d, "events", "event_type", "value"), ["event_type"], "value", [0.5, 0.95, 0.99], False)


@R.add(r"""SELECT target_ref, regexp_matches(target_ref, '^\s*(?:\d[A-Z][_. ]\d{1,5}/\d{4}|[A-F]-\d{1,5}/\d{4}|[A-Z]{2}[. ]\d{4}[. ]\d{1,5})\s*$') AS docket FROM citation_gaps WHERE target_ref IS NOT NULL""")
def fts_12_docket_intent(s: SparkSession, d: str) -> DataFrame:
    """Whether a query is a docket and nothing else."""
    return table(s, d, "citation_gaps", "target_ref").where(c("target_ref").isNotNull()).select("target_ref", c("target_ref").rlike(S.DOCKET_INTENT).alias("docket"))


@R.add()
def fts_15_condensed_queries(s: SparkSession, d: str) -> DataFrame:
    """Every document as a query of at most 250 characters."""
    from pyspark.sql.types import StringType

    return table(s, d, "documents", "doc_id", "text").where(F.length("text") > 0).select("doc_id", E.as_udf(S.condense, StringType())(c("text")).alias("query"))


@R.add(_STATUTES.replace("doc_id", "decision_id").replace("text", "regeste").replace("documents", "decisions"))
def fts_13_provisions_of_queries(s: SparkSession, d: str) -> DataFrame:
    """The provisions that a query names, here every head-note."""
    return _decisions(s, d, "regeste").where(c("regeste").isNotNull()).select("decision_id", F.explode(E.statutes(c("regeste"))).alias("r")).select("decision_id", "r.law", "r.article", "r.paragraph", "r.normalised").distinct()


@R.add(f"""SELECT 'ART.' || article || '.' || law AS article, count(*) AS n, count(DISTINCT doc_id) AS docs FROM ({_STATUTES}) GROUP BY 1""")
def agg_10_articles_of_provisions(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs of an article counted as the article, over all rows."""
    return _provisions(s, d).groupBy(F.concat_ws(".", F.lit("ART"), "article", "law").alias("article")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@R.add(f"""WITH a AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, vs in ALIASES.items() for v in vs)}) t(name, law)) SELECT coalesce(name, law) || ' ' || article AS provision, count(DISTINCT doc_id) AS docs FROM ({_STATUTES}) LEFT JOIN a USING (law) GROUP BY 1 ORDER BY docs DESC, provision LIMIT 100""")
def agg_13_top_statutes(s: SparkSession, d: str) -> DataFrame:
    """The articles that most documents cite, whatever language the law's name is in."""
    names = s.createDataFrame([(k, v) for k, vs in ALIASES.items() for v in vs], "name string, law string")
    named = _provisions(s, d).join(F.broadcast(names), "law", "left").select("doc_id", F.concat_ws(" ", F.coalesce("name", "law"), "article").alias("provision"))
    return named.groupBy("provision").agg(F.countDistinct("doc_id").alias("docs")).orderBy(c("docs").desc(), "provision").limit(100)


@R.add(graph_queries._RESOLVED + f"""SELECT method, count(*) AS n, count(*) FILTER (WHERE a.date >= b.date) AS sane, count(*) FILTER (WHERE a.date < b.date) AS backwards FROM resolved r LEFT JOIN (SELECT decision_id, max(CASE WHEN {_ISO.format("decision_date")} THEN decision_date END) AS date FROM decisions GROUP BY 1) a ON a.decision_id = r.source LEFT JOIN (SELECT decision_id, max(CASE WHEN {_ISO.format("decision_date")} THEN decision_date END) AS date FROM decisions GROUP BY 1) b ON b.decision_id = r.target GROUP BY 1""")
def agg_35_precision_by_method(s: SparkSession, d: str) -> DataFrame:
    """Resolved citations by method, and whether the citing decision is the later one."""
    days = _decisions(s, d, "decision_date").groupBy("decision_id").agg(F.max(F.when(c("decision_date").rlike(Q.ISO), c("decision_date"))).alias("day"))
    r = graph_queries._resolved(s, d).join(days.toDF("source", "a"), "source", "left").join(days.toDF("target", "b"), "target", "left")
    return r.groupBy("method").agg(F.count("*").alias("n"), F.count_if(c("a") >= c("b")).alias("sane"), F.count_if(c("a") < c("b")).alias("backwards"))


@R.add("""WITH l AS (SELECT court, count(*) AS live FROM decisions GROUP BY 1), w AS (SELECT court, count(*) AS shadow FROM decisions WHERE has_full_text GROUP BY 1) SELECT court, live, coalesce(shadow, 0) AS shadow, abs(coalesce(shadow, 0) - live) <= 0.02 * live AS passed FROM l LEFT JOIN w USING (court)""")
def agg_55_table_comparison(s: SparkSession, d: str) -> DataFrame:
    """Rows of two states of a table within a tolerance of two percent, court by court."""
    rows = _decisions(s, d, "court", "has_full_text")
    live, shadow = rows.groupBy("court").agg(F.count("*").alias("live")), rows.where("has_full_text").groupBy("court").agg(F.count("*").alias("shadow"))
    both = live.join(shadow, "court", "left").withColumn("shadow", F.coalesce("shadow", F.lit(0).cast("bigint")))
    return both.withColumn("passed", F.abs(c("shadow") - c("live")) <= 0.02 * c("live"))


@R.add(r"""SELECT DISTINCT target_ref, r.decision_id FROM decision_citations JOIN bge_register r ON r.volume = regexp_extract(target_ref, '^(?:BGE|ATF|DTF) (\d+) ([IVX]+[ab]?) (\d+)$', 1)::INT AND r.division = regexp_extract(target_ref, '^(?:BGE|ATF|DTF) (\d+) ([IVX]+[ab]?) (\d+)$', 2) AND r.first_page = regexp_extract(target_ref, '^(?:BGE|ATF|DTF) (\d+) ([IVX]+[ab]?) (\d+)$', 3)::INT WHERE regexp_matches(target_ref, '^(?:BGE|ATF|DTF) (\d+) ([IVX]+[ab]?) (\d+)$')""")
def join_22_series_keys(s: SparkSession, d: str) -> DataFrame:
    """References to the series by volume, division and page in place of a prefix of the id."""
    p = r"^(?:BGE|ATF|DTF) (\d+) ([IVX]+[ab]?) (\d+)$"
    refs = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct()
    keyed = refs.select("target_ref", F.regexp_extract("target_ref", p, 1).cast("int").alias("volume"), F.regexp_extract("target_ref", p, 2).alias("division"), F.regexp_extract("target_ref", p, 3).cast("int").alias("first_page"))
    return keyed.join(table(s, d, "bge_register", "volume", "division", "first_page", "decision_id"), ["volume", "division", "first_page"]).select("target_ref", "decision_id").distinct()


@R.add("""SELECT count(*) AS links, count(*) FILTER (WHERE member_decision_id NOT IN (SELECT decision_id FROM decisions WHERE decision_id IS NOT NULL)) AS orphans, count(*) FILTER (WHERE member_decision_id NOT IN (SELECT decision_id FROM decisions WHERE decision_id IS NOT NULL)) <= 0.01 * count(*) AS passed FROM decision_representations WHERE member_decision_id IS NOT NULL""")
def join_24_orphan_gate(s: SparkSession, d: str) -> DataFrame:
    """Links to records that are not held, of which a hundredth may be."""
    links = table(s, d, "decision_representations", "member_decision_id").where(c("member_decision_id").isNotNull())
    held = _decisions(s, d).distinct().select(c("decision_id").alias("member_decision_id"), F.lit(1).alias("held"))
    n = links.join(held, "member_decision_id", "left").agg(F.count("*").alias("links"), F.count_if(c("held").isNull()).alias("orphans"))
    return n.withColumn("passed", c("orphans") <= 0.01 * c("links"))


_AGENT_NAMES = {"Mozilla/5.0 (compatible; GPTBot/1.0)": "ai_crawler", "Mozilla/5.0 (compatible; Googlebot/2.1)": "search_engine", "AhrefsBot/7.0": "seo", "UptimeRobot/2.0": "monitor", "curl/8.4": "script", "python-requests/2.31": "script", "HeadlessChrome/120": "headless", "SomeBot/1": "bot", "Mozilla/5.0 (iPhone)": "mobile", "Mozilla/5.0 (X11)": "browser", "xyz": "other", "": "none"}


@R.add("SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 12 " + " ".join(f"WHEN {n} THEN '{k}'" for n, k in enumerate(_AGENT_NAMES.values())) + " END AS kind FROM events) GROUP BY 1")
def prj_13_agent_classes(s: SparkSession, d: str) -> DataFrame:
    """Visitors by the kind that their agent tells; the agents are dealt out to the events."""
    agents = F.array(*[F.lit(a) for a in _AGENT_NAMES])
    return table(s, d, "events", "event_id").groupBy(T.agent_class(F.get(agents, (c("event_id") % 12).cast("int"))).alias("kind")).agg(F.count("*").alias("n"))


@R.add("""SELECT 'critical' AS severity, 'broken' AS "check", false AS passed UNION ALL SELECT 'critical', 'corpus_total_count', true""")
def udf_04_broken_check(s: SparkSession, d: str) -> DataFrame:
    """A check that can't be worked out is a critical failure, and the others are run all the same."""
    checks = [k for k in Q.decision_checks("2024-12-31") if k.name == "corpus_total_count"] + [Q.Check("broken", F.sum("no_such_column"), 0)]
    return Q.run(_decisions(s, d), checks).select("severity", "check", "passed")


@R.add("""SELECT true AS graph_is_safe, false AS decisions_are_safe""")
def udf_05_safe_to_publish(s: SparkSession, d: str) -> DataFrame:
    """The gate on the reports of two tables: repeated ids are critical."""
    graph = Q.run(table(s, d, "decision_citations"), Q.discovered("graph_checks"))
    own = Q.run(table(s, d, "decisions"), Q.discovered("decision_checks", critical_only=True))
    return s.createDataFrame([(Q.safe_to_publish(graph), Q.safe_to_publish(own))], "graph_is_safe boolean, decisions_are_safe boolean")


@R.add()
def udf_06_weight_search(s: SparkSession, d: str) -> DataFrame:
    """Column weights tried against titles as queries: the weights and how well they rank the titles' own records."""
    from tessera.plans.search_queries import decisions_index

    titles = _decisions(s, d, "title").where(F.length("title") > 8).groupBy("title").agg(F.min("decision_id").alias("doc"), F.count_distinct("decision_id").alias("n"))
    asked = [(r["title"], r["doc"]) for r in titles.orderBy("n", "title").limit(5).collect()]
    grid = [{"title": t, "regeste": 5.0, "full_text": 1.2} for t in (1.0, 6.0)]
    return S.tuned(decisions_index(s, d), asked, grid)


@R.add("""SELECT DISTINCT doc_id AS doc FROM documents WHERE list_contains(string_split_regex(lower(docket_number), '[^\\p{L}\\p{N}]+'), 'ca')""".replace("\\\\", "\\"))
def fts_02_column_focus(s: SparkSession, d: str) -> DataFrame:
    """A query that looks into one column only."""
    index = S.kept_index(table(s, d, "documents", "doc_id", "docket_number", "doc_kind"), "dockets", "doc_id", ["docket_number", "doc_kind"])
    return S.match(index, S.parse("docket_number: CA"))


@R.add("""WITH a AS (SELECT decision_id, max(coalesce(content_hash, '')) AS h, max(court || '|' || coalesce(docket_number, '')) AS p FROM decisions WHERE scraped_at < TIMESTAMP '2023-12-01' GROUP BY 1), b AS (SELECT decision_id, max(coalesce(content_hash, '')) AS h, max(CASE WHEN has_full_text THEN court ELSE 'x' END || '|' || coalesce(docket_number, '')) AS p FROM decisions WHERE court <> 'ti_gerichte' GROUP BY 1)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN a.decision_id IS NULL THEN 'added' WHEN b.decision_id IS NULL THEN 'removed' WHEN a.h <> b.h THEN 'changed' WHEN a.p <> b.p THEN 'moved' ELSE 'same' END AS state FROM a FULL JOIN b USING (decision_id)) GROUP BY 1""")
def agg_42_churn_with_moves(s: SparkSession, d: str) -> DataFrame:
    """Records added, removed, changed or moved to another court or docket between two states; in the later one those without a text stand elsewhere."""
    from tessera.operators.incremental import churn

    rows = _decisions(s, d, "court", "docket_number", "content_hash", "has_full_text", "scraped_at").withColumn("h", F.coalesce("content_hash", F.lit("")))
    place = lambda court: F.concat(court, F.lit("|"), F.coalesce("docket_number", F.lit("")))
    state = lambda df, court: df.groupBy("decision_id").agg(F.max("h").alias("digest"), F.max(place(court)).alias("place"))
    old = state(rows.where(c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")), c("court"))
    new = state(rows.where("court <> 'ti_gerichte'"), F.when(c("has_full_text"), c("court")).otherwise("x"))
    return churn(old, new, "decision_id").groupBy("state").agg(F.count("*").alias("n"))


_TYPE = r"""CASE WHEN regexp_matches(upper(trim(target_ref)), '^(?:(?:BGE|ATF|DTF) )?\d{1,3} [IVX]{1,4}[AB]? \d{1,4}$') THEN 'bge' WHEN regexp_matches(target_ref, '\d{4}') THEN 'docket' ELSE 'other' END"""


@R.add(f"""SELECT coalesce(target_type, '') AS before, {_TYPE} AS now, CASE WHEN target_type IS NULL THEN 'resolved' WHEN target_type = {_TYPE} THEN 'same' ELSE 'retyped' END AS change, count(*) AS n FROM decision_citations WHERE coalesce(trim(target_ref), '') <> '' GROUP BY 1, 2, 3""")
def agg_43_type_transitions(s: SparkSession, d: str) -> DataFrame:
    """What kind of reference each one was taken for, and is taken for now."""
    x = table(s, d, "decision_citations", "target_ref", "target_type").where(F.coalesce(F.trim("target_ref"), F.lit("")) != "")
    now = F.when(F.upper(F.trim("target_ref")).rlike(r"^(?:(?:BGE|ATF|DTF) )?\d{1,3} [IVX]{1,4}[AB]? \d{1,4}$"), "bge").when(c("target_ref").rlike(r"\d{4}"), "docket").otherwise("other")
    change = F.when(c("target_type").isNull(), "resolved").when(c("target_type") == c("now"), "same").otherwise("retyped")
    return x.withColumn("now", now).groupBy(F.coalesce("target_type", F.lit("")).alias("before"), "now", change.alias("change")).agg(F.count("*").alias("n"))


@R.add("""WITH h AS (SELECT regexp_extract(source_url, '^https?://([^/]+)', 1) AS host, count(*) FILTER (WHERE starts_with(source_url, 'http://')) AS plain, count(*) FILTER (WHERE starts_with(source_url, 'https://')) AS safe FROM decisions WHERE source_url IS NOT NULL GROUP BY 1) SELECT host, plain, safe, NOT (plain > 0 AND safe > 0) AS passed FROM h""")
def qc_http_beside_https(s: SparkSession, d: str) -> DataFrame:
    """Hosts that are named without encryption though they offer it."""
    rows = table(s, d, "decisions", "source_url").where(c("source_url").isNotNull())
    n = rows.groupBy(F.regexp_extract("source_url", "^https?://([^/]+)", 1).alias("host")).agg(F.count_if(c("source_url").startswith("http://")).alias("plain"), F.count_if(c("source_url").startswith("https://")).alias("safe"))
    return n.withColumn("passed", ~((c("plain") > 0) & (c("safe") > 0)))


@R.add("""SELECT count(*) AS records, count(*) AS good FROM decisions""")
def qc_citation_exports(s: SparkSession, d: str) -> DataFrame:
    """Both citation formats of every record, read back: as many have their id, fields and end as there are records."""
    from tessera.sources import writers

    cols = {"id": c("decision_id"), "court": c("court"), "docket": c("docket_number"), "date": c("decision_date"), "url": c("source_url")}
    rows = _decisions(s, d, "court", "docket_number", "decision_date", "source_url").select("decision_id", "court", "source_url", writers.bibtex(cols).alias("b"), writers.ris(cols).alias("r"))
    id_back = F.regexp_extract("b", r"^@misc\{([^,]+),", 1) == c("decision_id")
    url_back = F.regexp_extract("b", r"(?s)url = \{(.*?)\}\n\}$", 1) == F.coalesce("source_url", F.lit(""))
    ris_back = c("r").startswith("TY  - CASE\n") & c("r").endswith("ER  - ") & (F.regexp_extract("r", r"(?m)^AU  - (.*)$", 1) == c("court"))
    return rows.agg(F.count("*").alias("records"), F.count_if(id_back & url_back & ris_back).alias("good"))


@R.add(_POSTINGS + """SELECT 'all' AS strategy, count(*) AS docs FROM (SELECT doc FROM p WHERE term IN ('beschwerde', 'gericht', 'mangel') GROUP BY 1 HAVING count(*) = 3) UNION ALL SELECT 'any', count(DISTINCT doc) FROM p WHERE term IN ('beschwerde', 'gericht', 'mangel') UNION ALL SELECT 'begins', count(DISTINCT doc) FROM p WHERE starts_with(term, 'beschwer') UNION ALL SELECT 'phrase', count(DISTINCT a.doc) FROM tok a JOIN tok b ON a.doc = b.doc AND b.place = a.place + 1 WHERE a.term = 'das' AND b.term = 'gericht'""")
def fts_09_strategies(s: SparkSession, d: str) -> DataFrame:
    """One question asked in several ways: all words, any, a beginning, a phrase."""
    from functools import reduce

    from tessera.plans.search_queries import WORDS, _index

    index = _index(s, d)
    asked = {"all": S.Query(must=WORDS), "any": S.Query(may=WORDS), "begins": S.Query(prefixes=["beschwer"]), "phrase": S.Query(phrases=[["das", "gericht"]])}
    return reduce(DataFrame.unionByName, [S.match(index, q).agg(F.count("*").alias("docs")).select(F.lit(n).alias("strategy"), "docs") for n, q in asked.items()])


@R.add("""SELECT count(*) AS first_run, 0 AS second_run FROM events""")
def inc_01_file_stream(s: SparkSession, d: str) -> DataFrame:
    """A stream over files that its checkpoint remembers: a second run finds nothing new."""
    from tessera.session import scratch
    from tessera.streaming import counters as C

    out = scratch(s, "io")
    stream = lambda: s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d).select("event_id")
    first = C.run_available(stream(), "rows", "append", out).count()
    return s.createDataFrame([(first, C.run_available(stream(), "rows", "append", out).count() - first)], "first_run bigint, second_run bigint")


@R.add("""SELECT decision_id, arg_min(v, (coalesce(scraped_at, TIMESTAMP '9999-12-31'), v)) AS headnote FROM (SELECT decision_id, scraped_at, regeste AS v FROM decisions WHERE decision_id IS NOT NULL AND lower(trim(regeste)) NOT IN ('', 'none', 'n/a', '-')) GROUP BY 1""")
def srv_get_headnotes(s: SparkSession, d: str) -> DataFrame:
    """The head-note of each decision: the first one that says anything."""
    rows = _decisions(s, d, "regeste", "scraped_at").where(c("decision_id").isNotNull() & ~F.lower(F.trim("regeste")).isin("", "none", "n/a", "-"))
    at = F.struct(F.coalesce("scraped_at", F.lit("9999-12-31").cast("timestamp_ntz")), "regeste")
    return rows.groupBy("decision_id").agg(F.min_by("regeste", at).alias("headnote"))


@R.add()
def srv_get_paragraphs(s: SparkSession, d: str) -> DataFrame:
    """The paragraphs that head-notes refer to by number, of every decision: number and text hash."""
    from pyspark.sql.types import ArrayType, StringType

    hints = _decisions(s, d, "regeste").where(c("regeste").isNotNull()).select("decision_id", F.explode(E.as_udf(E.paragraph_hints, ArrayType(StringType()))(c("regeste"))).alias("number")).distinct()
    found = _decisions(s, d, "full_text").where(c("full_text").isNotNull()).select("decision_id", F.explode(E.paragraphs_udf()(c("full_text"))).alias("p")).select("decision_id", "p.number", F.md5("p.text").alias("text_hash")).distinct()
    return hints.join(found, ["decision_id", "number"], "left")


@R.add(graph_queries._RESOLVED + """, best AS (SELECT source, ref, max(confidence) AS confidence, count(*) AS targets FROM resolved WHERE confidence >= 0.5 GROUP BY 1, 2), r AS (SELECT DISTINCT source, ref FROM refs)
SELECT r.source, r.ref, round(confidence, 4) AS confidence, coalesce(targets, 0) AS targets FROM r LEFT JOIN best USING (source, ref)""")
def srv_find_citations(s: SparkSession, d: str) -> DataFrame:
    """Every reference of every decision with its surest target's confidence from one half up; those without one stay, unresolved."""
    found = graph_queries._resolved(s, d).where("confidence >= 0.5").groupBy("source", "ref").agg(F.max("confidence").alias("confidence"), F.count("*").alias("targets"))
    refs = table(s, d, "decision_citations", "source_decision_id", "target_ref").where(c("target_ref").isNotNull() & c("source_decision_id").isNotNull()).toDF("source", "ref").distinct()
    return refs.join(found, ["source", "ref"], "left").select("source", "ref", F.round("confidence", 4).alias("confidence"), F.coalesce("targets", F.lit(0).cast("bigint")).alias("targets"))


@R.add(_BM25 + "SELECT doc, round(score, 6) AS score FROM scored JOIN documents ON doc_id = doc WHERE court = 'bger' AND fetched_at >= TIMESTAMP '2023-02-01' ORDER BY scored.score, doc LIMIT 20 OFFSET 5")
def srv_search_filtered(s: SparkSession, d: str) -> DataFrame:
    """A page of hits of one court and period."""
    from tessera.plans.search_queries import WORDS, _index

    fit = table(s, d, "documents", "doc_id", "court", "fetched_at").where((c("court") == "bger") & (c("fetched_at") >= F.lit("2023-02-01").cast("timestamp_ntz"))).select(c("doc_id").alias("doc"))
    hits = S.bm25(_index(s, d), WORDS).join(fit, "doc", "left_semi")
    return hits.orderBy("score", "doc").offset(5).limit(20).select("doc", F.round("score", 6).alias("score"))


@R.add("""SELECT b.volume AS law, b.division || ' ' || b.first_page AS article, b.decision_id FROM bge_register b JOIN (SELECT DISTINCT target_ref FROM citation_gaps) g ON g.target_ref = b.bge_reference""")
def srv_get_law(s: SparkSession, d: str) -> DataFrame:
    """Articles of a store looked up by the references that ask for them."""
    store = table(s, d, "bge_register", "bge_reference", "volume", "division", "first_page", "decision_id")
    asked = table(s, d, "citation_gaps", "target_ref").toDF("bge_reference").distinct()
    return store.join(asked, "bge_reference", "left_semi").select(c("volume").alias("law"), F.concat_ws(" ", "division", "first_page").alias("article"), "decision_id")


@R.add(graph_queries._RESOLVED + f"""SELECT method, CASE WHEN a.y IS NULL OR b.y IS NULL THEN 'uncertain' WHEN a.y < b.y THEN 'wrong' ELSE 'correct' END AS verdict, count(*) AS n FROM resolved r LEFT JOIN (SELECT decision_id, max(try_cast(left(decision_date, 4) AS INT)) AS y FROM decisions WHERE {_ISO.format("decision_date")} GROUP BY 1) a ON a.decision_id = r.source LEFT JOIN (SELECT decision_id, max(try_cast(left(decision_date, 4) AS INT)) AS y FROM decisions WHERE {_ISO.format("decision_date")} GROUP BY 1) b ON b.decision_id = r.target GROUP BY 1, 2""")
def agg_51_adjudicated_citations(s: SparkSession, d: str) -> DataFrame:
    """Resolved citations by method and verdict: wrong if the target is of a later year, uncertain if a date is missing."""
    years = _decisions(s, d, "decision_date").where(c("decision_date").rlike(Q.ISO)).groupBy("decision_id").agg(F.max(F.substring("decision_date", 1, 4).cast("int")).alias("y"))
    r = graph_queries._resolved(s, d).join(years.toDF("source", "a"), "source", "left").join(years.toDF("target", "b"), "target", "left")
    verdict = F.when(c("a").isNull() | c("b").isNull(), "uncertain").when(c("a") < c("b"), "wrong").otherwise("correct")
    return r.groupBy("method", verdict.alias("verdict")).agg(F.count("*").alias("n"))


@R.add("SELECT name, array_to_string(list_sort(list(DISTINCT law)), ',') AS aliases, sum(n)::BIGINT AS n FROM (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, vs in ALIASES.items() for v in vs) + f""") t(name, law)) a JOIN (SELECT law, count(*) AS n FROM ({_STATUTES}) GROUP BY 1) USING (law) GROUP BY 1""")
def agg_52_law_codes(s: SparkSession, d: str) -> DataFrame:
    """The table of laws: the abbreviations of each that texts use, and how often."""
    names = s.createDataFrame([(k, v) for k, vs in ALIASES.items() for v in vs], "name string, law string")
    used = _provisions(s, d).groupBy("law").agg(F.count("*").alias("n")).join(F.broadcast(names), "law")
    return used.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("law")), ",").alias("aliases"), F.sum("n").alias("n"))


@R.add(r"""WITH k AS (SELECT DISTINCT regexp_replace(lower(docket_number), '[^a-z0-9]+', '', 'g') AS key FROM decisions WHERE docket_number IS NOT NULL) SELECT coalesce(classification, '') AS classification, CASE WHEN k.key IS NOT NULL THEN 'present_under_other_spelling' ELSE 'missing' END AS refined, count(*) AS n FROM (SELECT *, regexp_replace(lower(target_ref), '[^a-z0-9]+', '', 'g') AS key FROM citation_gaps WHERE target_ref IS NOT NULL) g LEFT JOIN k USING (key) GROUP BY 1, 2""")
def agg_53_gaps_by_spelling(s: SparkSession, d: str) -> DataFrame:
    """Gaps that turn out to be held under another spelling."""
    squeezed = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]+", "")
    held = table(s, d, "decisions", "docket_number").where(c("docket_number").isNotNull()).select(squeezed("docket_number").alias("key")).distinct().withColumn("held", F.lit(1))
    gaps = table(s, d, "citation_gaps", "target_ref", "classification").where(c("target_ref").isNotNull()).withColumn("key", squeezed("target_ref"))
    refined = F.when(c("held").isNotNull(), "present_under_other_spelling").otherwise("missing")
    return gaps.join(held, "key", "left").groupBy(F.coalesce("classification", F.lit("")).alias("classification"), refined.alias("refined")).agg(F.count("*").alias("n"))


@R.add("""SELECT o_orderkey AS id FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20""")
def snk_20_atom_feed(s: SparkSession, d: str) -> DataFrame:
    """The newest orders as an Atom feed, read back as XML."""
    from tessera.session import scratch
    from tessera.sources import writers

    rows = table(s, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice").orderBy(c("o_orderdate").desc(), c("o_orderkey").desc()).limit(20).collect()
    feed = writers.atom([{"title": str(r["o_totalprice"]), "link": f"https://example.org/{r['o_orderkey']}", "date": str(r["o_orderdate"])} for r in rows], "Orders", "https://example.org")
    out = scratch(s, "io")
    s.createDataFrame([(feed,)], "value string").coalesce(1).write.text(out)
    return s.read.schema("id string").option("rowTag", "entry").xml(out).select(F.regexp_extract("id", r"(\d+)$", 1).cast("bigint").alias("id"))
