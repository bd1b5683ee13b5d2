"""Queries of the functions on heads of documents, and of the served operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import documents as D
from tessera.functions import text as T
from tessera.operators import search as S
from tessera.plans.registry import Registry
from tessera.plans.scalar_queries import graph_docket_sql
from tessera.sources.tables import first_versions, table

R = Registry()
c = F.col


def _d(s: SparkSession, d: str, *columns: str) -> DataFrame:
    """Rows as they are; what is made of them is made distinct afterwards, so that no text is moved for it."""
    return table(s, d, "decisions", "decision_id", *columns)


@R.add()
def scl_09_header_date(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "full_text").where(c("full_text").isNotNull()).select("decision_id", D.header_date(c("full_text")).alias("h")).select("decision_id", "h.day", "h.method").distinct()


@R.add(r"""SELECT DISTINCT doc_id, CASE WHEN m <> '' THEN strftime(try_cast(regexp_extract(m, '(\d{2})\.(\d{2})\.(\d{4})', 3) || '-' || regexp_extract(m, '(\d{2})\.(\d{2})\.(\d{4})', 2) || '-' || regexp_extract(m, '(\d{2})\.(\d{2})\.(\d{4})', 1) AS DATE), '%Y-%m-%d') END AS day FROM (SELECT doc_id, regexp_extract(text, '\b\d{2}\.\d{2}\.\d{4}\b', 0) AS m FROM documents WHERE text IS NOT NULL)""")
def scl_10_first_dotted_date(s: SparkSession, d: str) -> DataFrame:
    m = F.regexp_extract("text", r"\b\d{2}\.\d{2}\.\d{4}\b", 0)
    return table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", F.when(m != "", D.first_date(m)).alias("day"))


@R.add(r"""SELECT DISTINCT decision_id, CASE WHEN try_cast(left(decision_date, 4) AS INT) < y - 3 THEN NULL ELSE decision_date END AS day FROM (SELECT *, CASE WHEN n BETWEEN 1800 AND 2100 THEN n END AS y FROM (SELECT *, coalesce(nullif(regexp_extract(docket_number, '[/_. ](\d{4})$', 1), ''), nullif(regexp_extract(docket_number, '^[A-Z]{1,6}[._ ](\d{4})[._ ]', 1), ''))::INT AS n FROM decisions WHERE regexp_matches(decision_date, '^\d{4}-\d{2}-\d{2}$')))""")
def scl_12_veto_by_docket(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "decision_date", "docket_number").where(c("decision_date").rlike(r"^\d{4}-\d{2}-\d{2}$")).select("decision_id", D.not_before_docket(c("decision_date"), T.docket_year(c("docket_number"))).alias("day")).distinct()


@R.add()
def scl_14_best_date(s: SparkSession, d: str) -> DataFrame:
    b = D.best_date(c("decision_date"), D.header_date(c("full_text"))["day"])
    return _d(s, d, "decision_date", "full_text").select("decision_id", b.alias("b")).select("decision_id", "b.day", "b.method").distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN length(trim(regeste)) >= 20 THEN regeste ELSE left(full_text, 500) END AS chosen FROM decisions""")
def scl_62_embedding_text(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "regeste", "full_text").select("decision_id", D.embedding_text(c("regeste"), c("full_text")).alias("chosen")).distinct()


@R.add()
def scl_18_headnote(s: SparkSession, d: str) -> DataFrame:
    """The head-note that stands in a document, by its hash."""
    return table(s, d, "documents", "doc_id", "text").select("doc_id", D.headnote(c("text")).alias("h")).where(c("h").isNotNull()).select("doc_id", F.length("h").alias("n_chars"), F.md5("h").alias("headnote_hash"))


@R.add("""SELECT DISTINCT decision_id, coalesce(CASE WHEN regexp_matches(docket_number, '^[67][A-Z][_.]') OR court = 'bstger' THEN 'criminal' WHEN regexp_matches(docket_number, '^[89]C[_.]') THEN 'social_security' WHEN regexp_matches(docket_number, '^[45][A-Z][_.]') THEN 'private' END,
 CASE WHEN regexp_matches(l, 'straf|pénal|penal') THEN 'criminal' WHEN regexp_matches(l, 'sozialversicherung|assurances? sociales?|assicurazioni sociali|invalid') THEN 'social_security' WHEN regexp_matches(l, 'steuer|fiscal|impôt|tassazione') THEN 'tax' WHEN regexp_matches(l, 'migration|ausländer|étranger|stranier|asyl') THEN 'migration' WHEN regexp_matches(l, 'zivil|civil|miet|kauf|famil|erb') THEN 'private' END) AS branch FROM (SELECT *, lower(coalesce(legal_area, '')) AS l FROM decisions)""")
def scl_32_branch(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "court", "docket_number", "legal_area").select("decision_id", D.branch(c("court"), c("docket_number"), c("legal_area")).alias("branch")).distinct()


@R.add()
def scl_33_chamber(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "docket_number").distinct().groupBy(D.chamber(c("docket_number")).alias("chamber")).agg(F.count("*").alias("n"))


@R.add(r"""SELECT DISTINCT docket_number, CASE WHEN l = '' OR l IS NULL THEN NULL WHEN contains(docket_number, '.') OR y < 2007 THEN 'old_' || lower(l) WHEN l = 'A' THEN 'civil_or_public' WHEN l = 'B' THEN 'criminal' WHEN l = 'C' THEN 'public' WHEN l = 'D' THEN 'constitutional' ELSE 'other' END AS kind FROM (SELECT docket_number, regexp_extract(docket_number, '^\d([A-Z])[_.]', 1) AS l, try_cast(nullif(regexp_extract(docket_number, '/(\d{4})$', 1), '') AS INT) AS y FROM decisions)""")
def scl_34_proceeding(s: SparkSession, d: str) -> DataFrame:
    year = F.nullif(F.regexp_extract("docket_number", r"/(\d{4})$", 1), F.lit("")).try_cast("int")
    return table(s, d, "decisions", "docket_number").distinct().select("docket_number", D.proceeding(c("docket_number"), year).alias("kind"))


@R.add()
def scl_36_appealed(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decisions", "decision_id", "full_text").select("decision_id", D.appealed(c("full_text")).alias("a"))
    return x.where(c("a").isNotNull()).select("decision_id", "a.court", "a.docket").distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN y IS NOT NULL THEN concat_ws(':', 'ECLI:CH', upper(replace(lower(court), '_', '')), y::VARCHAR, upper(replace(regexp_replace(lower(trim(docket_number)), '[^a-z0-9]+', '-', 'g'), '-', '.'))) END AS ecli, 'https://example.org/' || lower(court) || '/' || regexp_replace(lower(trim(docket_number)), '[^a-z0-9]+', '-', 'g') AS url FROM (SELECT *, try_cast(nullif(regexp_extract(decision_date, '^([0-9]{4})-', 1), '') AS INT) AS y FROM decisions)""")
def scl_40_identifier_conversion(s: SparkSession, d: str) -> DataFrame:
    year = F.nullif(F.regexp_extract("decision_date", "^([0-9]{4})-", 1), F.lit("")).cast("int")
    return _d(s, d, "court", "docket_number", "decision_date").select("decision_id", D.ecli_of_national_id(T.national_id(c("court"), c("docket_number")), year).alias("ecli"), D.url_of_national_id(T.national_id(c("court"), c("docket_number"))).alias("url")).distinct()


@R.add(r"""SELECT doc_id, left(trim(regexp_replace(substring(text, greatest(1, pos - 60), 123), '\s+', ' ', 'g'), ' '), 140) AS snippet FROM (SELECT doc_id, text, instr(text, 'BGE') AS pos FROM documents) WHERE pos > 0""")
def scl_48_citation_snippet(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text").select("doc_id", D.citation_snippet(c("text"), F.lit("BGE")).alias("snippet")).where(c("snippet").isNotNull())


@R.add()
def scl_50_change_kind(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "full_text", "content_text").where("full_text is not null and content_text is not null").select("decision_id", D.change_kind(c("full_text"), c("content_text")).alias("kind")).distinct()


@R.add("""SELECT count(*) FILTER (WHERE regexp_matches(full_text, '[\\w.+-]+@[\\w-]+\\.[A-Za-z]{2,}')) AS emails, count(*) FILTER (WHERE regexp_matches(full_text, 'CHE-\\d{3}\\.\\d{3}\\.\\d{3}')) AS companies FROM decisions""".replace("\\\\", "\\"))
def scl_51_guard(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "decisions", "full_text").select(D.guard(c("full_text")).alias("g"))
    return g.agg(F.count_if(F.array_contains("g", "EMAIL")).alias("emails"), F.count_if(F.array_contains("g", "CHE")).alias("companies"))


@R.add("""WITH r AS (SELECT DISTINCT docket_number, decision_id, decision_date FROM decisions WHERE docket_number IS NOT NULL), k AS (SELECT docket_number, min(decision_id) AS one, arg_min(decision_date, decision_id) FILTER (WHERE decision_date IS NOT NULL) AS x FROM r GROUP BY 1), f AS (SELECT docket_number, one, max(r.decision_date) AS d1 FROM k JOIN r USING (docket_number) WHERE r.decision_id = one GROUP BY 1, 2)
SELECT one, decision_id AS two FROM f JOIN r USING (docket_number) WHERE one <> decision_id AND (d1 IS NULL OR decision_date IS NULL OR d1 = decision_date OR starts_with(d1, '1905-') OR starts_with(decision_date, '1905-'))""")
def scl_53_compatible_dates(s: SparkSession, d: str) -> DataFrame:
    """Every record against the first of its docket, not all pairs of a docket."""
    rows = table(s, d, "decisions", "docket_number", "decision_id", "decision_date").where(c("docket_number").isNotNull()).distinct()
    first = rows.groupBy("docket_number", "decision_id").agg(F.max("decision_date").alias("d1")).groupBy("docket_number").agg(F.min_by(F.struct(c("decision_id").alias("one"), "d1"), "decision_id").alias("f")).select("docket_number", "f.one", "f.d1")
    return rows.join(first, "docket_number").where((c("one") != c("decision_id")) & D.compatible(c("d1"), c("decision_date"))).select("one", c("decision_id").alias("two"))


@R.add(rf"""SELECT family, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(k, '^(?:BGE|ATF|DTF) ') THEN 'series' WHEN regexp_matches(k, '^\d{{1,3}} [IVX]+ \d+$') THEN 'bare_series' WHEN regexp_matches(k, '^[1-9][A-Z]_\d') THEN 'bger' WHEN regexp_matches(k, '^[A-F]_\d{{1,6}}_\d{{4}}$') THEN 'bvger' WHEN regexp_matches(k, '^(?:BB|BG|BH|BK|BN|BP|CA|CB|CR|RR|SK|SN|SP|TP)_') THEN 'bstger' WHEN regexp_matches(k, '\d{{4}}') THEN 'docket' ELSE 'other' END AS family FROM (SELECT {graph_docket_sql("target_ref")} AS k FROM decision_citations)) GROUP BY 1""")
def scl_59_parser_family(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").groupBy(D.parser_family(c("target_ref")).alias("family")).agg(F.count("*").alias("n"))


@R.add(r"""SELECT DISTINCT x.target_ref, CASE WHEN v.hi IS NULL THEN 'volume' WHEN v2.hi IS NULL THEN 'division' WHEN p > v2.hi + 30 THEN 'page' ELSE 'possible' END AS anomaly FROM (SELECT target_ref, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 1)::INT AS vol, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 2) AS dv, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 3)::INT AS p FROM decision_citations WHERE regexp_matches(target_ref, '^BGE (\d+) ([IV]+) (\d+)$')) x LEFT JOIN (SELECT volume, max(first_page) AS hi FROM bge_register GROUP BY 1) v ON v.volume = vol LEFT JOIN (SELECT volume, division, max(first_page) AS hi FROM bge_register GROUP BY 1, 2) v2 ON v2.volume = vol AND v2.division = dv""")
def scl_60_series_anomaly(s: SparkSession, d: str) -> DataFrame:
    p = r"^BGE (\d+) ([IV]+) (\d+)$"
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct().select("target_ref", *[F.regexp_extract("target_ref", p, i).alias(n) for i, n in ((1, "vol"), (2, "division"), (3, "p"))]).withColumn("volume", c("vol").cast("int"))
    b = table(s, d, "bge_register", "volume", "division", "first_page")
    v = b.groupBy("volume").agg(F.max("first_page").alias("hi"))
    v2 = b.groupBy("volume", "division").agg(F.max("first_page").alias("hi2"))
    return x.join(v, "volume", "left").join(v2, ["volume", "division"], "left").select("target_ref", F.when(c("hi").isNull(), "volume").when(c("hi2").isNull(), "division").when(c("p").cast("int") > c("hi2") + 30, "page").otherwise("possible").alias("anomaly"))


@R.add()
def scl_31_headnote_language(s: SparkSession, d: str) -> DataFrame:
    return _d(s, d, "regeste").select("decision_id", D.headnote_language(c("regeste")).alias("lang"), F.md5("regeste").alias("h")).distinct().groupBy("lang").agg(F.count("*").alias("n"))


@R.add("""SELECT k.decision_id, h.decision_id IS NOT NULL AS held, count(x.target_ref) FILTER (WHERE is_prior_instance = 1) AS priors, count(DISTINCT target_ref) AS refs FROM (SELECT DISTINCT member_decision_id AS decision_id FROM decision_representations WHERE member_decision_id IS NOT NULL) k LEFT JOIN (SELECT DISTINCT decision_id FROM decisions) h USING (decision_id) LEFT JOIN decision_citations x ON x.source_decision_id = k.decision_id GROUP BY 1, 2""")
def srv_get_decisions(s: SparkSession, d: str) -> DataFrame:
    """A batch of ids asked for, those that are not held included."""
    ids = table(s, d, "decision_representations", "member_decision_id").select(c("member_decision_id").alias("decision_id")).where(c("decision_id").isNotNull()).distinct()
    held = table(s, d, "decisions", "decision_id").distinct().withColumn("held", F.lit(True))
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref", "is_prior_instance").withColumnRenamed("source_decision_id", "decision_id").groupBy("decision_id").agg(F.count_if((c("is_prior_instance") == 1) & c("target_ref").isNotNull()).alias("priors"), F.countDistinct("target_ref").alias("refs"))
    none = F.lit(0).cast("bigint")
    return ids.join(held, "decision_id", "left").join(x, "decision_id", "left").select("decision_id", F.coalesce("held", F.lit(False)).alias("held"), F.coalesce("priors", none).alias("priors"), F.coalesce("refs", none).alias("refs"))


@R.add("""SELECT court, canton, left(decision_date, 4) AS y, count(DISTINCT decision_id) AS n FROM decisions WHERE regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') GROUP BY 1, 2, 3""")
def srv_get_statistics(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court", "canton", "decision_date").where(c("decision_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).groupBy("court", "canton", F.substring("decision_date", 1, 4).alias("y")).agg(F.countDistinct("decision_id").alias("n"))


@R.add(r"""SELECT DISTINCT k AS citation, decision_id, decision_id IS NOT NULL AS supported FROM (SELECT DISTINCT regexp_replace(upper(trim(target_ref)), '^(?:ATF|DTF) ', 'BGE ') AS k FROM citation_gaps WHERE target_ref IS NOT NULL) LEFT JOIN bge_register ON bge_reference = k""")
def srv_cite(s: SparkSession, d: str) -> DataFrame:
    """Whether each reference once recorded as unresolved is in the published series."""
    asked = table(s, d, "citation_gaps", "target_ref").where(c("target_ref").isNotNull()).select(F.regexp_replace(F.upper(F.trim("target_ref")), r"^(?:ATF|DTF) ", "BGE ").alias("citation")).distinct()
    found = asked.join(table(s, d, "bge_register", "bge_reference", "decision_id").withColumnRenamed("bge_reference", "citation"), "citation", "left")
    return found.select("citation", "decision_id", c("decision_id").isNotNull().alias("supported")).distinct()


@R.add()
def srv_search_decisions(s: SparkSession, d: str) -> DataFrame:
    from tessera.plans.search_queries import decisions_index

    index = decisions_index(s, d)
    q = S.parse("Kündigung Mietvertrag")
    every = S.ranked(S.bm25(index, q.must, S.COLUMN_WEIGHTS), c("score"), 100)
    title = S.ranked(S.bm25(index, q.must, focus="title"), c("score"), 100)
    strict = S.ranked(S.match(index, q), c("doc"), 100)
    fused = S.fuse([(every, 1.5), (title, 0.95), (strict, 1.3)])
    shown = first_versions(table(s, d, "decisions", "decision_id", "scraped_at", "court", "title"), "court", "title").select(c("decision_id").alias("doc"), "court", "title")
    return shown.join(F.broadcast(fused), "doc").orderBy(c("score").desc(), "doc").limit(20)


@R.add()
def fts_25_interleaved_corpora(s: SparkSession, d: str) -> DataFrame:
    """The best hits of two corpora, taken in turn: corpus, rank, doc."""
    from tessera.plans.search_queries import _index, decisions_index

    words = S.parse("Beschwerde Mangel").must
    lists = {"decisions": S.bm25(decisions_index(s, d), words), "documents": S.bm25(_index(s, d), words).withColumn("doc", c("doc").cast("string"))}
    return S.interleaved(lists, 20)


@R.add("""SELECT event_type, count(DISTINCT event_id) AS exact, true AS within FROM events GROUP BY 1""")
def agg_23_hll_p14(s: SparkSession, d: str) -> DataFrame:
    """Exact counts, and whether the sketch's estimate is within three standard errors (1.04 / sqrt(2^14)) of them."""
    e = table(s, d, "events", "event_type", "event_id").groupBy("event_type").agg(F.countDistinct("event_id").alias("exact"), F.hll_sketch_estimate(F.hll_sketch_agg("event_id", 14)).alias("n"))
    return e.select("event_type", "exact", (F.abs(c("n") - c("exact")) <= F.greatest(F.lit(1.0), c("exact") * 3 * 1.04 / 128)).alias("within"))


@R.add("""SELECT n_name, o_orderkey, o_totalprice FROM (SELECT n_name, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY n_name ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) WHERE r <= 3""")
def top_04_feed_per_group(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "orders", "o_orderkey", "o_custkey", "o_totalprice").join(table(s, d, "customer", "c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey")).join(table(s, d, "nation", "n_nationkey", "n_name"), c("c_nationkey") == c("n_nationkey"))
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("n_name").orderBy(c("o_totalprice").desc(), "o_orderkey"))).where("r <= 3").select("n_name", "o_orderkey", "o_totalprice")


@R.add(r"""SELECT target_ref, count(*) AS n, CASE WHEN regexp_matches(upper(trim(target_ref)), '^(?:BGE|ATF|DTF)\s') THEN 'series' WHEN regexp_matches(upper(trim(target_ref)), '^[1-9][A-Z]_') THEN 'federal' ELSE 'other' END AS scope, coalesce(try_cast(nullif(regexp_extract(target_ref, '(\d{4})\s*$', 1), '') AS INT), 0) AS year FROM decision_citations WHERE target_ref IS NOT NULL GROUP BY 1""")
def udf_01_sql_functions(s: SparkSession, d: str) -> DataFrame:
    """Scalar functions registered in SQL and used by name over a whole table."""
    table(s, d, "decision_citations", "target_ref").createOrReplaceTempView("citations_view")
    s.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION scope_of(x STRING) RETURNS STRING RETURN CASE WHEN upper(trim(x)) rlike r'^(?:BGE|ATF|DTF)\s' THEN 'series' WHEN upper(trim(x)) rlike r'^[1-9][A-Z]_' THEN 'federal' ELSE 'other' END""")
    s.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION year_at_end(x STRING) RETURNS INT RETURN coalesce(try_cast(nullif(regexp_extract(x, r'(\d{4})\s*$', 1), '') AS INT), 0)""")
    return s.sql("SELECT target_ref, count(*) AS n, scope_of(target_ref) AS scope, year_at_end(target_ref) AS year FROM citations_view WHERE target_ref IS NOT NULL GROUP BY target_ref")
