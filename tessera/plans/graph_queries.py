"""Queries of the citation graph and of deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import dedup, graph
from tessera.operators.components import components
from tessera.plans.registry import Registry
from tessera.plans.scalar_queries import COURT_SQL, graph_docket_sql
from tessera.sources.tables import table

R = Registry()
c = F.col


def _resolved(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref", "mention_count", "is_prior_instance").where(c("target_ref").isNotNull() & c("source_decision_id").isNotNull())
    return graph.resolve(graph.edges(x), table(s, d, "decisions", "decision_id", "court", "canton", "decision_date", "docket_number"), table(s, d, "bge_register", "bge_reference", "decision_id", "volume", "division", "first_page"))


_RESOLVED = rf"""WITH own AS (SELECT decision_id, min(court) AS court, min(canton) AS canton, max(decision_date) AS date, min(docket_number) AS docket FROM decisions GROUP BY 1),
refs AS (SELECT DISTINCT source_decision_id AS source, target_ref AS ref, {graph_docket_sql("target_ref")} AS key FROM decision_citations WHERE target_ref IS NOT NULL AND source_decision_id IS NOT NULL),
h AS (SELECT r.source, r.ref, r.key, t.decision_id AS target, s.court AS sc, s.canton AS sk, try_cast(CASE WHEN regexp_matches(trim(s.date), '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN trim(s.date) END AS DATE) AS sd, t.court AS tc, t.canton AS tk, try_cast(CASE WHEN regexp_matches(trim(t.date), '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN trim(t.date) END AS DATE) AS td,
  row_number() OVER (PARTITION BY r.source, r.ref ORDER BY t.date DESC NULLS LAST, t.decision_id) AS rank, count(*) OVER (PARTITION BY r.source, r.ref) AS cnt
  FROM refs r JOIN (SELECT *, {graph_docket_sql("docket")} AS key FROM own) t USING (key) LEFT JOIN own s ON s.decision_id = r.source WHERE t.decision_id <> r.source),
docket AS (SELECT source, ref, target, 'docket_norm' AS method, greatest(0.05, least(0.99, round(0.55
  + CASE WHEN told IS NOT NULL AND tc <> '' THEN CASE WHEN told = tc THEN 0.20 ELSE -0.20 END ELSE 0 END + CASE WHEN sk <> '' AND sk = tk THEN 0.10 ELSE 0 END + CASE WHEN sc <> '' AND sc = tc THEN 0.08 ELSE 0 END
  + CASE WHEN sd - td >= 0 THEN 0.15 WHEN sd - td < 0 THEN -0.15 ELSE 0 END + CASE WHEN abs(sd - td) <= 365 THEN 0.10 WHEN abs(sd - td) <= 1095 THEN 0.05 ELSE 0 END
  + CASE WHEN rank = 1 THEN 0.05 WHEN rank = 2 THEN 0.02 ELSE 0 END - CASE WHEN cnt > 1 THEN least(0.15, 0.03 * (cnt - 1)) ELSE 0 END, 4)))::DOUBLE AS confidence FROM (SELECT *, {COURT_SQL.format("key")} AS told FROM h)),
prefixed AS (SELECT source, ref, b.decision_id AS target, 'bge_norm' AS method, 0.9::DOUBLE AS confidence FROM refs JOIN bge_register b ON b.bge_reference = regexp_replace(upper(trim(ref)), '^(?:ATF|DTF) ', 'BGE ')),
one AS (SELECT * FROM docket UNION ALL SELECT * FROM prefixed), still AS (SELECT * FROM refs WHERE ref NOT IN (SELECT ref FROM one)),
bare AS (SELECT source, ref, b.decision_id AS target, 'bge_bare' AS method, 0.85::DOUBLE AS confidence FROM still JOIN bge_register b ON b.bge_reference = 'BGE ' || ref), still2 AS (SELECT * FROM still WHERE ref NOT IN (SELECT ref FROM bare)),
pages AS (SELECT DISTINCT ref, regexp_extract(ref, '^(?:BGE|ATF|DTF)? ?(\d{{1,3}}) ([IVX]{{1,4}}) (\d{{1,4}})$', 1)::INT AS volume, regexp_extract(ref, '^(?:BGE|ATF|DTF)? ?(\d{{1,3}}) ([IVX]{{1,4}}) (\d{{1,4}})$', 2) AS division, regexp_extract(ref, '^(?:BGE|ATF|DTF)? ?(\d{{1,3}}) ([IVX]{{1,4}}) (\d{{1,4}})$', 3)::INT AS page FROM still2 WHERE regexp_matches(ref, '^(?:BGE|ATF|DTF)? ?(\d{{1,3}}) ([IVX]{{1,4}}) (\d{{1,4}})$')),
begun AS (SELECT ref, decision_id AS target FROM (SELECT ref, decision_id, row_number() OVER (PARTITION BY ref ORDER BY first_page DESC, decision_id DESC) AS r FROM pages JOIN bge_register USING (volume, division) WHERE first_page <= page AND page <= first_page + 30) WHERE r = 1),
pin AS (SELECT source, ref, target, 'bge_pincite' AS method, 0.75::DOUBLE AS confidence FROM still2 JOIN begun USING (ref)),
resolved AS (SELECT source, ref, target, arg_max(method, confidence) AS method, max(confidence) AS confidence FROM (SELECT * FROM one UNION ALL SELECT * FROM bare UNION ALL SELECT * FROM pin) WHERE source <> target GROUP BY 1, 2, 3)
"""


@R.add("""SELECT source_decision_id AS source, target_ref AS ref, sum(mention_count)::BIGINT AS mentions, max(is_prior_instance) AS prior FROM decision_citations WHERE target_ref IS NOT NULL GROUP BY 1, 2""")
def grf_01_edges(s: SparkSession, d: str) -> DataFrame:
    return graph.edges(table(s, d, "decision_citations").where(c("target_ref").isNotNull()))


@R.add(_RESOLVED + "SELECT source, ref, target, method, round(confidence, 4) AS confidence FROM resolved")
def grf_02_resolve(s: SparkSession, d: str) -> DataFrame:
    return _resolved(s, d).withColumn("confidence", F.round("confidence", 4))


@R.add("""WITH RECURSIVE e AS (SELECT canonical_decision_id AS u, member_decision_id AS v FROM decision_representations UNION SELECT member_decision_id, canonical_decision_id FROM decision_representations), reach(u, v) AS (SELECT u, u FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u) SELECT u AS node, min(v) AS root FROM reach GROUP BY 1""")
def grf_03_components(s: SparkSession, d: str) -> DataFrame:
    return components(table(s, d, "decision_representations", "canonical_decision_id", "member_decision_id"), "canonical_decision_id", "member_decision_id")


@R.add("""SELECT docket_number, arg_min(decision_id, (CASE WHEN coalesce(trim(regeste), '') <> '' THEN 0 ELSE 1 END, -coalesce(text_length, 0), decision_id)) AS shown FROM decisions GROUP BY 1""")
def grf_05_display_representative(s: SparkSession, d: str) -> DataFrame:
    order = F.struct(F.when(F.coalesce(F.trim("regeste"), F.lit("")) != "", 0).otherwise(1), -F.coalesce("text_length", F.lit(0)), c("decision_id"))
    return table(s, d, "decisions", "decision_id", "docket_number", "regeste", "text_length").groupBy("docket_number").agg(F.min_by("decision_id", order).alias("shown"))


@R.add(_RESOLVED + "SELECT coalesce(a.id, b.id) AS id, coalesce(cites, 0) AS cites, coalesce(cited_by, 0) AS cited_by FROM (SELECT source AS id, count(DISTINCT target) AS cites FROM resolved GROUP BY 1) a FULL JOIN (SELECT target AS id, count(DISTINCT source) AS cited_by FROM resolved GROUP BY 1) b ON a.id = b.id")
def grf_06_neighbours(s: SparkSession, d: str) -> DataFrame:
    return graph.neighbours(_resolved(s, d))


@R.add(_RESOLVED.replace("WITH own", "WITH RECURSIVE own").rstrip() + """,
links AS (SELECT DISTINCT r.source, r.target FROM resolved r JOIN decision_citations x ON x.source_decision_id = r.source AND x.target_ref = r.ref WHERE x.is_prior_instance = 1 AND r.source <> r.target),
walk(start, node, hop) AS (SELECT source, target, 1 FROM links WHERE source IN (SELECT decision_id FROM decisions WHERE canton = 'CH') UNION SELECT w.start, l.target, w.hop + 1 FROM walk w JOIN links l ON l.source = w.node WHERE w.hop < 4 AND l.target <> w.start)
SELECT start, min(hop) AS hop, node FROM walk GROUP BY 1, 3""")
def grf_07_appeal_chain(s: SparkSession, d: str) -> DataFrame:
    """The chains below the decisions of the federal courts."""
    prior = table(s, d, "decision_citations", "source_decision_id", "target_ref", "is_prior_instance").where("is_prior_instance = 1").select(c("source_decision_id").alias("source"), c("target_ref").alias("ref")).distinct()
    return graph.chains(_resolved(s, d).join(prior, ["source", "ref"], "left_semi"), table(s, d, "decisions", "decision_id", "canton").where("canton = 'CH'").select("decision_id"))


@R.add(_RESOLVED + "SELECT target, count(*) FILTER (WHERE t) AS in_topic, count(*) AS in_all FROM (SELECT DISTINCT source, target, source IN (SELECT decision_id FROM decisions WHERE legal_area = 'strafrecht') AS t FROM resolved) GROUP BY 1 HAVING count(*) FILTER (WHERE t) > 0 ORDER BY in_topic DESC, in_all DESC, target LIMIT 20")
def grf_08_leading_cases(s: SparkSession, d: str) -> DataFrame:
    return graph.leading(_resolved(s, d), table(s, d, "decisions", "decision_id", "legal_area").where("legal_area = 'strafrecht'"))


@R.add("""SELECT target_ref AS ref, left(d.decision_date, 4) AS y, count(DISTINCT d.decision_id) AS n FROM decisions d JOIN decision_citations ON source_decision_id = d.decision_id JOIN (SELECT DISTINCT bge_reference FROM bge_register) ON bge_reference = target_ref WHERE regexp_matches(d.decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') GROUP BY 1, 2""")
def grf_09_trend(s: SparkSession, d: str) -> DataFrame:
    """How often each published decision is cited in each year."""
    known = table(s, d, "bge_register", "bge_reference").select(c("bge_reference").alias("ref")).distinct()
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref").select(c("source_decision_id").alias("decision_id"), c("target_ref").alias("ref")).join(known, "ref", "left_semi")
    years = table(s, d, "decisions", "decision_id", "decision_date").where(c("decision_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).select("decision_id", F.substring("decision_date", 1, 4).alias("y"))
    return x.join(years, "decision_id").groupBy("ref", "y").agg(F.countDistinct("decision_id").alias("n"))


@R.add("""SELECT volume, division, array_to_string(list_sort(list(DISTINCT first_page)), ',') AS pages FROM bge_register GROUP BY 1, 2""")
def grf_10_series_index(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bge_register", "volume", "division", "first_page").groupBy("volume", "division").agg(F.array_join(F.transform(F.array_sort(F.collect_set("first_page")), lambda x: x.cast("string")), ",").alias("pages"))


@R.add("""SELECT volume, CASE WHEN division IN ('I', 'Ia', 'Ib') THEN 'I' ELSE division END AS family, count(DISTINCT first_page) AS pages FROM bge_register GROUP BY 1, 2""")
def grf_11_division_family(s: SparkSession, d: str) -> DataFrame:
    family = F.when(c("division").isin("I", "Ia", "Ib"), "I").otherwise(c("division"))
    return table(s, d, "bge_register", "volume", "division", "first_page").groupBy("volume", family.alias("family")).agg(F.countDistinct("first_page").alias("pages"))


@R.add("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY canonical_key ORDER BY coalesce(length(full_text), 0) DESC, decision_id) AS r FROM (SELECT DISTINCT decision_id, canonical_key, full_text, CASE WHEN trim(regeste) IN ('', 'None') THEN NULL ELSE regeste END AS regeste FROM decisions WHERE canonical_key IS NOT NULL AND scraped_at = (SELECT min(scraped_at) FROM decisions e WHERE e.decision_id = decisions.decision_id)))
SELECT canonical_key, max(CASE WHEN r = 1 THEN decision_id END) AS decision_id, arg_min(regeste, r) FILTER (WHERE regeste IS NOT NULL) AS regeste FROM r GROUP BY 1""")
def ded_01_keep_richest(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "decisions", "decision_id", "canonical_key", "full_text", "regeste", "scraped_at").where(c("canonical_key").isNotNull()).withColumn("size", F.coalesce(F.length("full_text"), F.lit(0))).drop("full_text")
    first = rows.groupBy("decision_id").agg(F.min("scraped_at").alias("scraped_at"))
    light = rows.join(first, ["decision_id", "scraped_at"]).select("decision_id", "canonical_key", "size", "regeste").distinct()
    return dedup.keep_richest(light, c("canonical_key"), "decision_id", c("size"), ["regeste"]).select("canonical_key", "decision_id", "regeste")


_SIGNATURE = "regexp_replace(lower(regexp_replace(full_text, '<[^>]+>', ' ', 'g')), '[^a-z0-9]+', '', 'g')"


@R.add(f"""WITH g AS (SELECT DISTINCT court, docket_number, decision_id, {_SIGNATURE} AS sig FROM decisions WHERE full_text IS NOT NULL AND court IS NOT NULL AND docket_number IS NOT NULL), k AS (SELECT *, first_value(sig) OVER w AS longest, first_value(decision_id) OVER w AS kept FROM g WHERE length(sig) >= 200 WINDOW w AS (PARTITION BY court, docket_number ORDER BY length(sig) DESC, decision_id))
SELECT decision_id, kept FROM k WHERE decision_id <> kept AND starts_with(longest, sig)""")
def ded_02_prefix_copies(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "decisions", "court", "docket_number", "decision_id", "full_text").where(c("full_text").isNotNull() & c("court").isNotNull() & c("docket_number").isNotNull())
    return dedup.prefix_copies(rows, ["court", "docket_number"], "decision_id", "full_text")


@R.add(f"""SELECT sig, count(DISTINCT court) AS courts, count(DISTINCT decision_id) AS n FROM (SELECT court, decision_id, md5({_SIGNATURE}) AS sig FROM decisions WHERE length({_SIGNATURE}) >= 200) GROUP BY 1 HAVING count(DISTINCT decision_id) > 1""")
def ded_03_across_courts(s: SparkSession, d: str) -> DataFrame:
    sig = T.whole_signature(c("full_text"))
    rows = table(s, d, "decisions", "court", "decision_id", "full_text").where(F.length(sig) >= 200).select("court", "decision_id", F.md5(sig).alias("sig"))
    return rows.groupBy("sig").agg(F.countDistinct("court").alias("courts"), F.countDistinct("decision_id").alias("n")).where("n > 1")


@R.add("""WITH t AS (SELECT docket_number, decision_date, coalesce(trust_rank, 99) AS trust, length(full_text) AS size FROM decisions LEFT JOIN data_sources USING (source)),
g AS (SELECT docket_number, decision_date, arg_min(size, trust * 100000000 - coalesce(size, 0)) AS first_size, min(trust) AS trust, max(size) AS longest, count(*) FILTER (WHERE size IS NULL) AS no_size FROM t GROUP BY 1, 2),
f AS (SELECT docket_number, decision_date, trust, longest, (SELECT max(size) FROM t WHERE t.docket_number IS NOT DISTINCT FROM g.docket_number AND t.decision_date IS NOT DISTINCT FROM g.decision_date AND t.trust = g.trust) AS head FROM g)
SELECT CASE WHEN row_number() OVER (PARTITION BY docket_number ORDER BY trust, decision_date NULLS FIRST) = 1 THEN docket_number ELSE docket_number || '_d' || regexp_replace(coalesce(decision_date, ''), '[^0-9]', '', 'g') END AS docket_number, decision_date, CASE WHEN longest > 2.0 * head AND longest > head + 1000 THEN longest ELSE coalesce(head, longest) END AS n_chars FROM f""")
def ded_04_upgrade_or_rename(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "docket_number", "decision_date", "full_text", "source").join(F.broadcast(table(s, d, "data_sources", "source", "trust_rank")), "source", "left")
    light = df.select("decision_id", "docket_number", "decision_date", F.length("full_text").alias("n_chars"), F.coalesce("trust_rank", F.lit(99)).alias("trust_rank"))
    return dedup.upgrade(light, "docket_number", "trust_rank", "n_chars", "decision_id", "decision_date").select("docket_number", "decision_date", "n_chars")


@R.add("""SELECT evidence_method, count(DISTINCT member_decision_id) AS members, count(DISTINCT canonical_decision_id) AS canonicals, count(*) FILTER (WHERE member_decision_id <> canonical_decision_id) AS links FROM decision_representations GROUP BY 1""")
def ded_05_representations(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_representations").groupBy("evidence_method").agg(F.countDistinct("member_decision_id").alias("members"), F.countDistinct("canonical_decision_id").alias("canonicals"), F.count_if(c("member_decision_id") != c("canonical_decision_id")).alias("links"))


@R.add("""SELECT size, count(*) AS entities FROM (SELECT canonical_key, count(DISTINCT decision_id) AS size FROM decisions WHERE canonical_key IS NOT NULL GROUP BY 1) GROUP BY 1""")
def ded_06_regrouping(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "decisions", "canonical_key", "decision_id").where(c("canonical_key").isNotNull()).groupBy("canonical_key").agg(F.countDistinct("decision_id").alias("size"))
    return g.groupBy("size").agg(F.count("*").alias("entities"))


@R.add("""SELECT DISTINCT r.decision_id, a.decision_id AS published_from FROM bge_register r JOIN decisions a ON a.docket_number = r.docket_number_2""")
def ded_07_reporter_pairing(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "decisions", "decision_id", "docket_number").select(c("decision_id").alias("published_from"), c("docket_number").alias("docket_number_2"))
    return table(s, d, "bge_register", "decision_id", "docket_number_2").join(a, "docket_number_2").select("decision_id", "published_from").distinct()


@R.add("""SELECT m.canonical_decision_id AS canonical, coalesce(a.title, max(b.title)) AS title FROM (SELECT DISTINCT canonical_decision_id, member_decision_id FROM decision_representations) m LEFT JOIN (SELECT decision_id, max(nullif(nullif(trim(title), ''), 'None')) AS title FROM decisions GROUP BY 1) a ON a.decision_id = m.canonical_decision_id LEFT JOIN (SELECT decision_id, max(nullif(nullif(trim(title), ''), 'None')) AS title FROM decisions GROUP BY 1) b ON b.decision_id = m.member_decision_id GROUP BY 1, a.title""")
def ded_08_harvest_fields(s: SparkSession, d: str) -> DataFrame:
    titles = table(s, d, "decisions", "decision_id", "title").groupBy("decision_id").agg(F.max(F.nullif(F.nullif(F.trim("title"), F.lit("")), F.lit("None"))).alias("t"))
    m = table(s, d, "decision_representations", "canonical_decision_id", "member_decision_id").distinct()
    a, b = titles.toDF("canonical_decision_id", "a"), titles.toDF("member_decision_id", "b")
    return m.join(a, "canonical_decision_id", "left").join(b, "member_decision_id", "left").groupBy("canonical_decision_id", "a").agg(F.max("b").alias("b")).select(c("canonical_decision_id").alias("canonical"), F.coalesce("a", "b").alias("title"))


@R.add("""SELECT court, docket_number, count(DISTINCT decision_id) AS n FROM decisions GROUP BY 1, 2 HAVING count(DISTINCT decision_id) > 1""")
def ded_09_collisions(s: SparkSession, d: str) -> DataFrame:
    return dedup.collisions(table(s, d, "decisions", "court", "docket_number", "decision_id"), ["court", "docket_number"], "decision_id")


@R.add("""SELECT content_hash, count(*) AS n, array_to_string(list_slice(list_sort(list(DISTINCT decision_id)), 1, 20), ',') AS ids FROM decisions GROUP BY 1 HAVING count(*) > 1""")
def ded_10_report(s: SparkSession, d: str) -> DataFrame:
    """Groups of the same content hash: their rows and their first twenty ids."""
    rows = table(s, d, "decisions", "content_hash", "decision_id")
    n = rows.groupBy("content_hash").agg(F.count("*").alias("n")).where("n > 1")
    return dedup.with_examples(n, rows, ["content_hash"], "decision_id", 20)


@R.add("""SELECT court, docket_number, decision_date, count(DISTINCT decision_id) AS n, array_to_string(list_slice(list_sort(list(DISTINCT decision_id)), 1, 20), ',') AS ids FROM decisions WHERE docket_number <> '' AND decision_date <> '' GROUP BY 1, 2, 3 HAVING count(DISTINCT decision_id) > 1""")
def ded_10_docket_report(s: SparkSession, d: str) -> DataFrame:
    """The other keying of the report: court, docket and date as written; all groups, and their first twenty ids."""
    rows = table(s, d, "decisions", "court", "docket_number", "decision_date", "decision_id").where("docket_number <> '' and decision_date <> ''")
    keys = ["court", "docket_number", "decision_date"]
    n = rows.groupBy(*keys).agg(F.countDistinct("decision_id").alias("n")).where("n > 1")
    return dedup.with_examples(n, rows, keys, "decision_id", 20)
