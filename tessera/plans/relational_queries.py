"""Queries of joins, windows, sorting, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import text as T
from tessera.operators import joins as J
from tessera.operators.aggregates import positions
from tessera.plans.registry import Registry
from tessera.plans.scalar_queries import graph_docket_sql
from tessera.sources.tables import table

R = Registry()
c = F.col


@R.add(f"""WITH t AS (SELECT DISTINCT decision_id AS target_id, {graph_docket_sql("docket_number")} AS k FROM decisions), x AS (SELECT DISTINCT source_decision_id, target_ref, {graph_docket_sql("target_ref")} AS k FROM decision_citations), m AS (SELECT decision_id, min(court) AS source_court FROM decisions GROUP BY 1)
SELECT source_decision_id, target_ref, target_id, source_court FROM x JOIN t USING (k) LEFT JOIN m ON m.decision_id = source_decision_id WHERE target_id <> source_decision_id""")
def join_01_docket_equi_join(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "decisions", "decision_id", "docket_number").select(c("decision_id").alias("target_id"), T.graph_docket(c("docket_number")).alias("k")).distinct()
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref").distinct().withColumn("k", T.graph_docket(c("target_ref")))
    m = table(s, d, "decisions", "decision_id", "court").groupBy(c("decision_id").alias("source_decision_id")).agg(F.min("court").alias("source_court"))
    return x.join(t, "k").where(c("target_id") != c("source_decision_id")).join(m, "source_decision_id", "left").select("source_decision_id", "target_ref", "target_id", "source_court")


@R.add(r"""WITH x AS (SELECT DISTINCT target_ref, upper(trim(target_ref)) AS u FROM decision_citations WHERE target_ref IS NOT NULL), b AS (SELECT bge_reference, decision_id, substr(bge_reference, 5) AS bare FROM bge_register)
SELECT DISTINCT target_ref, decision_id FROM x JOIN b ON b.bare = u OR b.bare = substr(u, 5)""")
def join_02_or_join_exploded(s: SparkSession, d: str) -> DataFrame:
    u = F.upper(F.trim("target_ref"))
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").isNotNull()).distinct()
    b = table(s, d, "bge_register", "bge_reference", "decision_id")
    return J.or_join(x, b, [u, F.substring(u, 5, 1000)], F.substring("bge_reference", 5, 1000), ["target_ref", "decision_id"]).select("target_ref", "decision_id")


@R.add("""WITH x AS (SELECT DISTINCT target_ref FROM decision_citations WHERE target_ref IS NOT NULL), done AS (SELECT target_ref FROM x JOIN bge_register ON bge_reference = target_ref)
SELECT target_ref, decision_id FROM x JOIN bge_register ON bge_reference = 'BGE ' || target_ref WHERE target_ref NOT IN (SELECT target_ref FROM done)""")
def join_03_concat_key_after_anti(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").isNotNull()).distinct()
    b = table(s, d, "bge_register", "bge_reference", "decision_id")
    left = x.join(b.select(c("bge_reference").alias("target_ref")), "target_ref", "left_anti")
    return left.join(b, c("bge_reference") == F.concat(F.lit("BGE "), c("target_ref"))).select("target_ref", "decision_id")


@R.add(r"""WITH x AS (SELECT DISTINCT target_ref, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 1)::INT AS volume, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 2) AS division, regexp_extract(target_ref, '^BGE (\d+) ([IV]+) (\d+)$', 3)::INT AS page FROM decision_citations WHERE regexp_matches(target_ref, '^BGE (\d+) ([IV]+) (\d+)$'))
SELECT target_ref, decision_id, first_page FROM (SELECT target_ref, decision_id, first_page, row_number() OVER (PARTITION BY target_ref ORDER BY first_page DESC, decision_id DESC) AS r FROM x JOIN bge_register USING (volume, division) WHERE first_page <= page AND page <= first_page + 30) WHERE r = 1""")
def join_04_asof_pinpoint(s: SparkSession, d: str) -> DataFrame:
    p = r"^BGE (\d+) ([IV]+) (\d+)$"
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct().select("target_ref", F.regexp_extract("target_ref", p, 1).cast("int").alias("volume"), F.regexp_extract("target_ref", p, 2).alias("division"), F.regexp_extract("target_ref", p, 3).cast("int").alias("page"))
    b = table(s, d, "bge_register", "volume", "division", "first_page", "decision_id")
    return J.asof_join(x, b, ["volume", "division"], "page", "first_page", 30, ["decision_id"]).select("target_ref", "decision_id", "first_page")


@R.add(f"""WITH
e AS (SELECT docket_number AS key, min(decision_id) AS value, 0 AS rank FROM decisions WHERE coalesce(docket_number, '') <> '' GROUP BY 1 UNION ALL SELECT docket_number_2, min(decision_id), 1 FROM decisions WHERE coalesce(docket_number_2, '') <> '' GROUP BY 1)
SELECT key, arg_min(value, rank) AS value, min(rank)::INT AS rank FROM e GROUP BY 1""")
def join_06_key_index(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "docket_number", "docket_number_2")
    return J.key_index([df.withColumnRenamed("docket_number", "k"), df.withColumnRenamed("docket_number_2", "k")], "k", "decision_id")


@R.add(f"""WITH refs AS (SELECT DISTINCT target_ref FROM decision_citations WHERE coalesce(target_ref, '') <> ''), p AS (SELECT DISTINCT docket_number AS k FROM decisions WHERE docket_number IS NOT NULL), i AS (SELECT docket_number_2 AS k, min(decision_id) AS value FROM decisions WHERE coalesce(docket_number_2, '') <> '' GROUP BY 1)
SELECT target_ref, value AS decision_id, 0.85 AS confidence FROM refs JOIN i ON target_ref = k WHERE target_ref NOT IN (SELECT k FROM p)""")
def join_05_additive_lookup(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "decision_citations", "target_ref").where(F.coalesce("target_ref", F.lit("")) != "").distinct()
    df = table(s, d, "decisions", "decision_id", "docket_number", "docket_number_2")
    unresolved = refs.join(df.select(c("docket_number").alias("target_ref")), "target_ref", "left_anti")
    i = J.key_index([df.withColumnRenamed("docket_number_2", "k")], "k", "decision_id")
    return unresolved.join(i, c("target_ref") == c("key")).select("target_ref", c("value").alias("decision_id"), F.lit(0.85).alias("confidence"))


@R.add("""SELECT docket_number_2 AS alias, min(decision_id) AS decision_id FROM decisions WHERE coalesce(docket_number_2, '') <> '' AND docket_number_2 NOT IN (SELECT docket_number FROM decisions WHERE docket_number IS NOT NULL) GROUP BY 1""")
def join_07_alias_anti_join(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "docket_number", "docket_number_2")
    alias = df.where(F.coalesce("docket_number_2", F.lit("")) != "").groupBy(c("docket_number_2").alias("alias")).agg(F.min("decision_id").alias("decision_id"))
    return alias.join(df.select(c("docket_number").alias("alias")), "alias", "left_anti")


@R.add("""SELECT DISTINCT decision_id FROM decisions a WHERE NOT EXISTS (SELECT 1 FROM version_removals v WHERE v.decision_id = a.decision_id)""")
def join_08_not_exists(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").distinct().join(table(s, d, "version_removals", "decision_id"), "decision_id", "left_anti")


@R.add("""SELECT DISTINCT decision_id FROM decisions a WHERE EXISTS (SELECT 1 FROM decision_citations x WHERE x.source_decision_id = a.decision_id)""")
def join_09_exists(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").distinct().join(table(s, d, "decision_citations", "source_decision_id").withColumnRenamed("source_decision_id", "decision_id"), "decision_id", "left_semi")


@R.add("""WITH l AS (SELECT decision_id, max(version_no) AS version_no FROM version_removals GROUP BY 1) SELECT l.decision_id, l.version_no, n.n FROM l LEFT JOIN (SELECT decision_id, count(*) AS n FROM decisions GROUP BY 1) n USING (decision_id)""")
def join_10_latest_row(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("decision_id").orderBy(c("version_no").desc())
    latest = table(s, d, "version_removals", "decision_id", "version_no").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return latest.join(table(s, d, "decisions", "decision_id").groupBy("decision_id").agg(F.count("*").alias("n")), "decision_id", "left")


@R.add("""SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_quantity > 45)""")
def join_11_orphan_dimension(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part", "p_partkey").join(table(s, d, "lineitem", "l_partkey", "l_quantity").where("l_quantity > 45").select(c("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


@R.add("""SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_12_fact_dimension(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").join(table(s, d, "part", "p_partkey", "p_brand"), c("l_partkey") == c("p_partkey")).select("l_orderkey", "l_linenumber", "p_brand")


@R.add("""WITH n AS (SELECT n_nationkey, n_name FROM nation) SELECT a.n_name AS customer_nation, b.n_name AS supplier_nation, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN n a ON c_nationkey = a.n_nationkey JOIN n b ON s_nationkey = b.n_nationkey GROUP BY 1, 2""")
def join_13_double_dimension(s: SparkSession, d: str) -> DataFrame:
    nation = table(s, d, "nation", "n_nationkey", "n_name")
    li = table(s, d, "lineitem", "l_orderkey", "l_suppkey").join(table(s, d, "orders", "o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
    pairs = li.join(table(s, d, "customer", "c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey")).join(table(s, d, "supplier", "s_suppkey", "s_nationkey"), c("l_suppkey") == c("s_suppkey"))
    counted = pairs.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"))
    a, b = nation.toDF("c_nationkey", "customer_nation"), nation.toDF("s_nationkey", "supplier_nation")
    return counted.join(a, "c_nationkey").join(b, "s_nationkey").select("customer_nation", "supplier_nation", "n")


@R.add("""SELECT DISTINCT o_orderkey FROM orders JOIN (SELECT DISTINCT c_custkey, c_nationkey FROM customer) ON o_custkey = c_custkey AND c_nationkey = o_custkey % 25""")
def join_14_two_key_join(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders", "o_orderkey", "o_custkey").select("o_orderkey", c("o_custkey").alias("k1"), (c("o_custkey") % 25).cast("int").alias("k2"))
    return o.join(table(s, d, "customer", "c_custkey", "c_nationkey").toDF("k1", "k2").distinct(), ["k1", "k2"]).select("o_orderkey").distinct()


@R.add("""SELECT decision_id, title FROM decisions WHERE decision_id IN (SELECT member_decision_id FROM decision_representations)""")
def join_15_semi_by_ids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "title").join(table(s, d, "decision_representations", "member_decision_id").withColumnRenamed("member_decision_id", "decision_id"), "decision_id", "left_semi")


@R.add("""(SELECT decision_id, 'a' AS side FROM (SELECT decision_id FROM decisions WHERE decision_id IS NOT NULL EXCEPT SELECT source_decision_id FROM decision_citations)) UNION ALL (SELECT source_decision_id, 'b' FROM (SELECT source_decision_id FROM decision_citations WHERE source_decision_id IS NOT NULL EXCEPT SELECT decision_id FROM decisions))""")
def join_16_set_difference(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "decisions", "decision_id").where(c("decision_id").isNotNull())
    b = table(s, d, "decision_citations", "source_decision_id").withColumnRenamed("source_decision_id", "decision_id").where(c("decision_id").isNotNull())
    return J.set_difference(a, b, "decision_id")


@R.add("""SELECT event_id, user_id, shown_at FROM (SELECT p.event_id, p.user_id, v.ts AS shown_at, row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC) AS r FROM events p JOIN events v ON p.user_id = v.user_id AND v.event_type = 'view' AND p.ts > v.ts WHERE p.event_type = 'purchase') WHERE r = 1""")
def join_17_nearest_earlier(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "event_id", "user_id", "event_type", "ts")
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = e.where("event_type = 'view'").select("user_id", c("ts").alias("shown_at"))
    return J.nearest_before(bought, seen, ["user_id"], "ts", "shown_at").select("event_id", "user_id", "shown_at")


@R.add(r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(left(text, 600), '[0-9][A-Z]_[0-9]{1,5}/[0-9]{4}')) AS token, generate_subscripts(regexp_extract_all(left(text, 600), '[0-9][A-Z]_[0-9]{1,5}/[0-9]{4}'), 1) AS pos FROM documents), k AS (SELECT docket_number AS token, min(decision_id) AS decision_id, count(DISTINCT decision_id) AS n FROM decisions GROUP BY 1),
h AS (SELECT doc_id, arg_min(token, pos) AS token, arg_min(decision_id, pos) AS decision_id, arg_min(n, pos) AS n FROM t JOIN k USING (token) GROUP BY 1) SELECT doc_id, token, decision_id FROM h WHERE n = 1""")
def join_18_first_unambiguous_token(s: SparkSession, d: str) -> DataFrame:
    tokens = F.regexp_extract_all(F.substring("text", 1, 600), F.lit("[0-9][A-Z]_[0-9]{1,5}/[0-9]{4}"), F.lit(0))
    t = table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(tokens).alias("pos", "token"))
    k = table(s, d, "decisions", "decision_id", "docket_number").groupBy(c("docket_number").alias("token")).agg(F.min("decision_id").alias("decision_id"), F.countDistinct("decision_id").alias("n"))
    h = t.join(k, "token").groupBy("doc_id").agg(F.min_by(F.struct("token", "decision_id", "n"), "pos").alias("m"))
    return h.where("m.n = 1").select("doc_id", "m.token", "m.decision_id")


@R.add("""SELECT DISTINCT d.decision_id, s.trust_rank FROM decisions d LEFT JOIN data_sources s ON upper(d.source) = upper(s.source)""")
def join_19_dictionary_lookup(s: SparkSession, d: str) -> DataFrame:
    k = table(s, d, "data_sources", "source", "trust_rank").select(F.upper("source").alias("k"), "trust_rank")
    return table(s, d, "decisions", "decision_id", "source").withColumn("k", F.upper("source")).join(F.broadcast(k), "k", "left").select("decision_id", "trust_rank").distinct()


@R.add(f"""WITH k AS (SELECT docket_number AS k, min(decision_id) AS id FROM decisions GROUP BY 1), n AS (SELECT {graph_docket_sql("docket_number")} AS k, min(decision_id) AS id FROM decisions GROUP BY 1)
SELECT g.target_ref, coalesce(n.id, k.id) AS decision_id FROM citation_gaps g LEFT JOIN n ON n.k = {graph_docket_sql("g.target_ref")} LEFT JOIN k ON k.k = g.target_ref""")
def join_20_normalised_else_raw(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "docket_number")
    raw = df.groupBy(c("docket_number").alias("target_ref")).agg(F.min("decision_id").alias("raw_id"))
    norm = df.groupBy(T.graph_docket(c("docket_number")).alias("k")).agg(F.min("decision_id").alias("norm_id"))
    return table(s, d, "citation_gaps", "target_ref").withColumn("k", T.graph_docket(c("target_ref"))).join(norm, "k", "left").join(raw, "target_ref", "left").select("target_ref", F.coalesce("norm_id", "raw_id").alias("decision_id"))


@R.add("""SELECT DISTINCT key, decision_id FROM (SELECT decision_id, unnest([decision_id, docket_number, docket_number_2]) AS key FROM decisions) WHERE coalesce(key, '') <> ''""")
def join_21_lookup_keys(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "docket_number", "docket_number_2").select("decision_id", F.explode(F.array("decision_id", "docket_number", "docket_number_2")).alias("key")).where(F.coalesce("key", F.lit("")) != "").select("key", "decision_id").distinct()


@R.add(r"""SELECT DISTINCT target_ref, decision_id FROM (SELECT target_ref, regexp_extract(target_ref, '^bge_(\d+)_([IV]+)_(\d+)', 1)::INT AS volume, regexp_extract(target_ref, '^bge_(\d+)_([IV]+)_(\d+)', 2) AS division, regexp_extract(target_ref, '^bge_(\d+)_([IV]+)_(\d+)', 3)::INT AS first_page FROM decision_citations WHERE regexp_matches(target_ref, '^bge_(\d+)_([IV]+)_(\d+)')) JOIN bge_register USING (volume, division, first_page)""")
def join_22_prefix_as_equi_key(s: SparkSession, d: str) -> DataFrame:
    p = r"^bge_(\d+)_([IV]+)_(\d+)"
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct().select("target_ref", F.regexp_extract("target_ref", p, 1).cast("int").alias("volume"), F.regexp_extract("target_ref", p, 2).alias("division"), F.regexp_extract("target_ref", p, 3).cast("int").alias("first_page"))
    return x.join(table(s, d, "bge_register", "volume", "division", "first_page", "decision_id"), ["volume", "division", "first_page"]).select("target_ref", "decision_id")


@R.add("""SELECT pdf_url, arg_min(decision_id, (-coalesce(text_length, 0), decision_id)) AS canonical, count(DISTINCT decision_id) AS n FROM decisions WHERE starts_with(pdf_url, 'http') GROUP BY 1""")
def join_23_shared_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "pdf_url", "text_length").where(c("pdf_url").startswith("http")).groupBy("pdf_url").agg(F.min_by("decision_id", F.struct(-F.coalesce("text_length", F.lit(0)), "decision_id")).alias("canonical"), F.countDistinct("decision_id").alias("n"))


@R.add("""SELECT count(*) AS n_orphans FROM (SELECT DISTINCT source_decision_id FROM decision_citations) x WHERE NOT EXISTS (SELECT 1 FROM decisions a WHERE a.decision_id = x.source_decision_id)""")
def join_24_orphan_check(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "source_decision_id").distinct().withColumnRenamed("source_decision_id", "decision_id")
    return x.join(table(s, d, "decisions", "decision_id"), "decision_id", "left_anti").agg(F.count("*").alias("n_orphans"))


@R.add("""SELECT target_type, count(*) AS n FROM decision_citations WHERE source_decision_id IN (SELECT decision_id FROM decisions WHERE court = 'bger') GROUP BY 1""")
def join_25_in_subquery(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "decisions", "decision_id", "court").where("court = 'bger'").select(c("decision_id").alias("source_decision_id"))
    return table(s, d, "decision_citations", "source_decision_id", "target_type").join(ids, "source_decision_id", "left_semi").groupBy("target_type").agg(F.count("*").alias("n"))


@R.add("""SELECT r_name, count(n_nationkey) AS n FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY 1""")
def join_27_left_join_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "region").join(table(s, d, "nation", "n_nationkey", "n_regionkey"), c("r_regionkey") == c("n_regionkey"), "left").groupBy("r_name").agg(F.count("n_nationkey").alias("n"))


@R.add("""SELECT l_suppkey, s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def join_28_salted_join(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem", "l_suppkey")
    return J.salted_join(li, table(s, d, "supplier", "s_suppkey", "s_name").withColumnRenamed("s_suppkey", "l_suppkey"), ["l_suppkey"]).groupBy("l_suppkey", "s_name").agg(F.count("*").alias("n"))


@R.add("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber) AS rank, count(*) OVER (PARTITION BY l_suppkey) AS candidates FROM lineitem""")
def win_01_rank_and_02_count(s: SparkSession, d: str) -> DataFrame:
    p = Window.partitionBy("l_suppkey")
    return table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate").select("l_orderkey", "l_linenumber", F.row_number().over(p.orderBy(c("l_shipdate").desc_nulls_last(), "l_orderkey", "l_linenumber")).alias("rank"), F.count("*").over(p).alias("candidates"))


@R.add("""SELECT decision_id, scraped_at, source FROM (SELECT decision_id, scraped_at, source, row_number() OVER (PARTITION BY decision_id ORDER BY scraped_at DESC, coalesce(source, ''), coalesce(title, '')) AS r FROM decisions) WHERE r = 1""")
def win_03_last_seen_wins(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "scraped_at", "source", "title")
    w = Window.partitionBy("decision_id").orderBy(c("scraped_at").desc(), F.coalesce("source", F.lit("")), F.coalesce("title", F.lit("")))
    return df.withColumn("r", F.row_number().over(w)).where("r = 1").select("decision_id", "scraped_at", "source")


@R.add("""SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event FROM events""")
def win_05_lead(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "user_id", "event_id", "ts").select("user_id", "event_id", F.lead("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("next_event"))


@R.add("""SELECT volume, division, greatest(30, max(gap)) AS reach FROM (SELECT volume, division, first_page - lag(first_page) OVER (PARTITION BY volume, division ORDER BY first_page) AS gap FROM bge_register) GROUP BY 1, 2""")
def win_06_longest_gap(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("volume", "division").orderBy("first_page")
    return table(s, d, "bge_register", "volume", "division", "first_page").withColumn("gap", c("first_page") - F.lag("first_page").over(w)).groupBy("volume", "division").agg(F.greatest(F.lit(30), F.max("gap")).alias("reach"))


@R.add("""SELECT y, n, CASE WHEN p > 0 THEN round((n - p) * 100.0 / p, 1) END AS growth FROM (SELECT y, n, lag(n) OVER (ORDER BY y) AS p FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1))""")
def win_07_yearly_growth(s: SparkSession, d: str) -> DataFrame:
    by = table(s, d, "orders", "o_orderdate").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    p = F.lag("n").over(Window.partitionBy(F.lit(1)).orderBy("y"))  # a row for each year
    return by.withColumn("p", p).select("y", "n", F.when(c("p") > 0, F.round((c("n") - c("p")) * 100.0 / c("p"), 1)).alias("growth"))


@R.add("""SELECT target_ref, count(*) AS n FROM decision_citations GROUP BY 1 ORDER BY n DESC, target_ref LIMIT 20""")
def top_01_most_cited(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").groupBy("target_ref").agg(F.count("*").alias("n")).orderBy(c("n").desc(), "target_ref").limit(20)


@R.add("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50""")
def top_02_page(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders", "o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey").offset(50).limit(25)


@R.add("""SELECT court, decision_id FROM (SELECT court, decision_id, row_number() OVER (PARTITION BY court ORDER BY decision_date DESC, decision_id DESC) AS r FROM (SELECT DISTINCT court, decision_id, decision_date FROM decisions WHERE regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'))) WHERE r <= 5""")
def top_03_newest_of_each_court(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "court", "decision_id", "decision_date").where(c("decision_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).distinct()
    return df.withColumn("r", F.row_number().over(Window.partitionBy("court").orderBy(c("decision_date").desc(), c("decision_id").desc()))).where("r <= 5").select("court", "decision_id")


@R.add("""SELECT docket_number, row_number() OVER (ORDER BY list_transform(regexp_extract_all(docket_number, '[0-9]+'), lambda x: x::BIGINT), docket_number) AS pos FROM (SELECT DISTINCT docket_number FROM version_removals)""")
def top_05_natural_sort(s: SparkSession, d: str) -> DataFrame:
    key = F.transform(F.regexp_extract_all("docket_number", F.lit("[0-9]+"), F.lit(0)), lambda x: x.cast("bigint"))
    rows = table(s, d, "version_removals", "docket_number").distinct().select("docket_number", key.alias("key"))
    return positions(rows, ["key", "docket_number"]).select("docket_number", (c("pos") + 1).alias("pos"))


def _drawn(*keys: str, seed: int = 42) -> Column:
    """A row's place in a sample: it follows from the row and the seed, not from partitions."""
    return F.md5(F.concat_ws("-", *keys, F.lit(f"#{seed}")))


@R.add("""SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY md5(l_orderkey || '-' || l_linenumber || '-#42'), l_orderkey, l_linenumber LIMIT 100""")
def top_06_random_sample(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem", "l_orderkey", "l_linenumber").orderBy(_drawn("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").limit(100)


@R.add("""SELECT target_type, source_decision_id, target_ref FROM (SELECT *, row_number() OVER (PARTITION BY target_type ORDER BY md5(concat_ws('-', source_decision_id, target_ref, '#42')), source_decision_id, target_ref) AS r FROM (SELECT DISTINCT target_type, source_decision_id, target_ref FROM decision_citations)) WHERE r <= 50""")
def top_07_stratified_sample(s: SparkSession, d: str) -> DataFrame:
    """A sample of each type; Spark keeps the best fifty of each task before it brings a type together."""
    df = table(s, d, "decision_citations", "target_type", "source_decision_id", "target_ref").distinct()
    order = Window.partitionBy("target_type").orderBy(_drawn("source_decision_id", "target_ref"), "source_decision_id", "target_ref")
    return df.withColumn("r", F.row_number().over(order)).where("r <= 50").drop("r")


@R.add("""SELECT ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 8 AS shard, count(*) AS n FROM documents GROUP BY 1""")
def top_08_hash_shards(s: SparkSession, d: str) -> DataFrame:
    shard = F.conv(F.substring(F.md5(c("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint") % 8
    return table(s, d, "documents", "doc_id").groupBy(shard.alias("shard")).agg(F.count("*").alias("n"))


@R.add("""SELECT DISTINCT id FROM (SELECT decision_id AS id FROM decisions UNION SELECT decision_id FROM bge_register)""")
def set_01_union(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").union(table(s, d, "bge_register", "decision_id")).distinct().withColumnRenamed("decision_id", "id")


@R.add("""SELECT docket_number AS docket FROM decisions INTERSECT SELECT docket_number FROM version_removals""")
def set_02_intersect(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "docket_number").intersect(table(s, d, "version_removals", "docket_number")).withColumnRenamed("docket_number", "docket")


@R.add("""SELECT decision_id FROM decisions EXCEPT SELECT member_decision_id FROM decision_representations""")
def set_03_except(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").subtract(table(s, d, "decision_representations", "member_decision_id"))


@R.add("""SELECT id, min(src) AS src FROM (SELECT decision_id AS id, 1 AS src FROM decisions UNION ALL SELECT decision_id, 2 FROM version_removals UNION ALL SELECT decision_id, 3 FROM bge_register) GROUP BY 1""")
def set_04_union_first_wins(s: SparkSession, d: str) -> DataFrame:
    parts = [table(s, d, t, "decision_id").select(c("decision_id").alias("id"), F.lit(n).alias("src")) for n, t in enumerate(("decisions", "version_removals", "bge_register"), 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("id").agg(F.min("src").alias("src"))
