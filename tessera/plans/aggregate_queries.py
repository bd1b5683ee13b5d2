"""Queries of aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import text as T
from tessera.operators import aggregates as A
from tessera.plans.registry import Registry
from tessera.sources.tables import table

R = Registry()
c = F.col
ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@R.add("""SELECT court, canton, count(*) AS n, min(CASE WHEN regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN decision_date END) AS first, max(CASE WHEN regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN decision_date END) AS last, array_to_string(list_sort(list_distinct(list(language) FILTER (WHERE language IS NOT NULL))), ',') AS languages FROM decisions GROUP BY 1, 2""")
def agg_01_by_court(s: SparkSession, d: str) -> DataFrame:
    iso = F.when(c("decision_date").rlike(ISO), c("decision_date"))
    return table(s, d, "decisions", "court", "canton", "decision_date", "language").groupBy("court", "canton").agg(F.count("*").alias("n"), F.min(iso).alias("first"), F.max(iso).alias("last"), F.array_join(F.array_sort(F.collect_set("language")), ",").alias("languages"))


@R.add("""SELECT canton, count(DISTINCT court) AS courts FROM decisions GROUP BY 1""")
def agg_02_count_distinct(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "canton", "court").groupBy("canton").agg(F.countDistinct("court").alias("courts"))


@R.add("""SELECT left(decision_date, 4) AS y, count(*) AS n FROM decisions WHERE decision_date >= '1800' AND decision_date < '2100' AND regexp_matches(decision_date, '^[0-9]{4}-') GROUP BY 1""")
def agg_03_by_year(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_date").where((c("decision_date") >= "1800") & (c("decision_date") < "2100") & c("decision_date").rlike("^[0-9]{4}-")).groupBy(F.substring("decision_date", 1, 4).alias("y")).agg(F.count("*").alias("n"))


@R.add("""SELECT source, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'fr') AS fr, count(*) FILTER (WHERE lang = 'it') AS it FROM documents GROUP BY 1""")
def agg_04_pivot(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "source", "lang").groupBy("source").pivot("lang", ["de", "fr", "it"]).agg(F.count(F.lit(1))).fillna(0, ["de", "fr", "it"])


@R.add("""SELECT ts::DATE::VARCHAR AS day, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 10 DAY GROUP BY 1""")
def agg_05_trailing_window(s: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("2024-01-30").cast("timestamp_ntz")
    return table(s, d, "events", "ts").where(c("ts") >= as_of - F.expr("INTERVAL '10' DAY")).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@R.add("""SELECT court, round(avg(CASE WHEN length(regeste) >= 50 THEN 1.0 ELSE 0.0 END), 6) AS share FROM decisions GROUP BY 1""")
def agg_06_coverage(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "court", "regeste").groupBy("court").agg(F.round(F.avg(F.when(F.length("regeste") >= 50, 1.0).otherwise(0.0)), 6).alias("share"))


@R.add("""SELECT court, count(*) AS n FROM decisions GROUP BY 1 HAVING count(*) >= 100""")
def agg_07_having(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "court").groupBy("court").agg(F.count("*").alias("n")).where("n >= 100")


@R.add("""SELECT user_id, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1 HAVING count(*) >= 20""")
def agg_08_small_groups_suppressed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "user_id", "value").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean")).where("n >= 20")


@R.add("""SELECT t.target_ref, t.n, b.decision_id, b.lang FROM (SELECT target_ref, count(*) AS n FROM decision_citations GROUP BY 1 ORDER BY n DESC, target_ref LIMIT 50) t LEFT JOIN bge_register b ON b.bge_reference = t.target_ref""")
def agg_09_top_cited_with_metadata(s: SparkSession, d: str) -> DataFrame:
    top = table(s, d, "decision_citations", "target_ref").groupBy("target_ref").agg(F.count("*").alias("n")).orderBy(c("n").desc(), "target_ref").limit(50)
    b = table(s, d, "bge_register", "bge_reference", "decision_id", "lang").withColumnRenamed("bge_reference", "target_ref")
    return b.join(F.broadcast(top), "target_ref", "right").select("target_ref", "n", "decision_id", "lang")


@R.add(r"""SELECT regexp_extract(target_ref, '(?i)^(?:BGE|ATF|DTF) (\d+) ', 1) AS volume, count(*) AS n FROM decision_citations WHERE regexp_matches(target_ref, '(?i)^(?:BGE|ATF|DTF) (\d+) ') GROUP BY 1""")
def agg_10_collapse_variants(s: SparkSession, d: str) -> DataFrame:
    p = r"(?i)^(?:BGE|ATF|DTF) (\d+) "
    return table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).groupBy(F.regexp_extract("target_ref", p, 1).alias("volume")).agg(F.count("*").alias("n"))


@R.add("""SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 20 THEN '6-20' ELSE '21+' END AS bucket, count(*) AS targets FROM (SELECT target_ref, count(*) AS n FROM decision_citations GROUP BY 1) GROUP BY 1""")
def agg_11_nested_histogram(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "decision_citations", "target_ref").groupBy("target_ref").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(c("n") == 1, "1").when(c("n") <= 5, "2-5").when(c("n") <= 20, "6-20").otherwise("21+").alias("bucket")).agg(F.count("*").alias("targets"))


@R.add("""SELECT count(*) AS pairs FROM (SELECT DISTINCT source_decision_id, target_ref FROM decision_citations WHERE source_decision_id IS NOT NULL AND target_ref IS NOT NULL)""")
def agg_12_distinct_pairs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "source_decision_id", "target_ref").agg(F.countDistinct("source_decision_id", "target_ref").alias("pairs"))


@R.add("""SELECT CASE WHEN regexp_matches(upper(target_ref), '^(BGE|ATF|DTF) ') THEN 'BGE' || substr(upper(target_ref), 4) ELSE upper(target_ref) END AS canonical, count(DISTINCT source_decision_id) AS sources FROM decision_citations WHERE target_ref IS NOT NULL GROUP BY 1""")
def agg_13_alias_canonical(s: SparkSession, d: str) -> DataFrame:
    u = F.upper("target_ref")
    alias = F.when(u.rlike("^(BGE|ATF|DTF) "), F.concat(F.lit("BGE"), F.substring(u, 4, 1000))).otherwise(u)
    return table(s, d, "decision_citations", "target_ref", "source_decision_id").where(c("target_ref").isNotNull()).groupBy(alias.alias("canonical")).agg(F.countDistinct("source_decision_id").alias("sources"))


@R.add("""SELECT a.language AS from_language, b.lang AS to_language, count(*) AS n FROM decision_citations x JOIN (SELECT decision_id, min(language) AS language FROM decisions GROUP BY 1) a ON a.decision_id = x.source_decision_id JOIN bge_register b ON b.bge_reference = x.target_ref GROUP BY 1, 2""")
def agg_14_language_matrix(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "decisions", "decision_id", "language").groupBy(c("decision_id").alias("source_decision_id")).agg(F.min("language").alias("from_language"))
    b = table(s, d, "bge_register", "bge_reference", "lang").toDF("target_ref", "to_language")
    return table(s, d, "decision_citations", "source_decision_id", "target_ref").join(a, "source_decision_id").join(b, "target_ref").groupBy("from_language", "to_language").agg(F.count("*").alias("n"))


@R.add("""SELECT source_decision_id, target_ref, sum(mention_count)::BIGINT AS mentions, max(is_prior_instance) AS prior FROM decision_citations GROUP BY 1, 2""")
def agg_15_upsert_counter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "source_decision_id", "target_ref", "mention_count", "is_prior_instance").groupBy("source_decision_id", "target_ref").agg(F.sum("mention_count").alias("mentions"), F.max("is_prior_instance").alias("prior"))


@R.add("""SELECT ts::DATE::VARCHAR AS day, event_type, count(*) AS n, round(sum(value), 4) AS total, count(*) FILTER (WHERE value > 50) AS big, count(DISTINCT user_id) AS users, sum(event_id * 37 % 10000)::BIGINT AS bytes, count(*) FILTER (WHERE 100 + event_id * 37 % 600 BETWEEN 400 AND 499) AS n4xx, count(*) FILTER (WHERE 100 + event_id * 37 % 600 BETWEEN 500 AND 599) AS n5xx FROM events GROUP BY 1, 2""")
def agg_16_day_cells(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_id", "ts", "event_type", "value", "user_id").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.count_if(c("value") > 50).alias("big"), F.countDistinct("user_id").alias("users"), F.sum(c("event_id") * 37 % 10000).alias("bytes"), F.count_if((100 + c("event_id") * 37 % 600).between(400, 499)).alias("n4xx"), F.count_if((100 + c("event_id") * 37 % 600).between(500, 599)).alias("n5xx"))


@R.add("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def agg_17_interpolated_percentile(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_type", "value").transform(lambda df: A.percentiles(df, ["event_type"], "value", [0.5, 0.95], True)).select("event_type", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@R.add("""SELECT event_type, max(CASE WHEN i = least(floor(0.5 * n), n - 1) THEN value END) AS p50, max(CASE WHEN i = least(floor(0.95 * n), n - 1) THEN value END) AS p95 FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) GROUP BY 1""")
def agg_18_floor_percentile(s: SparkSession, d: str) -> DataFrame:
    return A.percentiles(table(s, d, "events", "event_type", "value"), ["event_type"], "value", [0.5, 0.95], False)


@R.add("""WITH n AS (SELECT event_type, ts::DATE AS day, count(*)::DOUBLE AS v FROM events GROUP BY 1, 2), m AS (SELECT event_type, median(v) AS middle FROM n GROUP BY 1) SELECT event_type, middle, middle - greatest(5 * mad, 0.05 * middle) AS low, middle + greatest(5 * mad, 0.05 * middle) AS high FROM (SELECT event_type, middle, median(abs(v - middle)) AS mad FROM n JOIN m USING (event_type) GROUP BY 1, 2)""")
def agg_19_mad_band(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "events", "event_type", "ts").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("v"))
    return A.mad_band(n, ["event_type"], "v")


def _close(estimate: Column, exact: Column, lg: int = 12) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * 3 * 1.04 / 2 ** (lg / 2))


@R.add("""SELECT event_type, count(DISTINCT event_id) AS exact, true AS close FROM events GROUP BY 1""")
def agg_20_hll_estimate(s: SparkSession, d: str) -> DataFrame:
    """Exact counts, and whether the estimate is within three standard errors (1.04 / sqrt(2^12)) of them."""
    n = table(s, d, "events", "event_type", "event_id").groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_sketch_agg("event_id", 12)).alias("e"), F.countDistinct("event_id").alias("exact"))
    return n.select("event_type", "exact", _close(c("e"), c("exact")).alias("close"))


@R.add()
def agg_21_hll_wire(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_type", "user_id").groupBy("event_type").agg(F.concat(F.lit("12:"), F.base64(F.hll_sketch_agg("user_id", 12))).alias("sketch"))


@R.add("""SELECT strftime(ts, '%G-W%V') AS week, count(DISTINCT event_id) AS exact, true AS close FROM events GROUP BY 1""")
def agg_22_hll_union(s: SparkSession, d: str) -> DataFrame:
    """Weekly counts from daily sketches, beside the exact ones."""
    daily = table(s, d, "events", "ts", "event_id").groupBy(F.to_date("ts").alias("day")).agg(F.hll_sketch_agg("event_id", 12).alias("sketch"))
    weekly = daily.groupBy(T.iso_week(c("day")).alias("week")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("e"))
    exact = table(s, d, "events", "ts", "event_id").groupBy(T.iso_week(c("ts")).alias("week")).agg(F.countDistinct("event_id").alias("exact"))
    return weekly.join(exact, "week").select("week", "exact", _close(c("e"), c("exact")).alias("close"))


@R.add("""SELECT week, sum(n)::BIGINT AS n, max(n) AS most, count(*) AS days FROM (SELECT strftime(ts, '%G-W%V') AS week, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def agg_24_weekly_rollup(s: SparkSession, d: str) -> DataFrame:
    daily = table(s, d, "events", "ts").groupBy(T.iso_week(c("ts")).alias("week"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy("week").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("days"))


@R.add("""WITH n AS (SELECT event_type, count(DISTINCT user_id) AS n, ('0x' || substr(md5(event_type || '#42'), 1, 8))::BIGINT / 4294967296.0 - 0.5 AS u FROM events GROUP BY 1) SELECT event_type, CASE WHEN n >= 10 THEN greatest(0, round_even(n + sign(u) * ln(1 - 2 * abs(u)), 0))::BIGINT END AS n_noisy FROM n""")
def agg_25_noisy_counts(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "events", "event_type", "user_id").groupBy("event_type").agg(F.countDistinct("user_id").alias("n"))
    return n.select("event_type", A.noisy_count(c("n"), 42, c("event_type")).alias("n_noisy"))


@R.add("""SELECT event_type, count(*) AS n FROM events WHERE ts::DATE > (SELECT max(ts::DATE) FROM events) - 7 GROUP BY 1""")
def agg_26_last_days(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "event_type", "ts").withColumn("day", F.to_date("ts"))
    last = e.agg(F.max("day")).first()[0]
    return e.where(c("day") > F.date_sub(F.lit(last), 7)).groupBy("event_type").agg(F.count("*").alias("n"))


@R.add("""SELECT target_ref, count(*) AS n, min(target_type) AS kind, array_to_string(list_slice(list_sort(list(DISTINCT source_decision_id)), 1, 3), ',') AS examples FROM decision_citations x WHERE NOT EXISTS (SELECT 1 FROM bge_register b WHERE b.bge_reference = x.target_ref) AND NOT EXISTS (SELECT 1 FROM decisions e WHERE e.docket_number = x.target_ref) GROUP BY 1 HAVING count(*) >= 2""")
def agg_27_unresolved_demand(s: SparkSession, d: str) -> DataFrame:
    known = table(s, d, "bge_register", "bge_reference").toDF("target_ref").union(table(s, d, "decisions", "docket_number").toDF("target_ref")).distinct()
    x = table(s, d, "decision_citations", "target_ref", "target_type", "source_decision_id").join(known, "target_ref", "left_anti")
    n = x.groupBy("target_ref").agg(F.count("*").alias("n"), F.min("target_type").alias("kind")).where("n >= 2")
    # the three smallest sources by a rank within each reference, not by collecting them all
    w = Window.partitionBy("target_ref").orderBy("source_decision_id")
    three = x.select("target_ref", "source_decision_id").distinct().withColumn("_r", F.row_number().over(w)).where("_r <= 3").groupBy("target_ref").agg(F.array_join(F.array_sort(F.collect_list("source_decision_id")), ",").alias("examples"))
    return n.join(three.withColumnRenamed("target_ref", "_t"), c("target_ref").eqNullSafe(c("_t")), "left").select("target_ref", "n", "kind", F.coalesce("examples", F.lit("")).alias("examples"))


@R.add("""SELECT target_ref, count(*) AS n, least(count(DISTINCT source_decision_id), 5000) AS sources FROM decision_citations GROUP BY 1""")
def agg_28_gap_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref", "source_decision_id").groupBy("target_ref").agg(F.count("*").alias("n"), F.least(F.countDistinct("source_decision_id"), F.lit(5000)).alias("sources"))


@R.add("""SELECT CASE WHEN target_ref IS NULL OR trim(target_ref) = '' THEN 'blank' WHEN regexp_matches(target_ref, '^(BGE|ATF|DTF)') THEN 'series' WHEN regexp_matches(target_ref, '[0-9]{4}') THEN 'docket' ELSE 'other' END AS bucket, sum(mention_count)::BIGINT AS mentions FROM decision_citations GROUP BY 1""")
def agg_29_weighted_buckets(s: SparkSession, d: str) -> DataFrame:
    r = c("target_ref")
    bucket = F.when(r.isNull() | (F.trim(r) == ""), "blank").when(r.rlike("^(BGE|ATF|DTF)"), "series").when(r.rlike("[0-9]{4}"), "docket").otherwise("other")
    return table(s, d, "decision_citations", "target_ref", "mention_count").groupBy(bucket.alias("bucket")).agg(F.sum("mention_count").alias("mentions"))


@R.add("""SELECT size, count(*) AS groups, sum(size - 1)::BIGINT AS surplus FROM (SELECT canonical_key, count(*) AS size FROM decisions WHERE canonical_key IS NOT NULL GROUP BY 1) GROUP BY 1""")
def agg_30_duplicate_census(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "decisions", "canonical_key").where(c("canonical_key").isNotNull()).groupBy("canonical_key").agg(F.count("*").alias("size"))
    return g.groupBy("size").agg(F.count("*").alias("groups"), F.sum(c("size") - 1).alias("surplus"))


@R.add("""SELECT court, count(*) FILTER (WHERE n BETWEEN 2 AND 6) AS twins, count(*) FILTER (WHERE n > 6) AS listings FROM (SELECT court, content_hash, count(*) AS n FROM decisions GROUP BY 1, 2) GROUP BY 1""")
def agg_31_twins(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "decisions", "court", "content_hash").groupBy("court", "content_hash").agg(F.count("*").alias("n"))
    return n.groupBy("court").agg(F.count_if(c("n").between(2, 6)).alias("twins"), F.count_if(c("n") > 6).alias("listings"))


def _golden(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    li = table(s, d, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    w = Window.partitionBy("l_suppkey").orderBy(c("l_quantity").desc(), "l_orderkey", "l_linenumber")
    doc = F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string"))
    results = li.select(c("l_suppkey").alias("query"), doc.alias("doc"), F.row_number().over(w).alias("rank"))
    relevant = li.where("l_returnflag = 'R'").select(c("l_suppkey").alias("query"), doc.alias("doc"), F.least(F.lit(3), c("l_linenumber")).alias("grade"))
    return results, relevant


@R.add("""WITH r AS (SELECT l_suppkey AS query, l_orderkey || '-' || l_linenumber AS doc, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS rank FROM lineitem),
g AS (SELECT l_suppkey AS query, l_orderkey || '-' || l_linenumber AS doc, least(3, l_linenumber) AS grade FROM lineitem WHERE l_returnflag = 'R'),
f AS (SELECT query, min(rank) AS first, count(*) AS n, sum((power(2, grade) - 1) / log2(rank + 1)) AS dcg FROM r JOIN g USING (query, doc) WHERE rank <= 10 GROUP BY 1),
i AS (SELECT query, count(*) AS total FROM g GROUP BY 1), b AS (SELECT query, sum((power(2, grade) - 1) / log2(p + 1)) AS best FROM (SELECT query, grade, row_number() OVER (PARTITION BY query ORDER BY grade DESC) AS p FROM g) WHERE p <= 10 GROUP BY 1)
SELECT query, round(coalesce(1.0 / first, 0), 6) AS mrr, round(coalesce(n / total, 0), 6) AS recall, round(coalesce(dcg / best, 0), 6) AS ndcg, CASE WHEN first = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit1 FROM i JOIN b USING (query) LEFT JOIN f USING (query)""")
def agg_32_retrieval_metrics(s: SparkSession, d: str) -> DataFrame:
    m = A.retrieval_metrics(*_golden(s, d))
    return m.select("query", F.round("mrr", 6).alias("mrr"), F.round("recall", 6).alias("recall"), F.round("ndcg", 6).alias("ndcg"), "hit1")


@R.add("""SELECT court, round((p + 1.9208 / n - 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) AS low, round((p + 1.9208 / n + 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) AS high FROM (SELECT court, count(*)::DOUBLE AS n, avg(CASE WHEN has_full_text THEN 1.0 ELSE 0.0 END) AS p FROM decisions GROUP BY 1)""")
def agg_34_wilson(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "decisions", "court", "has_full_text").groupBy("court").agg(F.count("*").cast("double").alias("n"), F.count_if("has_full_text").cast("double").alias("k"))
    w = T.wilson(c("k"), c("n"))
    return g.select("court", F.round(w["low"], 6).alias("low"), F.round(w["high"], 6).alias("high"))


@R.add("""SELECT target_type, count(*) AS n, count(*) FILTER (WHERE b.decision_id IS NOT NULL) AS resolved, count(*) FILTER (WHERE x.source_decision_id = b.decision_id) AS self FROM decision_citations x LEFT JOIN bge_register b ON b.bge_reference = x.target_ref GROUP BY 1""")
def agg_35_precision_proxies(s: SparkSession, d: str) -> DataFrame:
    b = table(s, d, "bge_register", "bge_reference", "decision_id").toDF("target_ref", "hit")
    return table(s, d, "decision_citations", "target_type", "target_ref", "source_decision_id").join(b, "target_ref", "left").groupBy("target_type").agg(F.count("*").alias("n"), F.count("hit").alias("resolved"), F.count_if(c("source_decision_id") == c("hit")).alias("self"))


@R.add("""SELECT source, count(*) AS expected, count(k) AS held, round(count(k) / count(*), 4) AS ratio FROM (SELECT DISTINCT source_decision_id AS e, left(source_decision_id, 3) AS source FROM decision_citations) LEFT JOIN (SELECT DISTINCT decision_id AS k FROM decisions WHERE has_full_text) ON e = k GROUP BY 1""")
def agg_36_coverage_gap(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "decision_citations", "source_decision_id").distinct().select(c("source_decision_id").alias("k"), F.substring("source_decision_id", 1, 3).alias("source"))
    held = table(s, d, "decisions", "decision_id", "has_full_text").where("has_full_text").select(c("decision_id").alias("k")).distinct().withColumn("held", F.lit(1))
    return e.join(held, "k", "left").groupBy("source").agg(F.count("*").alias("expected"), F.count("held").alias("held"), F.round(F.count("held") / F.count("*"), 4).alias("ratio"))


@R.add("""SELECT event_type, sum(value)::BIGINT AS total, count(DISTINCT user_id) AS users FROM (SELECT event_type, user_id, floor(value) AS value FROM events) GROUP BY 1""")
def agg_37_quota_counters(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_type", "user_id", "value").groupBy("event_type").agg(F.sum(F.floor("value")).alias("total"), F.countDistinct("user_id").alias("users"))


@R.add("""SELECT court, canton, count(*) AS n, count(*) FILTER (WHERE NOT regexp_matches(coalesce(decision_date, ''), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')) AS bad_dates, count(*) FILTER (WHERE length(coalesce(full_text, '')) < 500) AS short_texts, count(*) FILTER (WHERE coalesce(trim(title), '') = '') AS no_title FROM decisions GROUP BY 1, 2""")
def agg_38_quality_report(s: SparkSession, d: str) -> DataFrame:
    e = lambda x: F.coalesce(c(x), F.lit(""))
    return table(s, d, "decisions", "court", "canton", "decision_date", "full_text", "title").groupBy("court", "canton").agg(F.count("*").alias("n"), F.count_if(~e("decision_date").rlike(ISO)).alias("bad_dates"), F.count_if(F.length(e("full_text")) < 500).alias("short_texts"), F.count_if(F.trim(e("title")) == "").alias("no_title"))


@R.add()
def agg_39_merkle_root(s: SparkSession, d: str) -> DataFrame:
    return A.merkle_root(table(s, d, "documents", "doc_id", "text"), "doc_id", F.concat_ws("|", c("doc_id").cast("string"), F.coalesce("text", F.lit(""))))


@R.add("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def agg_40_rollup(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders", "o_orderstatus", "o_orderpriority").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@R.add("""WITH l AS (SELECT user_id % 5 AS boot, ts::DATE AS day, event_type, arg_max(event_id, ts) AS v FROM events WHERE event_type <> 'error' OR ts::DATE::VARCHAR > '2024-01-10' GROUP BY 1, 2, 3), y AS (SELECT boot, day, lag(day) OVER (PARTITION BY boot ORDER BY day) AS before FROM (SELECT DISTINCT boot, day FROM l))
SELECT l.boot, l.day::VARCHAR AS day, l.event_type, greatest(0, l.v - coalesce(p.v, 0)) AS delta FROM l JOIN y USING (boot, day) LEFT JOIN l p ON p.boot = l.boot AND p.day = y.before AND p.event_type = l.event_type""")
def agg_41_daily_deltas(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "event_id", "user_id", "event_type", "ts").withColumn("boot", c("user_id") % 5).withColumn("day", F.date_format("ts", "yyyy-MM-dd")).where("event_type <> 'error' OR day > '2024-01-10'")
    return A.deltas(e, "boot", "day", "event_type", "event_id", "ts")


@R.add("""WITH a AS (SELECT decision_id, min(content_hash) AS h FROM decisions WHERE scraped_at < TIMESTAMP '2023-12-01' GROUP BY 1), b AS (SELECT decision_id, max(coalesce(title, '') || content_hash) AS h FROM decisions GROUP BY 1), o AS (SELECT decision_id, max(coalesce(title, '') || content_hash) AS h FROM decisions WHERE scraped_at < TIMESTAMP '2023-12-01' GROUP BY 1)
SELECT CASE WHEN o.decision_id IS NULL THEN 'added' WHEN b.decision_id IS NULL THEN 'removed' WHEN o.h <> b.h THEN 'changed' ELSE 'same' END AS state, count(*) AS n FROM o FULL JOIN b USING (decision_id) GROUP BY 1""")
def agg_42_churn(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "title", "content_hash", "scraped_at")
    h = F.max(F.concat(F.coalesce("title", F.lit("")), "content_hash"))
    old = df.where(c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")).groupBy("decision_id").agg(h.alias("a"), F.lit(1).alias("ia"))
    new = df.groupBy("decision_id").agg(h.alias("b"), F.lit(1).alias("ib"))
    state = F.when(c("ia").isNull(), "added").when(c("ib").isNull(), "removed").when(c("a") != c("b"), "changed").otherwise("same")
    return old.join(new, "decision_id", "full").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@R.add("""WITH a AS (SELECT DISTINCT source_decision_id, target_ref, target_type FROM decision_citations WHERE mention_count = 1), b AS (SELECT DISTINCT source_decision_id, target_ref, target_type FROM decision_citations WHERE mention_count <= 3)
SELECT CASE WHEN NOT ia THEN 'new' WHEN NOT ib THEN 'lost' ELSE 'kept' END AS state, count(*) AS n FROM (SELECT a.source_decision_id IS NOT NULL AS ia, b.source_decision_id IS NOT NULL AS ib FROM (SELECT DISTINCT source_decision_id, target_ref FROM a WHERE target_ref IS NOT NULL) a FULL JOIN (SELECT DISTINCT source_decision_id, target_ref FROM b WHERE target_ref IS NOT NULL) b ON a.source_decision_id = b.source_decision_id AND a.target_ref = b.target_ref) GROUP BY 1""")
def agg_43_token_transitions(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "source_decision_id", "target_ref", "mention_count").where(c("target_ref").isNotNull())
    key = ["source_decision_id", "target_ref"]
    a, b = x.where("mention_count = 1").select(*key).distinct().withColumn("ia", F.lit(1)), x.where("mention_count <= 3").select(*key).distinct().withColumn("ib", F.lit(1))
    return a.join(b, key, "full").groupBy(F.when(c("ia").isNull(), "new").when(c("ib").isNull(), "lost").otherwise("kept").alias("state")).agg(F.count("*").alias("n"))


@R.add("""SELECT court, y, count(*) AS n FROM (SELECT DISTINCT court, decision_id, CASE WHEN regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN left(decision_date, 4) ELSE 'undated' END AS y FROM decisions) GROUP BY 1, 2""")
def agg_46_court_by_year(s: SparkSession, d: str) -> DataFrame:
    y = F.when(c("decision_date").rlike(ISO), F.substring("decision_date", 1, 4)).otherwise("undated")
    return table(s, d, "decisions", "court", "decision_id", "decision_date").select("court", "decision_id", y.alias("y")).distinct().groupBy("court", "y").agg(F.count("*").alias("n"))


@R.add("""SELECT event_type, user_id % 3 AS grp, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY GROUPING SETS ((event_type), (user_id % 3), (event_type, user_id % 3), ())""")
def agg_48_several_grains(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_type", "user_id", "value").withColumn("grp", c("user_id") % 3).cube("event_type", "grp").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@R.add("""SELECT lang, count(*) AS n, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY 1""")
def agg_49_trace_summary(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "lang", "n_chars").groupBy("lang").agg(F.count("*").alias("n"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))


@R.add("""SELECT hour(ts) AS h, event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1, 2""")
def agg_50_last_day_by_hour(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "ts", "event_type")
    last = e.agg(F.max("ts")).first()[0]
    return e.where(c("ts") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL '24' HOUR")).groupBy(F.hour("ts").alias("h"), "event_type").agg(F.count("*").alias("n"))


@R.add("""SELECT b.bge_reference, CASE WHEN x.n IS NULL THEN 'uncited' WHEN x.early > 0 THEN 'wrong' ELSE 'correct' END AS verdict FROM bge_register b LEFT JOIN (SELECT target_ref, count(*) AS n, count(*) FILTER (WHERE is_prior_instance = 1) AS early FROM decision_citations GROUP BY 1) x ON x.target_ref = b.bge_reference""")
def agg_51_rule_verdicts(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "target_ref", "is_prior_instance").groupBy(c("target_ref").alias("bge_reference")).agg(F.count("*").alias("n"), F.count_if(c("is_prior_instance") == 1).alias("early"))
    return table(s, d, "bge_register", "bge_reference").join(x, "bge_reference", "left").select("bge_reference", F.when(c("n").isNull(), "uncited").when(c("early") > 0, "wrong").otherwise("correct").alias("verdict"))


@R.add("""SELECT division, array_to_string(list_sort(list(DISTINCT upper(lang))), ',') AS languages, min(volume) AS first_volume, max(volume) AS last_volume FROM bge_register GROUP BY 1""")
def agg_52_reference_table(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bge_register", "division", "lang", "volume").groupBy("division").agg(F.array_join(F.array_sort(F.collect_set(F.upper("lang"))), ",").alias("languages"), F.min("volume").alias("first_volume"), F.max("volume").alias("last_volume"))


@R.add("""SELECT g.classification, count(*) AS n, count(i.k) AS under_other_name FROM citation_gaps g LEFT JOIN (SELECT DISTINCT docket_number_2 AS k FROM bge_register) i ON i.k = g.target_ref GROUP BY 1""")
def agg_53_refined_gaps(s: SparkSession, d: str) -> DataFrame:
    i = table(s, d, "bge_register", "docket_number_2").distinct().select(c("docket_number_2").alias("target_ref"), F.lit(1).alias("k"))
    return table(s, d, "citation_gaps", "target_ref", "classification").join(i, "target_ref", "left").groupBy("classification").agg(F.count("*").alias("n"), F.count("k").alias("under_other_name"))


@R.add("""WITH x AS (SELECT DISTINCT target_ref, regexp_extract(target_ref, '^BGE ([0-9]+) ([IV]+) ([0-9]+)$', 1)::INT AS v, regexp_extract(target_ref, '^BGE ([0-9]+) ([IV]+) ([0-9]+)$', 2) AS dv, regexp_extract(target_ref, '^BGE ([0-9]+) ([IV]+) ([0-9]+)$', 3)::INT AS p FROM decision_citations WHERE regexp_matches(target_ref, '^BGE ([0-9]+) ([IV]+) ([0-9]+)$')),
y AS (SELECT x.* FROM x WHERE NOT EXISTS (SELECT 1 FROM bge_register b WHERE b.volume = v AND b.division = dv AND b.first_page = p))
SELECT target_ref, 'division' AS repair, bge_reference AS candidate FROM y JOIN bge_register b ON b.volume = v AND b.first_page = p UNION ALL SELECT target_ref, 'volume', bge_reference FROM y JOIN bge_register b ON b.division = dv AND b.first_page = p AND abs(b.volume - v) <= 1""")
def agg_54_repair_candidates(s: SparkSession, d: str) -> DataFrame:
    p = "^BGE ([0-9]+) ([IV]+) ([0-9]+)$"
    x = table(s, d, "decision_citations", "target_ref").where(c("target_ref").rlike(p)).distinct().select("target_ref", F.regexp_extract("target_ref", p, 1).cast("int").alias("volume"), F.regexp_extract("target_ref", p, 2).alias("division"), F.regexp_extract("target_ref", p, 3).cast("int").alias("first_page"))
    b = table(s, d, "bge_register", "bge_reference", "volume", "division", "first_page")
    y = x.join(b, ["volume", "division", "first_page"], "left_anti")
    one = y.join(b.drop("division"), ["volume", "first_page"]).select("target_ref", F.lit("division").alias("repair"), c("bge_reference").alias("candidate"))
    near = y.withColumn("volume", F.explode(F.array(c("volume") - 1, c("volume"), c("volume") + 1)))
    return one.unionByName(near.join(b, ["volume", "division", "first_page"]).select("target_ref", F.lit("volume").alias("repair"), c("bge_reference").alias("candidate")))


@R.add("""SELECT court, count(*) AS n FROM decisions a WHERE EXISTS (SELECT 1 FROM decision_citations x WHERE x.source_decision_id = a.decision_id) GROUP BY 1""")
def agg_55_compare_without_orphans(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "decision_citations", "source_decision_id").withColumnRenamed("source_decision_id", "decision_id")
    return table(s, d, "decisions", "decision_id", "court").join(x, "decision_id", "left_semi").groupBy("court").agg(F.count("*").alias("n"))
