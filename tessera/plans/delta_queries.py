"""Queries of deltas, snapshots, histories and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import extract as E
from tessera.operators import delta as D
from tessera.operators import quality as Q
from tessera.operators.aggregates import positions
from tessera.plans import extract_queries, quality_queries
from tessera.plans.registry import Registry
from tessera.session import scratch
from tessera.sources import readers, writers
from tessera.sources.tables import table
from tessera.streaming import counters as C

R = Registry()
c = F.col
_LAST = "scraped_at >= (SELECT max(scraped_at) FROM decisions) - INTERVAL 200 DAY"


def _folder(s: SparkSession) -> str:
    return scratch(s, "io")


def _recent(s: SparkSession, d: str) -> DataFrame:
    """Ids whose newest record is of the last 200 days before the newest of all."""
    rows = table(s, d, "decisions", "decision_id", "scraped_at")
    last = rows.agg(F.max("scraped_at")).first()[0]
    return rows.where(c("scraped_at") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL '200' DAY")).select("decision_id").distinct()


@R.add("SELECT " + ", ".join(f"{old} AS {new}" for new, old in D.VOCABULARY.items() if new != "text") + ", md5(full_text) AS text_hash, coalesce(content_hash, sha256(full_text)) AS hash FROM decisions")
def prj_04_delta_vocabulary(s: SparkSession, d: str) -> DataFrame:
    """Every decision under the delta's names; texts by their hash."""
    rows = D.to_vocabulary(table(s, d, "decisions", *D.VOCABULARY.values(), "content_hash"))
    return rows.withColumn("text_hash", F.md5("text")).drop("text")


@R.add(f"SELECT decision_id, court, has_full_text, text_length, md5(full_text) AS text_hash FROM decisions WHERE decision_id IN (SELECT decision_id FROM decisions WHERE {_LAST})")
def snk_11_delta_base_schema(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    D.export(table(s, d, "decisions"), _recent(s, d), "decision_id", out)
    return s.read.parquet(out).select("decision_id", "court", "has_full_text", "text_length", F.md5("full_text").alias("text_hash"))


@R.add(f"SELECT decision_id, decision_date, text_length::VARCHAR AS text_length, has_full_text::VARCHAR AS has_full_text FROM decisions WHERE decision_id IN (SELECT decision_id FROM decisions WHERE {_LAST})")
def snk_12_delta_strings(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    D.export(table(s, d, "decisions", "decision_id", "decision_date", "text_length", "has_full_text"), _recent(s, d), "decision_id", out, strings=True, order=["decision_date", "decision_id"])
    return s.read.parquet(out)


@R.add("SELECT count(*) AS n_rows, true AS intact, false AS intact_after_loss FROM decisions")
def snk_13_snapshot_artifact(s: SparkSession, d: str) -> DataFrame:
    """A snapshot with its manifest; the manifest notices that a row has gone."""
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "court", "docket_number", "content_hash", "scraped_at")
    told = D.snapshot_artifact(rows, "decision_id", out, ["decision_id", "court"])
    good = D.intact(s, out, "decision_id")
    rows.limit(told["rows"] - 1).write.mode("overwrite").parquet(f"{out}/rows")
    return s.createDataFrame([(told["rows"], good, D.intact(s, out, "decision_id"))], "n_rows bigint, intact boolean, intact_after_loss boolean")


@R.add("SELECT count(*) AS n, true AS noticed FROM nation")
def snk_14_drift_guard(s: SparkSession, d: str) -> DataFrame:
    """Reading goes through while the source stays, and is refused when it changes."""
    out = _folder(s)
    table(s, d, "nation", "n_nationkey").write.parquet(out)
    rows = s.read.parquet(out)
    with D.unchanged(rows):
        n = rows.count()
    try:
        with D.unchanged(rows):
            table(s, d, "region", "r_regionkey").write.mode("overwrite").parquet(out)
        noticed = False
    except Exception:  # a changed or a vanished file
        noticed = True
    return s.createDataFrame([(n, noticed)], "n bigint, noticed boolean")


@R.add("SELECT court, count(*) AS n FROM decisions WHERE court NOT IN ('ti_gerichte', 'vd_gerichte') GROUP BY 1")
def snk_02_courts_without_excluded(s: SparkSession, d: str) -> DataFrame:
    """A second export leaves courts out, and their old files go."""
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "court")
    writers.by_partition(rows, out, "court")
    writers.by_partition(rows.where(~c("court").isin("ti_gerichte", "vd_gerichte")), out, "court")
    return s.read.parquet(out).groupBy("court").agg(F.count("*").alias("n"))


@R.add("SELECT decision_id, has_full_text::INT AS has_full_text, is_prior_instance FROM decisions JOIN decision_citations ON source_decision_id = decision_id")
def snk_04_query_to_parquet(s: SparkSession, d: str) -> DataFrame:
    """Any query's result as Parquet, booleans as numbers."""
    out = _folder(s)
    for name in ("decisions", "decision_citations"):
        table(s, d, name).createOrReplaceTempView(f"{name}_view")
    writers.query_to_parquet(s, "SELECT decision_id, has_full_text, is_prior_instance FROM decisions_view JOIN decision_citations_view ON source_decision_id = decision_id", out)
    return s.read.parquet(out)


@R.add("SELECT decision_id, min(shard) AS shard FROM (SELECT decision_id, CASE WHEN day(scraped_at) <= 15 THEN 'day=a' ELSE 'day=b' END AS shard FROM decisions) GROUP BY 1")
def snk_09_import_shards(s: SparkSession, d: str) -> DataFrame:
    """Daily shards imported in their order; an id that is there stays as it is."""
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "scraped_at")
    early = F.dayofmonth("scraped_at") <= 15
    rows.where(early).write.parquet(f"{out}/day=a")
    rows.where(~early).write.parquet(f"{out}/day=b")
    held = readers.parquet_shards(s, out).select("decision_id", F.regexp_extract(F.input_file_name(), "(day=[ab])", 1).alias("shard"))
    return held.groupBy("decision_id").agg(F.min("shard").alias("shard"))


@R.add("SELECT source, CASE WHEN trust_rank::VARCHAR = '3' THEN 'diff' ELSE 'full' END AS mode FROM data_sources")
def inc_05_diff_base(s: SparkSession, d: str) -> DataFrame:
    return D.diff_base(table(s, d, "data_sources", "source", "trust_rank").withColumn("version", c("trust_rank").cast("string")), "3").select("source", "mode")


@R.add(extract_queries.R.sql["tvf_05_plain_citations"])
def inc_06_incremental_extraction(s: SparkSession, d: str) -> DataFrame:
    """Citations of all documents, of which only those changed since an earlier run are read again."""
    docs = table(s, d, "documents", "doc_id", "text")
    extract = lambda df: df.where(c("text").isNotNull()).select("doc_id", F.explode(E.plain_citations(c("text"))).alias("citation"))
    # an earlier run: other texts then of every fifth document, and one document in seven not yet there
    earlier = docs.where("doc_id % 7 <> 0").withColumn("text", F.when(c("doc_id") % 5 == 0, F.lit("BGE 1 I 1")).otherwise(c("text")))
    return D.refreshed(extract(earlier), earlier.select("doc_id", F.xxhash64("text").alias("digest")), docs, "doc_id", F.xxhash64("text"), extract)


@R.add("SELECT decision_id, CASE WHEN min(court <> 'bger') THEN 1 ELSE 2 END AS generation FROM decisions GROUP BY 1")
def inc_09_quick_publish(s: SparkSession, d: str) -> DataFrame:
    """Two generations: all courts but one, then what was not there yet."""
    root = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "court")
    D.quick_publish(s, root, rows.where("court <> 'bger'"), "decision_id")
    D.quick_publish(s, root, rows, "decision_id")
    return s.read.parquet(*D.published_paths(s, root)).select("decision_id", F.regexp_extract(F.input_file_name(), r"generation=(\d+)", 1).cast("int").alias("generation"))


@R.add(quality_queries.R.sql["qc_graph_checks"])
def snk_26_report_json(s: SparkSession, d: str) -> DataFrame:
    """The report as JSON under its own and under the day's name."""
    out = _folder(s)
    writers.report(Q.run(table(s, d, "decision_citations"), Q.graph_checks()), out, "2024-12-31")
    today, dated = s.read.json(f"{out}/latest"), s.read.json(f"{out}/2024-12-31")
    return today.join(dated.select("check"), "check", "left_semi").select("check", c("metric").cast("double").alias("metric"))


@R.add("""SELECT run, "check", metric FROM (SELECT '1' AS run, 'corpus_total_count' AS "check", count(*)::DOUBLE AS metric FROM decisions WHERE court = 'bger' UNION ALL SELECT '2', 'corpus_total_count', count(*)::DOUBLE FROM decisions)""")
def snk_27_metric_history(s: SparkSession, d: str) -> DataFrame:
    """Each run's measurements once, also of one that ran twice."""
    rows = table(s, d, "decisions", "decision_id", "court")
    total = [k for k in Q.decision_checks("2024-12-31") if k.name == "corpus_total_count"]
    measured = lambda run, df: Q.run(df, total).select(F.lit(run).alias("run"), "check", "metric")
    history = D.upsert(None, measured("1", rows.where("court = 'bger'")), ["run", "check"])
    history = D.upsert(history, measured("2", rows.where("court <> 'bger'")), ["run", "check"])
    return D.upsert(history, measured("2", rows), ["run", "check"])


@R.add("""SELECT row_number() OVER (ORDER BY decision_id) - 1 AS pos, decision_id, sha256(decision_id || '|' || h) AS leaf FROM (SELECT decision_id, max(coalesce(content_hash, '')) AS h FROM decisions WHERE decision_id IS NOT NULL GROUP BY 1)""")
def snk_28_leaves(s: SparkSession, d: str) -> DataFrame:
    """The leaf hashes in order, as a table from which proofs are drawn."""
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "content_hash").where(c("decision_id").isNotNull()).groupBy("decision_id").agg(F.max(F.coalesce("content_hash", F.lit(""))).alias("h"))
    positions(rows, ["decision_id"]).select("pos", "decision_id", F.sha2(F.concat_ws("|", "decision_id", "h"), 256).alias("leaf")).write.parquet(out)
    return s.read.parquet(out)


@R.add("""SELECT member_decision_id, count(DISTINCT canonical_decision_id) AS n FROM decision_representations WHERE member_decision_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT canonical_decision_id) > 1""")
def snk_29_members_claimed_twice(s: SparkSession, d: str) -> DataFrame:
    links = table(s, d, "decision_representations", "member_decision_id", "canonical_decision_id").where(c("member_decision_id").isNotNull())
    return D.claimed_twice(links, "member_decision_id", "canonical_decision_id")


@R.add("""SELECT source, y, count(DISTINCT decision_id) AS n FROM (SELECT coalesce(source, '') AS source, year(scraped_at) AS y, decision_id FROM decisions) GROUP BY 1, 2""")
def snk_30_coverage_snapshot(s: SparkSession, d: str) -> DataFrame:
    """Counts of each source and year; a later measurement takes the place of an earlier one."""
    rows = table(s, d, "decisions", "decision_id", "source", "scraped_at").select("decision_id", F.coalesce("source", F.lit("")).alias("source"), F.year("scraped_at").alias("y"))
    counted = lambda df: df.groupBy("source", "y").agg(F.countDistinct("decision_id").alias("n"))
    return D.upsert(counted(rows.where("decision_id < 'm'")), counted(rows), ["source", "y"])


@R.add("""SELECT decision_id, court FROM decisions WHERE lower(court) IN ('bger', 'bvger')""")
def src_04_courts_only(s: SparkSession, d: str) -> DataFrame:
    """The courts asked for, by a filter that the scan takes on."""
    return readers.corpus(s, f"{d}/decisions.parquet", ["BGer", "BVGer"]).select("decision_id", "court")


@R.add("""SELECT doc_id, 'table' AS read_from FROM documents""")
def src_05_source_choice(s: SparkSession, d: str) -> DataFrame:
    """The table where there is one, else the shards of JSON lines."""
    out = _folder(s)
    df, origin = readers.table_else_jsonl(s, f"{d}/documents.parquet", out, "doc_id bigint")
    return df.select("doc_id", F.lit(origin).alias("read_from"))


@R.add("""SELECT DISTINCT decision_id, title FROM decisions WHERE decision_id IN (SELECT canonical_decision_id FROM decision_representations)""")
def src_09_rows_of_ids(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "decision_representations", "canonical_decision_id").toDF("decision_id")
    return table(s, d, "decisions", "decision_id", "title").join(ids, "decision_id", "left_semi").distinct()


@R.add("""SELECT DISTINCT decision_id FROM decisions WHERE decision_id <> ''""")
def src_10_keys(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").where("decision_id <> ''").distinct()


@R.add("""WITH r AS (SELECT * FROM decisions WHERE regexp_matches(publication_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND publication_date < '2025'), n AS (SELECT max(try_cast(publication_date AS DATE)) AS today FROM r) SELECT DISTINCT decision_id, publication_date FROM r, n WHERE try_cast(publication_date AS DATE) BETWEEN today - 100 AND today""")
def src_35_recent_overlay(s: SparkSession, d: str) -> DataFrame:
    """Decisions published in the days up to the newest publication, once each."""
    rows = table(s, d, "decisions", "decision_id", "publication_date").where(c("publication_date").rlike(Q.ISO) & (c("publication_date") < "2025"))
    return readers.recent(rows, "decision_id", "publication_date", str(rows.agg(F.max(c("publication_date").try_cast("date"))).first()[0]), 100)


@R.add("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS client_class, count(DISTINCT substr(sha256(user_id || '|' || props || '|' || strftime(ts, '%Y-%m-%d')), 1, 8)) AS cohorts FROM events GROUP BY 1, 2""")
def src_13_cohorts_of_log(s: SparkSession, d: str) -> DataFrame:
    """A log's visitors by day and class, under hashes of client, agent and day that change daily."""
    out = _folder(s)
    day = F.date_format("ts", "yyyy-MM-dd")
    line = F.concat_ws(" ", day, "event_type", F.substring(F.sha2(F.concat_ws("|", c("user_id").cast("string"), "props", day), 256), 1, 8))
    table(s, d, "events").select(line.alias("value")).write.option("compression", "gzip").text(out)
    return readers.cohorts(s, out).groupBy("day", "client_class").agg(F.countDistinct("cohort").alias("cohorts"))


@R.add("""SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def inc_20_quota_counters(s: SparkSession, d: str) -> DataFrame:
    """Requests of each user and kind, counted by a stream."""
    stream = s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    return C.run_available(stream.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), "rows", "complete", f"{_folder(s)}/quota")


@R.add("""SELECT event_type AS client_class, count(*) AS n, count(DISTINCT user_id) AS clients FROM events GROUP BY 1""")
def inc_24_syslog_lines(s: SparkSession, d: str) -> DataFrame:
    """Datagrams ``client|agent|class`` from a stream of lines; the class may be missing."""
    out = _folder(s)
    table(s, d, "events").select(F.concat_ws("|", c("user_id").cast("string"), F.lit("agent"), "event_type").alias("value")).write.text(f"{out}/in")
    parsed = C.syslog(s.readStream.text(f"{out}/in"))
    return C.run_available(parsed, "rows", "append", f"{out}/run").groupBy("client_class").agg(F.count("*").alias("n"), F.countDistinct("client").alias("clients"))


@R.add("""WITH e AS (SELECT event_type, event_id % 2 = 0 AS even FROM events) SELECT 'interim' AS stage, event_type, count(*) AS n FROM e WHERE even GROUP BY 2 UNION ALL SELECT 'final', event_type, count(*) FROM e GROUP BY 2""")
def inc_27_resume_and_28_interim(s: SparkSession, d: str) -> DataFrame:
    """Counts after half of the files, and after the stream has gone on from its checkpoint with the others."""
    out = _folder(s)
    events = table(s, d, "events")
    counts = lambda: s.readStream.schema(C.EVENTS).parquet(f"{out}/in/*").groupBy("event_type").agg(F.count("*").alias("n"))
    events.where("event_id % 2 = 0").write.parquet(f"{out}/in/a")
    interim = C.run_available(counts(), "rows", "complete", f"{out}/run").select(F.lit("interim").alias("stage"), "event_type", "n")
    interim.write.parquet(f"{out}/interim")
    events.where("event_id % 2 = 1").write.parquet(f"{out}/in/b")
    final = C.run_available(counts(), "rows", "complete", f"{out}/run").select(F.lit("final").alias("stage"), "event_type", "n")
    return s.read.parquet(f"{out}/interim").unionByName(final)


@R.add("""SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def src_28_append_jsonl(s: SparkSession, d: str) -> DataFrame:
    """A stream appended to a folder of JSON lines, which keeps what was there."""
    out = _folder(s)
    stream = s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d).select("event_id", "event_type")
    stream.writeStream.format("json").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return readers.jsonl(s, f"{out}/rows", "event_id bigint, event_type string").where("_bad is null").groupBy("event_type").agg(F.count("*").alias("n"))
