"""Queries of incremental, temporal and streaming operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import incremental as I
from tessera.plans.registry import Registry
from tessera.sources.tables import table
from tessera.streaming import counters as C

R = Registry()
c = F.col
_OLD = "SELECT decision_id, max(content_hash || coalesce(title, '')) AS h FROM decisions WHERE scraped_at < TIMESTAMP '2023-12-01' GROUP BY 1"
_NEW = "SELECT decision_id, max(content_hash || coalesce(title, '')) AS h FROM decisions WHERE court <> 'ti_gerichte' GROUP BY 1"


def _snapshots(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    df = table(s, d, "decisions", "decision_id", "content_hash", "title", "court", "scraped_at")
    h = F.max(F.concat("content_hash", F.coalesce("title", F.lit("")))).alias("h")
    return df.where(c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")).groupBy("decision_id").agg(h), df.where("court <> 'ti_gerichte'").groupBy("decision_id").agg(h)


@R.add(f"""SELECT decision_id, CASE WHEN a.decision_id IS NULL THEN 'new' WHEN b.decision_id IS NULL THEN 'deleted' ELSE 'changed' END AS state FROM ({_OLD}) a FULL JOIN ({_NEW}) b USING (decision_id) WHERE a.decision_id IS NULL OR b.decision_id IS NULL OR a.h IS DISTINCT FROM b.h""")
def inc_02_hash_diff(s: SparkSession, d: str) -> DataFrame:
    return I.changes(*_snapshots(s, d), "decision_id", "h")


@R.add(f"""SELECT decision_id FROM ({_NEW}) WHERE decision_id NOT IN (SELECT decision_id FROM ({_OLD}))""")
def inc_03_new_ids(s: SparkSession, d: str) -> DataFrame:
    old, new = _snapshots(s, d)
    return new.join(old, "decision_id", "left_anti").select("decision_id")


@R.add(f"""SELECT decision_id, h FROM ({_NEW})""")
def inc_04_apply_is_full(s: SparkSession, d: str) -> DataFrame:
    old, new = _snapshots(s, d)
    return I.apply_changes(old, new, I.changes(old, new, "decision_id", "h"), "decision_id")


@R.add("""SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR""")
def inc_08_recent_window(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "event_id", "ts")
    last = e.agg(F.max("ts")).first()[0]
    return e.where(c("ts") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL '3' HOUR")).select("event_id")


@R.add("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def inc_10_streaming_windows(s: SparkSession, d: str) -> DataFrame:
    from tessera.session import scratch

    stream = s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    folder = scratch(s, "windows")
    out = C.run_available(C.tumbling(stream, "ts", "event_type", late="40 days"), "rows", "complete", folder)
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@R.add("""SELECT week, n FROM (SELECT strftime(ts, '%G-W%V') AS week, count(*) AS n FROM events GROUP BY 1)""")
def inc_11_idempotent_rollup(s: SparkSession, d: str) -> DataFrame:
    from tessera.functions.text import iso_week

    """Weeks rolled up while the last three days were missing; those that these touch are rolled up again."""
    events = table(s, d, "events", "ts").withColumn("week", iso_week(c("ts")))
    cut = F.lit(events.agg(F.max("ts")).first()[0]).cast("timestamp_ntz") - F.expr("INTERVAL '3' DAY")
    late = events.where(c("ts") >= cut)
    rolled = lambda df: df.groupBy("week").agg(F.count("*").alias("n"))
    return I.rollup_rewrite(rolled(events.where(c("ts") < cut)), rolled(events.join(late.select("week").distinct(), "week", "left_semi")), "week")


@R.add("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM g GROUP BY user_id, k""")
def inc_12_sessions(s: SparkSession, d: str) -> DataFrame:
    return I.sessions(table(s, d, "events", "user_id", "ts"), "user_id", "ts").select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@R.add("""WITH r AS (SELECT DISTINCT decision_id, scraped_at, coalesce(title, '') AS h FROM decisions), m AS (SELECT *, lag(h) OVER (PARTITION BY decision_id ORDER BY scraped_at, h) AS p FROM r), k AS (SELECT * FROM m WHERE p IS NULL OR p <> h) SELECT decision_id, count(*) AS n FROM k GROUP BY 1""")
def inc_14_versions(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "decisions", "decision_id", "scraped_at", "title").select("decision_id", F.struct("scraped_at", F.coalesce("title", F.lit("")).alias("h")).alias("at"), F.coalesce("title", F.lit("")).alias("h")).distinct()
    return I.versions(rows, "decision_id", "at", "h").groupBy("decision_id").agg(F.max("version_no").cast("bigint").alias("n"))


@R.add("""SELECT DISTINCT decision_id, true AS same FROM decisions WHERE full_text IS NOT NULL AND content_text IS NOT NULL""")
def inc_15_reverse_diff_round_trip(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def back(current: pd.Series, diff: pd.Series) -> pd.Series:
        return pd.Series([I.apply_diff(x, bytes(y)) for x, y in zip(current, diff)])

    rows = table(s, d, "decisions", "decision_id", "full_text", "content_text").where("full_text is not null and content_text is not null")
    return rows.withColumn("diff", I.reverse_diffs(rows, "full_text", "content_text")).select("decision_id", (back(c("full_text"), c("diff")) == c("content_text")).alias("same")).distinct()


@R.add("""SELECT DISTINCT decision_id FROM decisions WHERE decision_id IS NOT NULL AND decision_id NOT IN (SELECT decision_id FROM version_removals GROUP BY 1 HAVING datediff('day', max(removed_at)::DATE, DATE '2024-12-31') < 30)""")
def inc_16_due_for_check(s: SparkSession, d: str) -> DataFrame:
    return I.due(table(s, d, "decisions", "decision_id").where(c("decision_id").isNotNull()), table(s, d, "version_removals", "decision_id", "removed_at"), "decision_id", "removed_at", "2024-12-31")


@R.add("""SELECT decision_id, CASE WHEN decision_id IN (SELECT decision_id FROM decisions WHERE has_full_text) THEN 'resolved' ELSE 'open' END AS state FROM (SELECT DISTINCT source_decision_id AS decision_id FROM decision_citations)""")
def inc_17_reconcile_queue(s: SparkSession, d: str) -> DataFrame:
    expected = table(s, d, "decision_citations", "source_decision_id").select(c("source_decision_id").alias("decision_id")).distinct()
    held = table(s, d, "decisions", "decision_id", "has_full_text").where("has_full_text")
    return I.reconcile(expected, held, expected.withColumn("state", F.lit("open")), "decision_id")


@R.add("""SELECT event_id FROM events WHERE ts >= DATE '2024-01-30' - 7""")
def inc_19_retention(s: SparkSession, d: str) -> DataFrame:
    return I.retained(table(s, d, "events", "event_id", "ts"), "ts", "2024-01-30", 7).select("event_id")


@R.add("""SELECT court, datediff('second', max(scraped_at), TIMESTAMP '2025-01-01') AS seconds FROM (SELECT court, date_trunc('second', scraped_at) AS scraped_at FROM decisions) GROUP BY 1""")
def inc_21_freshness(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "decisions", "court", "scraped_at").withColumn("scraped_at", F.date_trunc("second", "scraped_at").cast("timestamp_ntz"))
    return I.freshness(rows, "court", "scraped_at", "2025-01-01")


@R.add("""WITH g AS (SELECT user_id, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM events), h AS (SELECT user_id, CASE WHEN g > 0 AND g < 1800 THEN g END AS g FROM g), s AS (SELECT user_id, count(*) AS n, count(g) AS gaps, avg(g) AS m, stddev_pop(g) / avg(g) AS cv FROM h GROUP BY 1) SELECT user_id, n, gaps, CASE WHEN (gaps >= 5 AND (cv < 0.15 OR m < 2.0)) OR n > 120 THEN 'bot' ELSE 'person' END AS verdict FROM s""")
def inc_25_visitor_state(s: SparkSession, d: str) -> DataFrame:
    return C.visitors_batch(table(s, d, "events", "user_id", "ts"), "ts").select("user_id", "n", "gaps", "verdict")


@R.add("""SELECT user_id, min(event_id) AS first_event FROM events GROUP BY 1""")
def inc_07_seen_set(s: SparkSession, d: str) -> DataFrame:
    from tessera.session import scratch

    stream = s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    folder = scratch(s, "seen")
    seen = C.run_available(C.once(stream, "user_id", "ts", "60 days").select("user_id"), "rows", "append", folder)
    return seen.join(table(s, d, "events", "user_id", "event_id"), "user_id").groupBy("user_id").agg(F.min("event_id").alias("first_event"))


@R.add("""WITH g AS (SELECT user_id, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM events), h AS (SELECT user_id, CASE WHEN g > 0 AND g < 1800 THEN g END AS g FROM g), s AS (SELECT user_id, count(*) AS n, count(g) AS gaps, avg(g) AS m, stddev_pop(g) / avg(g) AS cv FROM h GROUP BY 1) SELECT verdict, count(*) AS visitors FROM (SELECT CASE WHEN (gaps >= 5 AND (cv < 0.15 OR m < 2.0)) OR n > 120 THEN 'bot' ELSE 'person' END AS verdict FROM s) GROUP BY 1""")
def inc_26_verdicts_from_stream(s: SparkSession, d: str) -> DataFrame:
    from tessera.session import scratch

    stream = s.readStream.schema(C.EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    folder = scratch(s, "visitors")
    out = C.run_available(C.visitors(stream, "ts"), "rows", "update", folder)
    last = out.groupBy("user_id").agg(F.max_by("verdict", "n").alias("verdict"))
    return last.groupBy("verdict").agg(F.count("*").alias("visitors"))


@R.add("""SELECT target_ref AS k, CASE WHEN citation_count > 3 THEN 1 ELSE 0 END AS retry_count, CASE WHEN citation_count > 3 THEN strftime(checked_at::DATE + 7, '%Y-%m-%d') END AS next_retry_at FROM citation_gaps""")
def inc_18_retry(s: SparkSession, d: str) -> DataFrame:
    gaps = table(s, d, "citation_gaps", "target_ref", "citation_count", "checked_at")
    queue = gaps.select(c("target_ref").alias("k"), F.lit(0).alias("retry_count"), F.lit(None).cast("date").alias("next_retry_at"))
    failed = gaps.where("citation_count > 3").select(c("target_ref").alias("k"), F.to_date("checked_at").alias("at"))
    return I.retry(queue, failed, "k", "at").select("k", "retry_count", c("next_retry_at").cast("string").alias("next_retry_at"))


@R.add("""SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE ts >= DATE '2024-01-30' - 10 GROUP BY 1, 2""")
def inc_22_history_window(s: SparkSession, d: str) -> DataFrame:
    rows = I.retained(table(s, d, "events", "event_type", "ts"), "ts", "2024-01-30", 10)
    return rows.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@R.add("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def inc_23_resume(s: SparkSession, d: str) -> DataFrame:
    """The documents that an earlier run has not embedded: an anti-join on its keys, not an offset."""
    return table(s, d, "documents", "doc_id").join(table(s, d, "embeddings", "vec_id").withColumnRenamed("vec_id", "doc_id"), "doc_id", "left_anti")
