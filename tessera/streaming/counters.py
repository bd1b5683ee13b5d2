"""Structured Streaming: file sources, windowed counters, seen-sets and visitor verdicts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, schema: str = EVENTS, files: int = 8) -> DataFrame:
    """A stream over Parquet files that land in ``folder``; the checkpoint keeps which ones are done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def read_jsonl(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream over JSON lines; malformed lines keep their text in ``_bad``."""
    return spark.readStream.schema(schema + ", _bad string").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").json(folder)


def tumbling(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """window start, by, n and an HLL sketch of users; rows later than ``late`` behind the newest are dropped."""
    timed = events.withColumn("_t", F.col(at).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.window("_t", width).alias("w"), by).agg(F.count("*").alias("n"), F.hll_sketch_agg("user_id", 14).alias("users")).select(F.col("w.start").alias("start"), by, "n", F.hll_sketch_estimate("users").alias("users"))


def once(events: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark (a seen-set that is forgotten in time)."""
    return events.withColumn("_t", F.col(at).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark([key]).drop("_t")


VISITOR = "user_id bigint, n bigint, gaps bigint, mean_gap double, cv double, verdict string"
IDLE = 1800.0
#: Seconds of event time after which a visitor is forgotten.
FORGET = 30 * 86_400


def _merge(state: tuple, times: list[float]) -> tuple:
    n, gaps, total, squares, last = state
    for t in sorted(times):
        if last is not None and 0 < t - last < IDLE:
            gaps, total, squares = gaps + 1, total + (t - last), squares + (t - last) ** 2
        n, last = n + 1, t if last is None else max(last, t)
    return n, gaps, total, squares, last


def verdict(n: int, gaps: int, total: float, squares: float) -> tuple[float, float, str]:
    """mean gap, its coefficient of variation and what kind of visitor that makes."""
    mean = total / gaps if gaps else 0.0
    cv = (max(0.0, squares / gaps - mean * mean) ** 0.5 / mean) if gaps and mean else 0.0
    kind = "bot" if (gaps >= 5 and cv < 0.15) or (gaps >= 5 and mean < 2.0) or n > 120 else "person"
    return mean, cv, kind


def visitors(events: DataFrame, at: str, late: str = "1 day") -> DataFrame:
    """user_id, n, gaps, mean_gap, cv, verdict from state kept for each user (update mode).

    A user's state is dropped once the watermark has passed their last event by
    ``FORGET`` seconds; a later event begins anew.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept = state.get if state.exists else (0, 0, 0.0, 0.0, None)
        times = [x.timestamp() for b in batches for x in pd.to_datetime(b[at])]
        kept = _merge(tuple(kept), times)
        state.update(kept)
        state.setTimeoutTimestamp(max(int(kept[4] * 1000), state.getCurrentWatermarkMs()) + FORGET * 1000)
        yield pd.DataFrame([(key[0], kept[0], kept[1], *verdict(*kept[:4]))], columns=["user_id", "n", "gaps", "mean_gap", "cv", "verdict"])

    timed = events.select("user_id", at, F.col(at).cast("timestamp").alias("_t")).withWatermark("_t", late)
    return timed.groupBy("user_id").applyInPandasWithState(step, VISITOR, "n bigint, gaps bigint, total double, squares double, last double", "update", GroupStateTimeout.EventTimeTimeout)


def visitors_batch(events: DataFrame, at: str) -> DataFrame:
    """The same verdicts over a whole table, by a window instead of state."""
    from pyspark.sql.window import Window

    t = F.unix_micros(F.col(at).cast("timestamp")) / 1e6
    gap: Column = t - F.lag(t).over(Window.partitionBy("user_id").orderBy(at))
    g = events.withColumn("_g", gap).withColumn("_g", F.when((F.col("_g") > 0) & (F.col("_g") < IDLE), F.col("_g")))
    s = g.groupBy("user_id").agg(F.count("*").alias("n"), F.count("_g").alias("gaps"), F.avg("_g").alias("mean_gap"), (F.stddev_pop("_g") / F.avg("_g")).alias("cv"))
    bot = ((F.col("gaps") >= 5) & ((F.col("cv") < 0.15) | (F.col("mean_gap") < 2.0))) | (F.col("n") > 120)
    return s.select("user_id", "n", "gaps", F.coalesce("mean_gap", F.lit(0.0)).alias("mean_gap"), F.coalesce("cv", F.lit(0.0)).alias("cv"), F.when(bot, "bot").otherwise("person").alias("verdict"))


def run_available(stream: DataFrame, name: str, mode: str, folder: str) -> DataFrame:
    """Processes what is there into Parquet in ``folder``/``name``, beside its checkpoint, and returns what was written.

    Each batch has a folder of its own that a repeated batch replaces, so that
    it counts once. In complete mode the last batch is the result.
    """
    out = f"{folder}/{name}"

    def keep(rows: DataFrame, batch: int) -> None:
        path = out if mode == "complete" else f"{out}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)

    stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    reader = stream.sparkSession.read.schema(stream.schema)
    try:
        return reader.parquet(out).select(*stream.columns)
    except AnalysisException:  # nothing has come
        return stream.sparkSession.createDataFrame([], stream.schema)


def syslog(lines: DataFrame) -> DataFrame:
    """client, agent, client_class of datagrams ``client|agent|class``; the class may be missing, other lines are dropped."""
    parts = F.split("value", r"\|")
    return lines.where(F.size(parts) >= 2).select(parts[0].alias("client"), parts[1].alias("agent"), F.get(parts, F.lit(2)).alias("client_class"))
