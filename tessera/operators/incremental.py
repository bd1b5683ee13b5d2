"""Incremental, versioned and scheduled processing on batch tables."""

from __future__ import annotations

import json
import zlib
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def changes(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """key, state: new, changed or deleted, by comparing hashes; unchanged keys are left out."""
    a = old.select(key, F.col(digest).alias("_a"), F.lit(1).alias("_ia"))
    b = new.select(key, F.col(digest).alias("_b"), F.lit(1).alias("_ib"))
    state = F.when(F.col("_ia").isNull(), "new").when(F.col("_ib").isNull(), "deleted").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, key, "full").select(key, state.alias("state")).where(F.col("state").isNotNull())


def apply_changes(table: DataFrame, fresh: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """``table`` without the rows of changed and deleted keys, with ``fresh`` rows of new and changed ones."""
    gone = diff.where("state in ('changed', 'deleted')").select(key)
    come = diff.where("state in ('new', 'changed')").select(key)
    return table.join(gone, key, "left_anti").unionByName(fresh.join(come, key, "left_semi"))


def versions(df: DataFrame, key: str, observed: str, digest: str) -> DataFrame:
    """df with version_no and superseded_at: one row for each change of the hash (slowly changing dimension, type 2)."""
    w = Window.partitionBy(key).orderBy(observed)
    moved = df.withColumn("_p", F.lag(digest).over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col(digest))).drop("_p")
    return moved.withColumn("version_no", F.row_number().over(w)).withColumn("superseded_at", F.lead(observed).over(w))


def reverse_diff(current: str | None, older: str | None) -> bytes:
    """What turns the lines of ``current`` into those of ``older``, compressed."""
    a, b = (current or "").split("\n"), (older or "").split("\n")
    ops = [(i1, i2, b[j1:j2]) for tag, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if tag != "equal"]
    return zlib.compress(json.dumps([older is None, ops], ensure_ascii=False).encode())


def apply_diff(current: str | None, diff: bytes) -> str | None:
    """The older text."""
    none, ops = json.loads(zlib.decompress(diff))
    if none:
        return None
    lines = (current or "").split("\n")
    for i1, i2, new in reversed(ops):
        lines[i1:i2] = new
    return "\n".join(lines)


def reverse_diffs(df: DataFrame, current: str, older: str) -> Column:
    """A binary column of the diffs of two text columns."""

    @F.pandas_udf("binary")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([reverse_diff(x, y) for x, y in zip(a, b)])

    return run(F.col(current), F.col(older))


def due(ids: DataFrame, checked: DataFrame, key: str, at: str, as_of: str, days: int = 30) -> DataFrame:
    """key of the ids never checked, or not within ``days`` before ``as_of``."""
    last = checked.groupBy(key).agg(F.max(at).alias("_at"))
    return ids.select(key).distinct().join(last, key, "left").where(F.col("_at").isNull() | (F.datediff(F.lit(as_of).cast("date"), F.col("_at")) >= days)).select(key)


def reconcile(expected: DataFrame, held: DataFrame, queue: DataFrame, key: str) -> DataFrame:
    """key, state of the gap queue: open for expected keys that are not held, resolved once held, ignored for good."""
    e, h = expected.select(key).distinct().withColumn("_e", F.lit(1)), held.select(key).distinct().withColumn("_h", F.lit(1))
    q = queue.groupBy(key).agg(F.max(F.when(F.col("state") == "ignored", 1)).alias("_i"), F.lit(1).alias("_q"))
    rows = e.join(q, key, "full").join(h, key, "left")
    return rows.select(key, F.when(F.col("_i") == 1, "ignored").when(F.col("_h") == 1, F.when(F.col("_q") == 1, "resolved")).when(F.col("_e") == 1, "open").when(F.col("_q") == 1, "resolved").alias("state")).where(F.col("state").isNotNull())


def retry(queue: DataFrame, failed: DataFrame, key: str, at: str, delay_days: int = 7) -> DataFrame:
    """The queue with one more retry and a later next_retry_at for the failed keys."""
    f = failed.groupBy(key).agg(F.max(at).alias("_at"))
    return queue.join(f, key, "left").withColumn("retry_count", F.col("retry_count") + F.when(F.col("_at").isNotNull(), 1).otherwise(0)).withColumn("next_retry_at", F.coalesce(F.date_add("_at", delay_days), F.col("next_retry_at"))).drop("_at")


def retained(df: DataFrame, at: str, as_of: str, days: int) -> DataFrame:
    """Rows of the last ``days``."""
    return df.where(F.col(at) >= F.date_sub(F.lit(as_of).cast("date"), days))


def freshness(df: DataFrame, by: str, at: str, as_of: str) -> DataFrame:
    """by, seconds since its latest row."""
    return df.groupBy(by).agg(F.max(at).alias("_m")).select(by, F.timestamp_diff("SECOND", F.col("_m"), F.lit(as_of).cast("timestamp_ntz")).alias("seconds"))


def sessions(df: DataFrame, user: str, at: str, gap: str = "30 minutes") -> DataFrame:
    """user, start, n: visits split where more than ``gap`` passes."""
    return df.groupBy(user, F.session_window(F.col(at).cast("timestamp"), gap).alias("w")).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("start"), "n")


def rollup_rewrite(history: DataFrame, fresh: DataFrame, grain: str) -> DataFrame:
    """``history`` with the grains of ``fresh`` replaced; running it again changes nothing."""
    return history.join(fresh.select(grain).distinct(), grain, "left_anti").unionByName(fresh)


def churn(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, state of two states of a table (key, digest, place): added, removed, changed, moved (the same elsewhere) or same."""
    a, b = old.select(key, F.col("digest").alias("_a"), F.col("place").alias("_p"), F.lit(1).alias("_ia")), new.select(key, F.col("digest").alias("_b"), F.col("place").alias("_q"), F.lit(1).alias("_ib"))
    state = F.when(F.col("_ia").isNull(), "added").when(F.col("_ib").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed").when(~F.col("_p").eqNullSafe(F.col("_q")), "moved").otherwise("same")
    return a.join(b, key, "full").select(key, state.alias("state"))
