"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table of ``folder``; only ``columns`` are read if any are given."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def first_versions(decisions: DataFrame, *columns: str) -> DataFrame:
    """One row for each decision_id: the one with the earliest scraped_at.

    Rows that share the earliest scraped_at are merged: the greatest non-null
    value of each column wins, so that an emptier repetition adds nothing.
    Rows without decision_id are dropped. Aggregates partially before the
    shuffle; only ``columns`` travel.
    """
    value = F.struct(*[F.col(c) for c in columns])
    best = decisions.where(F.col("decision_id").isNotNull()).groupBy("decision_id").agg(
        F.min_by(value, F.struct(F.coalesce(F.col("scraped_at"), F.lit("9999-12-31").cast("timestamp")), *[F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) * -1 for c in columns])).alias("_v"),
        F.min("scraped_at").alias("scraped_at"),
    )
    return best.select("decision_id", *[F.col(f"_v.{c}").alias(c) for c in columns if c != "scraped_at"], "scraped_at")
