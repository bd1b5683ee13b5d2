"""Joins that Spark's planner does not write by itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def or_join(left: DataFrame, right: DataFrame, left_keys: list[Column], right_key: Column, row_id: list[str]) -> DataFrame:
    """Inner join where any of ``left_keys`` equals ``right_key``.

    The keys are exploded, so that it stays an equi-join; a disjunction would
    become a nested loop. Pairs met through several keys come out once. Null
    keys meet nothing.
    """
    exploded = left.withColumn("_k", F.explode(F.array_distinct(F.array_compact(F.array(*left_keys)))))
    return exploded.join(right.withColumn("_k", right_key), "_k").drop("_k").dropDuplicates([*row_id])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, start: str, reach: int, order: list[str]) -> DataFrame:
    """For each left row the right row of the same ``by`` with the greatest ``start`` <= ``at`` within ``reach``.

    Right rows are cut into blocks of ``reach``; a left row looks at its own
    block and the one before, so the range becomes an equi-join and a hot ``by``
    is spread over its blocks. Ties go to the greatest ``order``. Left rows
    without a match are left out.
    """
    block = F.floor(F.col(start) / reach)
    r = right.withColumn("_b", block)
    tagged = left.withColumn("_row", F.monotonically_increasing_id())
    l = tagged.withColumn("_b", F.explode(F.array(F.floor(F.col(at) / reach), F.floor(F.col(at) / reach) - 1)))
    near = l.join(r, [*by, "_b"]).where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(start) + reach))
    extra = [c for c in right.columns if c not in by]
    best = near.groupBy("_row").agg(F.max_by(F.struct(*[F.col(c) for c in [*left.columns, *extra]]), F.struct(F.col(start), *[F.col(o) for o in order])).alias("_m"))
    return best.select("_m.*")


def nearest_before(events: DataFrame, shown: DataFrame, keys: list[str], event_time: str, shown_time: str, width: int = 86_400) -> DataFrame:
    """Credits each event to the nearest earlier row of ``shown`` with the same keys; events without one are left out.

    Both sides are cut into blocks of ``width`` seconds. The last row of each
    block is carried over to later ones, one row for each key and block; within
    its block an event looks back. No pairs are formed, and a hot key is spread
    over its blocks. What is shown at the event's own time is not earlier.
    """
    block = lambda t: F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / width)
    extra = [x for x in shown.columns if x not in keys]
    seen = shown.select(*keys, block(shown_time).alias("_b"), F.struct(F.col(shown_time).alias("_t"), *extra).alias("_s"))
    asked = events.select(*keys, block(event_time).alias("_b"), F.col(event_time).alias("_t"), F.struct(*events.columns).alias("_e"))
    nothing = lambda df, name: F.lit(None).cast(df.schema[name].dataType)
    lasts = seen.groupBy(*keys, "_b").agg(F.max("_s").alias("_l"))
    blocks = lasts.unionByName(asked.select(*keys, "_b").distinct().withColumn("_l", nothing(lasts, "_l"))).groupBy(*keys, "_b").agg(F.max("_l").alias("_l"))
    # a row for each block of a key
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("_c", F.max("_l").over(earlier)).select(*keys, "_b", "_c")
    both = asked.withColumn("_s", nothing(seen, "_s")).unionByName(seen.withColumn("_t", F.col("_s._t")).withColumn("_e", nothing(asked, "_e")))
    before = Window.partitionBy(*keys, "_b").orderBy("_t", F.col("_s").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("_n", F.last("_s", ignorenulls=True).over(before)).where(F.col("_e").isNotNull()).join(carried, [*keys, "_b"], "left")
    found = near.withColumn("_m", F.coalesce("_n", "_c")).where(F.col("_m").isNotNull())
    return found.select("_e.*", *[F.col(f"_m.{x}").alias(x) for x in extra])


def key_index(sources: list[DataFrame], key: str, value: str) -> DataFrame:
    """key -> value; earlier sources win, within a source the smallest value. Null and blank keys are left out."""
    ranked = [s.select(F.col(key).alias("key"), F.col(value).alias("value"), F.lit(n).alias("rank")) for n, s in enumerate(sources)]
    every = reduce(DataFrame.unionByName, ranked).where(F.col("key").isNotNull() & (F.col("key") != ""))
    return every.groupBy("key").agg(F.min(F.struct("rank", "value")).alias("m")).select("key", F.col("m.value").alias("value"), F.col("m.rank").alias("rank"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side ('a' or 'b') of the keys that only one of them has."""
    one, two = a.select(key).distinct(), b.select(key).distinct()
    return one.join(two, key, "left_anti").withColumn("side", F.lit("a")).unionByName(two.join(one, key, "left_anti").withColumn("side", F.lit("b")))


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """Join in which a hot key of ``big`` is spread over ``salts`` partitions; ``small`` is repeated as often."""
    l = big.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    r = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return l.join(r, [*keys, "_salt"], how).drop("_salt")
