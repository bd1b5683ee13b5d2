"""Deduplication by exact keys, by content and across courts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import text as T


def keep_richest(df: DataFrame, key: Column, id_column: str, size: Column, donate: list[str]) -> DataFrame:
    """One row for each key: the one with the greatest ``size``, its empty ``donate`` fields filled from the next richest.

    Rows without a key stay. Ties go to the smallest id. Both the survivor and
    the donors come from aggregates, so a key with very many rows is not sorted
    in one task. ``df`` should carry the length of a text rather than the text,
    which the survivor's id fetches afterwards.
    """
    rows = df.withColumn("_key", key)
    order = F.struct((-F.coalesce(size, F.lit(0))).alias("a"), F.col(id_column).alias("b"))
    filled = [F.min_by(c, F.when(T.blank_to_null(F.col(c)).isNotNull(), order)).alias(f"_d_{c}") for c in donate]
    best = rows.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min_by(F.struct(*df.columns), order).alias("_b"), F.count("*").alias("n_rows"), *filled)
    merged = [F.coalesce(T.blank_to_null(F.col(f"_b.{c}")), F.col(f"_d_{c}")).alias(c) if c in donate else F.col(f"_b.{c}").alias(c) for c in df.columns]
    return best.select(*merged, "n_rows").unionByName(rows.where(F.col("_key").isNull()).select(*df.columns, F.lit(1).cast("bigint").alias("n_rows")))


def prefix_copies(df: DataFrame, group: list[str], id_column: str, text: str, least: int = 200) -> DataFrame:
    """id_column, kept: rows whose letters and digits are the beginning of their group's longest, and that one's id.

    Only lengths and hashes travel: the lengths that occur in a group go back to
    its longest signature, which is hashed at each of them.
    """
    from tessera.operators.bloom import Bloom
    from tessera.session import materialize

    sig = T.whole_signature(F.col(text))
    signed = df.select(*group, id_column, sig.alias("sig")).where(F.length("sig") >= least)
    light = signed.select(*group, id_column, F.length("sig").alias("size"), F.xxhash64("sig").alias("h")).distinct()
    heads = light.groupBy(*group).agg(F.min_by(F.struct(id_column, "size", "h"), F.struct(-F.col("size"), F.col(id_column))).alias("k"), F.collect_set("size").alias("sizes"), F.count("*").alias("n")).where("n > 1")
    # of the longest, whose row is found by its id, one hash for each length: at most as many as lengths of a signature
    asked = materialize(heads.select(*group, F.col(f"k.{id_column}").alias("kept"), F.col("k.h").alias("kept_h"), "sizes"), "longest")
    # but for the filter's few errors only the longest signatures go to the join
    hashed = signed.where(Bloom(asked, "kept").might_hold(F.col(id_column))).withColumnRenamed(id_column, "kept").withColumn("kept_h", F.xxhash64("sig"))
    begins = hashed.join(asked, [*group, "kept", "kept_h"]).select(*group, "kept", F.explode("sizes").alias("size"), "sig").select(*group, "kept", "size", F.expr("xxhash64(left(sig, size))").alias("h")).distinct()
    return light.join(begins, [*group, "size", "h"]).where(F.col(id_column) != F.col("kept")).select(id_column, "kept").distinct()


def collisions(df: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """keys, n: key values that several ids share."""
    return df.groupBy(*keys).agg(F.countDistinct(id_column).alias("n")).where("n > 1")


def upgrade(rows: DataFrame, id_column: str, priority: str, size: str, row: str, date: str, factor: float = 2.0, more: int = 1000) -> DataFrame:
    """One row for each (id, date): the first by ``priority``, with the text of a later one that is much longer.

    ``size`` is the length of each row's text and ``row`` names the row whose
    text is kept, so that no text travels. A second row of the same id with
    another date gets the id with a suffix ``_dYYYYMMDD``; the order is
    ``priority``, then the date.
    """
    length = F.coalesce(F.col(size), F.lit(-1))
    g = rows.groupBy(id_column, date).agg(F.min_by(F.struct(priority, size, row), F.struct(F.col(priority), -length, F.col(row))).alias("f"), F.min_by(F.struct(size, row), F.struct(-length, F.col(row))).alias("l"))
    longer = (F.col(f"l.{size}") > factor * F.col(f"f.{size}")) & (F.col(f"l.{size}") > F.col(f"f.{size}") + more) | F.col(f"f.{size}").isNull()
    kept = F.when(longer, F.col("l")).otherwise(F.struct(F.col(f"f.{size}"), F.col(f"f.{row}")))
    first = Window.partitionBy(id_column).orderBy(F.col(f"f.{priority}"), date)
    renamed = F.when(F.row_number().over(first) == 1, F.col(id_column)).otherwise(F.concat(F.col(id_column), F.lit("_d"), F.regexp_replace(F.coalesce(F.col(date), F.lit("")), "[^0-9]", "")))
    return g.withColumn("kept", kept).select(renamed.alias(id_column), date, F.col(f"kept.{size}").alias(size), F.col(f"kept.{row}").alias("text_from"), F.col(f"f.{priority}").alias(priority))


def representations(df: DataFrame, id_column: str, channels: dict[str, Column]) -> DataFrame:
    """member, canonical, methods: ids that share a value of any channel with a smaller id, each once.

    The channels' keys are exploded into one equi-grouping; a value that very
    many ids share is aggregated before it is joined. Null and empty values tie
    nothing. A member met by several canonical ids belongs to the smallest.
    """
    keys = F.array(*[F.struct(F.lit(n).alias("method"), e.alias("key")) for n, e in channels.items()])
    k = df.select(F.col(id_column).alias("member"), F.explode(keys).alias("k")).select("member", "k.method", "k.key").where(F.coalesce("key", F.lit("")) != "").distinct()
    heads = k.groupBy("method", "key").agg(F.min("member").alias("canonical"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = k.join(heads, ["method", "key"]).where("member <> canonical")
    return pairs.groupBy("member").agg(F.min("canonical").alias("canonical"), F.array_sort(F.collect_set("method")).alias("methods"))


def with_examples(groups: DataFrame, rows: DataFrame, keys: list[str], id_column: str, most: int) -> DataFrame:
    """``groups`` with ``ids``, the first ``most`` different ids of each, joined by commas.

    Every task keeps the first ``most`` of its own before a group comes together,
    so that a group of very many rows is no large task. Null keys are a group, too.
    """
    order = Window.partitionBy(*keys).orderBy(id_column)
    few = rows.select(*keys, id_column).where(F.col(id_column).isNotNull()).distinct().withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
    ids = few.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.array_join(F.array_sort(F.collect_list(id_column)), ",").alias("ids"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return groups.join(ids, same, "left").select(*groups.columns, "ids")
