"""Aggregations beyond groupBy: bands, percentiles, sketches, Merkle roots, retrieval metrics, noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def mad_band(df: DataFrame, by: list[str], value: str, k: float = 5.0, least: int = 3, floor: float = 0.05) -> DataFrame:
    """by, middle, low, high: the median and the band of k median absolute deviations around it.

    Groups with under ``least`` values give no band; a band is at least
    ``floor`` of the median wide on either side.
    """
    middle = df.groupBy(*by).agg(F.median(value).alias("middle"), F.count(value).alias("_n"))
    spread = df.join(middle, by).groupBy(*by).agg(F.median(F.abs(F.col(value) - F.col("middle"))).alias("mad"), F.first("middle").alias("middle"), F.first("_n").alias("_n"))
    half = F.greatest(k * F.col("mad"), floor * F.abs(F.col("middle")))
    return spread.where(F.col("_n") >= least).select(*by, "middle", (F.col("middle") - half).alias("low"), (F.col("middle") + half).alias("high"))


def percentiles(df: DataFrame, by: list[str], value: str, shares: list[float], interpolate: bool, buckets: int = 64) -> DataFrame:
    """by and a column pNN for each share, exactly: of the n sorted values the one at ``min(floor(share * n), n - 1)``, or interpolated at ``share * (n - 1)``.

    Equal values are counted first. Approximate quantiles cut each group's
    values into ``buckets``; their counts tell in which bucket each wanted rank
    lies, and only those buckets are sorted, so that no task sorts a whole group.
    Null values and groups without any others are left out.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    cuts = counted.groupBy(*by).agg(F.percentile_approx("_v", [k / buckets for k in range(1, buckets)], 1000).alias("_cuts"), F.sum("_c").alias("_n"))
    placed = counted.join(cuts, by).withColumn("_b", F.size(F.filter("_cuts", lambda x: x < F.col("_v")))).drop("_cuts")
    # a row for each group and bucket
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*by, "_b").agg(F.sum("_c").alias("_size")).withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    n = F.col("_n")
    if interpolate:
        ranks = [r for p in shares for r in (F.floor(p * (n - 1)), F.ceil(p * (n - 1)))]
    else:
        ranks = [F.least(F.floor(p * n), n - 1) for p in shares]
    inside = lambda r: (F.col("_start") <= r) & (r < F.col("_start") + F.col("_size"))
    near = placed.join(starts, [*by, "_b"]).where(F.exists(F.array(*ranks), inside))
    upto = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranged = near.withColumn("_at", F.col("_start") + F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    held = lambda r: F.max(F.when((F.col("_at") <= r) & (r < F.col("_at") + F.col("_c")), F.col("_v")))
    wide = ranged.groupBy(*by, "_n").agg(*[held(r).alias(f"_{k}") for k, r in enumerate(ranks)])
    if not interpolate:
        return wide.select(*by, *[F.col(f"_{k}").alias(f"p{round(p * 100)}") for k, p in enumerate(shares)])
    part = lambda p: p * (n - 1) - F.floor(p * (n - 1))
    return wide.select(*by, *[(F.col(f"_{2 * k}") + part(p) * (F.col(f"_{2 * k + 1}") - F.col(f"_{2 * k}"))).alias(f"p{round(p * 100)}") for k, p in enumerate(shares)])


def positions(df: DataFrame, keys: list[str], name: str = "pos") -> DataFrame:
    """``df`` with the position of each row, from 0, in the order of ``keys``: sorted ranges and the ranges' offsets, so no task sees all rows."""
    from tessera.session import materialize

    sort = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = materialize(sort.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    sizes = ranged.groupBy("_part").agg(F.max("_in").alias("n")).withColumn("n", F.col("n") + 1)
    # a row for each range
    starts = sizes.withColumn("_start", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranged.join(F.broadcast(starts.select("_part", "_start")), "_part").withColumn(name, F.col("_start") + F.col("_in")).drop("_part", "_in", "_start")


def merkle_root(df: DataFrame, order: str, leaf: Column) -> DataFrame:
    """root, n: the root of the Merkle tree over the rows in the order of ``order``.

    Leaf hashes are SHA-256 of a zero byte and the leaf, nodes of a one byte and
    both children; a lone last node moves up unchanged, which gives the
    left-complete tree. Positions come from sorted ranges and the ranges'
    offsets, every level is one aggregation, so no task sees all leaves.
    """
    from tessera.session import materialize

    hashed = df.select(F.col(order).alias("k"), F.sha2(F.concat(F.lit(b"\x00"), leaf.cast("binary")), 256).alias("h"))
    level = positions(hashed, ["k"], "i").select("i", "h")
    n = left = df.count()
    while left > 1:
        both = level.groupBy(F.floor(F.col("i") / 2).alias("j")).agg(F.min(F.struct("i", "h")).alias("a"), F.max(F.struct("i", "h")).alias("b"))
        joined = F.sha2(F.concat(F.lit(b"\x01"), F.unhex("a.h"), F.unhex("b.h")), 256)
        level = both.select(F.col("j").alias("i"), F.when(F.col("a.i") == F.col("b.i"), F.col("a.h")).otherwise(joined).alias("h"))
        left = (left + 1) // 2
        if left > 1 and left.bit_length() % 6 == 0:
            level = materialize(level, "level")
    return level.select(F.col("h").alias("root"), F.lit(n).cast("bigint").alias("n"))


def retrieval_metrics(results: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    """query, mrr, recall, ndcg, hit1 of each query.

    results: query, doc, rank; relevant: query, doc, grade. Queries without a
    result have zeros; the gain uses true ranks.
    """
    found = results.where(F.col("rank") <= k).join(relevant, ["query", "doc"])
    per = found.groupBy("query").agg(F.min("rank").alias("first"), F.count("*").alias("n"), F.sum((F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    # grades are few: the best k by counts of each grade, not by sorting labels
    graded = relevant.groupBy("query", "grade").agg(F.count("*").alias("n"))
    ideal = graded.groupBy("query").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct("grade", F.least("n", F.lit(k)).alias("n"))), asc=False).alias("g"))
    sorted_best = F.slice(F.flatten(F.transform("g", lambda x: F.array_repeat(x["grade"], x["n"].cast("int")))), 1, k)
    best = F.aggregate(F.transform(sorted_best, lambda g, i: (F.pow(F.lit(2.0), g) - 1) / F.log2(i + 2.0)), F.lit(0.0), lambda s, x: s + x)
    j = ideal.join(per, "query", "left")
    z = lambda x: F.coalesce(x, F.lit(0.0))
    return j.select("query", z(1.0 / F.col("first")).alias("mrr"), z(F.col("n") / F.col("all")).alias("recall"), z(F.col("dcg") / best).alias("ndcg"), z((F.col("first") == 1).cast("double")).alias("hit1"))


def noisy_count(n: Column, seed: int, key: Column | None = None, epsilon: float = 1.0, least: int = 10) -> Column:
    """The count with Laplace noise of scale 1/epsilon, never negative; null below ``least``.

    The noise follows from ``key`` and ``seed``, so that a count asked for again
    has the same one, and asking often tells no more.
    """
    u = F.conv(F.substring(F.md5(F.concat((n if key is None else key).cast("string"), F.lit(f"#{seed}"))), 1, 8), 16, 10).cast("double") / float(1 << 32) - 0.5
    return F.when(n >= least, F.greatest(F.lit(0.0), F.bround(n + F.lit(1 / epsilon) * F.signum(u) * F.log(1 - 2 * F.abs(u)))).cast("bigint"))


def deltas(flushes: DataFrame, source: str, day: str, name: str, value: str, order: str) -> DataFrame:
    """Daily increments of counters that grow until their source restarts.

    The last flush of a (source, day, name) counts; it is compared with the
    same name on the source's previous present day, where an absent name is
    zero; never negative.
    """
    last = flushes.groupBy(source, day, name).agg(F.max_by(value, order).alias("v"))
    days = last.select(source, day).distinct().withColumn("_before", F.lag(day).over(Window.partitionBy(source).orderBy(day)))
    previous = last.select(source, F.col(day).alias("_before"), name, F.col("v").alias("_p"))
    return last.join(days, [source, day]).join(previous, [source, "_before", name], "left").select(source, day, name, F.greatest(F.lit(0), F.col("v") - F.coalesce("_p", F.lit(0))).alias("delta"))


def graded_scores(runs: DataFrame, labels: DataFrame, k: int = 10, relevant: int = 2) -> DataFrame:
    """query, mrr, recall, ndcg at ``k`` and true ranks; only grades of at least ``relevant`` count as found, all grades as gain.

    runs: query, doc, rank; labels: query, doc, grade. Queries without a hit have zeros.
    """
    gain = lambda grade, rank: (F.pow(F.lit(2.0), grade) - 1) / F.log2(rank + 1.0)
    found = runs.where(F.col("rank") <= k).join(labels, ["query", "doc"])
    good = F.col("grade") >= relevant
    per = found.groupBy("query").agg(F.max(F.when(good, 1.0 / F.col("rank"))).alias("rr"), F.count_if(good).alias("hits"), F.sum(gain(F.col("grade"), F.col("rank"))).alias("dcg"))
    by_grade = labels.groupBy("query", "grade").agg(F.count("*").alias("n"))
    # grades are few: the best k by counts of each grade, not by sorting labels
    ideal = by_grade.groupBy("query").agg(F.sum(F.when(good, F.col("n")).otherwise(0)).alias("n_rel"), F.sort_array(F.collect_list(F.struct("grade", F.least("n", F.lit(k)).alias("n"))), asc=False).alias("g"))
    best = F.slice(F.flatten(F.transform("g", lambda x: F.array_repeat(x["grade"], x["n"].cast("int")))), 1, k)
    total = F.aggregate(F.transform(best, lambda g, i: (F.pow(F.lit(2.0), g) - 1) / F.log2(i + 2.0)), F.lit(0.0), lambda a, b: a + b)
    j = ideal.join(per, "query", "left")
    z = lambda x: F.coalesce(x, F.lit(0.0))
    return j.select("query", z(F.col("rr")).alias("mrr"), z(F.col("hits") / F.least(F.greatest("n_rel", F.lit(1)), F.lit(k))).alias("recall"), (z(F.col("dcg")) / F.when(total > 0, total).otherwise(1.0)).alias("ndcg"))


def topological_order(needs: dict[str, list[str]]) -> list[str]:
    """Targets after what they need, ready ones by name; raises ValueError for a cycle or an unknown need."""
    import heapq

    unknown = {n for ns in needs.values() for n in ns} - set(needs)
    if unknown:
        raise ValueError(f"unknown targets: {sorted(unknown)}")
    left = {t: set(ns) for t, ns in needs.items()}
    ready = [t for t, ns in left.items() if not ns]
    heapq.heapify(ready)
    out: list[str] = []
    while ready:
        t = heapq.heappop(ready)
        out.append(t)
        for other, ns in left.items():
            if t in ns:
                ns.remove(t)
                if not ns:
                    heapq.heappush(ready, other)
    if len(out) < len(needs):
        raise ValueError(f"a cycle among {sorted(set(needs) - set(out))}")
    return out
