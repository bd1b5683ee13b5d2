"""Mixing sources to target weights by Pfair scheduling.

A source with weight w has its k-th quantum released at slot k/w and due at slot
(k+1)/w; earliest-deadline-first over the released quanta fills the slots, and no
source is ever a whole quantum away from its share. A document is placed whole,
in the quantum that holds its middle, so that it puts its source ahead or back by
half its length at most. A block is eight quanta and no shorter than the longest
document, so the mixture itself stays within 1/8 + 1/2 of a block of the target,
at the end of every slot, for every source that has not run out.

The weights are exact fractions. The schedule repeats with their common
denominator; one period, or what the mixture needs of it, is worked out on the
driver, whatever the number of documents.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import ceil, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Least tokens of a block, quanta of a block, longest exact period in slots, buckets that a source's documents are spread over.
BLOCK, QUANTA, PERIOD, SPREAD = 8192, 8, 1_000_000, 4096


def schedule(weights: dict[str, int], slots: int | None = None) -> list[str | None]:
    """The source of each slot of one period, or of its first ``slots``; ``weights`` in slots of a period of ``sum`` slots.

    Of the released quanta the one due first goes next; ties go to the source
    name. The weights' sum is the length of the period, so every slot is filled.
    """
    period = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(weights) if weights[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: list[str | None] = []
    for slot in range(period if slots is None else min(slots, period)):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (ceil((k + 1) * period / weights[s]), s, k))
        if not ready:
            out.append(None)
            continue
        _, s, k = heapq.heappop(ready)
        out.append(s)
        if k + 1 < weights[s]:
            heapq.heappush(waiting, ((k + 1) * period // weights[s], s, k + 1))
    return out


def whole_weights(shares: dict[str, float], longest: int = PERIOD) -> dict[str, int]:
    """The shares as whole numbers of slots of one period.

    Exact where the common denominator of the shares, as they are written, leaves
    a period of at most ``longest`` slots. Otherwise a period of ``longest``
    slots, in which each source has its share to within one slot and one at least.
    """
    exact = {s: Fraction(str(w)) for s, w in shares.items() if w > 0}
    if not exact:
        return {}
    common = lcm(*[f.denominator for f in exact.values()])
    whole = {s: int(f * common) for s, f in exact.items()}
    if sum(whole.values()) <= longest:
        return whole
    total = sum(exact.values())
    return {s: max(1, round(f / total * longest)) for s, f in exact.items()}


def mixture(documents: DataFrame, sources: DataFrame, block: int = BLOCK, total: int | None = None) -> DataFrame:
    """doc_id, copy, source, n_tokens, slot, position, source_short: the mixture, to be read in the order of slot and position.

    ``documents``: doc_id, source, n_tokens. ``total`` is the wanted size, by
    default what the sources with a target hold once. A source is repeated, in
    another order each time, until it has its share or every document of it has
    come ``max_repeats`` times; one that falls short (``source_short``) leaves its
    slots empty. Documents without tokens, without a source or of one without a
    target share are left out.
    """
    spark = documents.sparkSession
    from tessera.session import materialize

    aims = {r["source"]: (r["target_share"], r["max_repeats"]) for r in sources.where("target_share > 0 and source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")).collect()}
    wanted = spark.createDataFrame([(s, int(r)) for s, (_, r) in aims.items()], "source string, max_repeats int")
    docs = documents.where("n_tokens > 0").join(F.broadcast(wanted.select("source")), "source").select("doc_id", "source", "n_tokens", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).alias("bucket"))
    docs = materialize(docs, "sized")
    # sums of (source, bucket): bounded by the number of sources, not by the documents
    bucket_sums = docs.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(bucket_sums.withColumn("bucket_start", F.coalesce(F.sum("tokens").over(order), F.lit(0))), "starts")
    # a repetition begins at another bucket, which is where a document begins
    turn = lambda n: F.coalesce(F.min(F.when(F.col("bucket") >= n * SPREAD // 3, F.col("bucket_start"))), F.lit(0))
    found = starts.groupBy("source").agg(F.sum("tokens").alias("held"), turn(1).alias("one"), turn(2).alias("two")).collect()
    held = {r["source"]: int(r["held"]) for r in found}
    turns = {r["source"]: [0, int(r["one"]), int(r["two"])] for r in found}
    longest = docs.agg(F.max("n_tokens")).first()[0] or 1
    quantum = -(-max(block, longest) // QUANTA)
    size = sum(held.values()) if total is None else total
    weights = whole_weights({s: w for s, (w, _) in aims.items()})
    period = sum(weights.values()) or 1
    share = {s: -(-size * weights[s] // period) for s in weights}
    # every quantum is placed by its deadline
    needed = max((-(-(-(-share[s] // quantum) * period) // weights[s]) for s in weights), default=0)
    timetable: dict[str, list[int]] = {s: [] for s in weights}
    for slot, s in enumerate(schedule(weights, needed)):
        if s is not None:
            timetable[s].append(slot)
    plan = spark.createDataFrame(
        [(s, k, slot) for s, own in timetable.items() for k, slot in enumerate(own)], "source string, k int, place int"
    )
    quotas = spark.createDataFrame(
        [(s, int(min(share[s], held[s] * aims[s][1])), held[s], turns[s], aims[s][1], weights[s], share[s] > held[s] * aims[s][1]) for s in weights if held.get(s)],
        "source string, quota bigint, held bigint, turns array<bigint>, repeats int, per_period int, source_short boolean",
    )
    within = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(F.broadcast(starts.drop("tokens")), ["source", "bucket"]).join(F.broadcast(quotas), "source")
    # copy c of a document lies at c * held + its place in the order that this copy begins with
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1))).withColumn("turned", F.pmod(F.col("bucket_start") + F.col("before") - F.col("turns")[F.col("copy") % 3], F.col("held")))
    middle = F.col("copy") * F.col("held") + F.col("turned") + F.floor(F.col("n_tokens") / 2)
    taken = copies.withColumn("middle", middle).where("middle < quota").withColumn("quantum", F.floor(F.col("middle") / quantum))
    timed = taken.withColumn("k", F.pmod("quantum", F.col("per_period")).cast("int")).join(F.broadcast(plan), ["source", "k"])
    slot = F.floor(F.col("quantum") / F.col("per_period")) * period + F.col("place")
    return timed.select("doc_id", "copy", "source", "n_tokens", slot.alias("slot"), F.pmod("middle", F.lit(quantum)).cast("int").alias("position"), "source_short")


def shares(mixed: DataFrame, sources: DataFrame) -> DataFrame:
    """source, target_share, n_documents, n_tokens, actual_share, short: one row for each source, also those that give nothing.

    ``short`` are sources that have used all their repeats before they had their
    share, and those with a target but without documents.
    """
    by = mixed.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.max("source_short").alias("ran_out"))
    joined = sources.select("source", "target_share").join(by, "source", "left").withColumn("n_documents", F.coalesce("n_documents", F.lit(0))).withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
    # a window over one row for each source
    share = F.coalesce(F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy(F.lit(1))), F.lit(0.0))
    short = F.coalesce("ran_out", F.col("target_share") > 0, F.lit(False))
    return joined.select("source", "target_share", "n_documents", "n_tokens", F.round(share, 4).alias("actual_share"), short.alias("short"))
