"""One surviving record for each group of records of the same thing.

Fields are unpivoted to long rows. Each row votes for its normalised value with
its source's trust times a decay by age. A field's rule is a weight: the ballot
that it prefers weighs as much as a whole vote, every other one its share of
what all others together may weigh at most. The weights are summed for each value,
the greatest sum wins (``max_by``), and the winners are pivoted back. A field
without a rule is decided by trust and age alone. All steps aggregate partially,
so a large group is no large task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import components

#: Words that stand for no value.
NOTHING = ["", "none", "n/a", "-"]
#: Days after which a vote counts half.
HALF_LIFE = 365.0
#: Rank of a source that the trust table does not have.
UNTRUSTED = 1_000_000
#: field -> what ranks its values: longest, latest, most trusted and then latest, or None for the votes alone.
RULES = {"full_text": "longest", "title": "latest", "regeste": "latest", "judges": "trusted", "pdf_url": "trusted"}


def is_value(column: Column) -> Column:
    """False for null, blank and the words that stand for nothing, in any case."""
    return F.coalesce(~F.lower(F.trim(F.regexp_replace(column, r"[\s ]+", " "))).isin(*NOTHING), F.lit(False))


def groups(links: DataFrame, present: DataFrame) -> DataFrame:
    """group_id, decision_id: everything linked directly or indirectly, less ids absent from ``present``; named by its smallest id."""
    found = components(links, "canonical_decision_id", "member_decision_id").withColumnRenamed("node", "decision_id").join(present.select("decision_id").distinct(), "decision_id", "left_semi")
    return found.join(found.groupBy("root").agg(F.min("decision_id").alias("group_id")), "root").select("group_id", "decision_id")


def ballots(decisions: DataFrame, links: DataFrame, sources: DataFrame) -> DataFrame:
    """group_id, field_name, decision_id, value, first, second, vote: one row for each member's value of each field.

    ``first`` and ``second`` are what the field's rule ranks by, greater being
    better. full_text carries only its length and hash. A repeated decision_id
    counts once, with its first version.
    """
    light = decisions.select(
        "decision_id", "title", "regeste", "judges", "pdf_url", "source", "scraped_at",
        F.when(is_value(F.col("full_text")), F.length("full_text")).alias("size"), F.when(is_value(F.col("full_text")), F.md5("full_text")).alias("full_text"),
    )
    # every decision_id of the links, whatever component it is in, in one semi join; the first version is taken among those only
    linked = links.select(F.explode(F.array("canonical_decision_id", "member_decision_id")).alias("decision_id")).where(F.trim("decision_id") != "").distinct()
    rows = light.join(linked, "decision_id", "left_semi")
    earliest = rows.groupBy("decision_id").agg(F.min("scraped_at").alias("scraped_at"))
    at = rows.join(earliest.withColumnRenamed("scraped_at", "since"), "decision_id").where(F.col("scraped_at").eqNullSafe(F.col("since")))
    versions = at.groupBy("decision_id").agg(F.max("since").alias("scraped_at"), F.min("source").alias("source"), F.max("size").alias("size"), *[F.max(F.when(is_value(F.col(c)), F.col(c))).alias(c) for c in RULES])
    from tessera.session import materialize

    versions = materialize(versions, "versions")
    trust = sources.groupBy("source").agg(F.min("trust_rank").alias("trust_rank"))
    newest = versions.agg(F.max("scraped_at")).first()[0]
    members = groups(links, versions).join(versions, "decision_id").join(F.broadcast(trust), "source", "left").withColumn("trust_rank", F.coalesce("trust_rank", F.lit(UNTRUSTED)))
    seconds = F.coalesce(F.unix_seconds(F.col("scraped_at").cast("timestamp")), F.lit(-(1 << 40)))
    rank = {"longest": (F.col("size").cast("bigint"), F.lit(0).cast("bigint")), "latest": (seconds, F.lit(0).cast("bigint")), "trusted": (-F.col("trust_rank").cast("bigint"), seconds), None: (F.lit(None).cast("bigint"), F.lit(None).cast("bigint"))}
    long = members.select(
        "group_id", "decision_id", "scraped_at", "trust_rank",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value"), rank[r][0].alias("first"), rank[r][1].alias("second")) for f, r in RULES.items()])).alias("b"),
    )
    # days behind the newest record of all; one without a time is as old as can be
    age = F.coalesce(F.datediff(F.lit(newest).cast("timestamp_ntz"), F.col("scraped_at")), F.lit(10_000))
    vote = F.pow(F.lit(0.5), age / HALF_LIFE) / F.greatest("trust_rank", F.lit(1))
    return materialize(long.select("group_id", "b.field_name", "decision_id", "b.value", "b.first", "b.second", vote.alias("vote")).where(F.col("value").isNotNull()), "ballots")


def winners(votes: DataFrame) -> DataFrame:
    """group_id, field_name, decision_id, value, support: the survivor of each field and its share of the votes.

    The weights of equal values (case and blanks apart) are summed and the value
    with the greatest sum survives, in its best ballot's spelling. The ballot that
    the field's rule ranks first, ties going to the smallest decision_id, weighs 1;
    of the other n - 1 each weighs its vote, which is at most 1, over n, so that
    they never outweigh it together. Without a rule (``first`` is null) the votes
    are the weights. ``support`` is the share of the votes alone.
    """
    key = F.lower(F.trim(F.regexp_replace("value", r"\s+", " ")))
    order = F.struct((-F.col("first")).alias("a"), (-F.col("second")).alias("b"), F.col("decision_id").alias("c"))
    # one row for each group and field
    leads = votes.groupBy("group_id", "field_name").agg(F.min(order).alias("lead"), F.count("*").alias("n"))
    ruled = F.col("first").isNotNull()
    weight = F.when(ruled & (order == F.col("lead")), F.lit(1.0)).when(ruled, F.col("vote") / F.col("n")).otherwise(F.col("vote"))
    weighed = votes.join(leads, ["group_id", "field_name"]).withColumn("weight", weight)
    by_value = weighed.withColumn("key", key).groupBy("group_id", "field_name", "key").agg(F.min_by(F.struct("decision_id", "value"), order).alias("best"), F.sum("weight").alias("weights"), F.sum("vote").alias("votes"))
    # equal sums can only come where no rule holds; the greatest key goes first then
    tops = by_value.groupBy("group_id", "field_name").agg(F.max_by(F.struct("best", "votes"), F.struct("weights", "key")).alias("w"), F.sum("votes").alias("all_votes"))
    return tops.select("group_id", "field_name", F.col("w.best.decision_id").alias("decision_id"), F.col("w.best.value").alias("value"), (F.col("w.votes") / F.col("all_votes")).alias("support"))


def records(decisions: DataFrame, links: DataFrame, sources: DataFrame) -> DataFrame:
    """One record for each group: group_id, the surviving value of each field, and the decision it comes from."""
    won = winners(ballots(decisions, links, sources))
    wide = won.groupBy("group_id").pivot("field_name", list(RULES)).agg(F.first("value").alias("value"), F.first("decision_id").alias("from"))
    from tessera.operators.bloom import Bloom
    from tessera.session import materialize

    wide = materialize(wide, "survivors")
    # of all texts only the winners', but for the filter's few errors, travel to the join
    wanted = wide.select("full_text_from").where("full_text_from is not null")
    likely = Bloom(wanted, "full_text_from").might_hold(F.col("decision_id"))
    texts = decisions.select("decision_id", "full_text").where(likely).where(is_value(F.col("full_text"))).withColumnRenamed("decision_id", "full_text_from").join(wanted, "full_text_from", "left_semi").groupBy("full_text_from").agg(F.max("full_text").alias("full_text"))
    values = [c for f in RULES for c in (F.col("full_text") if f == "full_text" else F.col(f"{f}_value").alias(f), F.col(f"{f}_from"))]
    return wide.join(texts, "full_text_from", "left").select("group_id", *values)
