"""References to records that do not exist.

A reference is reduced to a key in which case, blanks and separators make no
difference. A Bloom filter over the keys of all parents proves most orphans
without moving them; only references that may have a parent are checked
exactly, as distinct keys, so that a key that holds a third of all references
is one row of that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.bloom import Bloom

#: Words that announce a page, margin number, exhibit or paragraph.
PLACE_CUES = "cons consid considérant erw erwägung e rz rn ziff doc dok act akt p pp pag pagina page s seite n nr no ch cf fn note beilage pièce allegato annexe art § abs al cpv lit let bl".split()
#: Prefixes of the one published series and its divisions.
SERIES, DIVISIONS = "bge|atf|dtf", "iii|ii|iv|ia|ib|i|v"

_PLACE = r"^\W*(?:" + "|".join(PLACE_CUES) + r")\W*\d+[a-z]?(?:[.,-]\d{1,3})*\W*(?:ss|sgg|seg|segg|ff|f|s)?\W*$"
_SERIES = rf"^[\W_]*(?:(?:{SERIES})[\W_]*)?(\d{{1,3}})[\W_]*({DIVISIONS})[\W_]*(\d{{1,4}})[\W_]*$"


def reference_key(ref: Column) -> Column:
    """The key of a reference to a decision; null where ``ref`` names none.

    Null, blank and digit-free values, and pages, margin numbers, exhibits and
    paragraphs ('p. 786 ss', 'Rz. 12', 'cons. 4a') have no key.
    """
    low = F.lower(ref)
    series = F.concat(F.lit("bge"), F.regexp_extract(low, _SERIES, 1), F.regexp_extract(low, _SERIES, 2), F.regexp_extract(low, _SERIES, 3))
    plain = F.regexp_replace(low, r"[^\p{L}\p{N}]+", "")
    named = low.rlike(r"\d[^\d]+\d") | low.rlike(r"\d{6}")
    return F.when(ref.isNull() | low.rlike(_PLACE), None).when(low.rlike(_SERIES), series).when(named, plain)


def parents(decisions: DataFrame, register: DataFrame, removals: DataFrame) -> DataFrame:
    """key, held (1 if in the register, which is never late), since (earliest scraped_at in decisions), removed (1 if in removals): one row for each key."""
    d = decisions.select(F.explode(F.array("docket_number", "decision_id")).alias("ref"), F.lit(0).alias("held"), F.col("scraped_at").alias("since"), F.lit(0).alias("removed"))
    b = register.select(F.explode(F.array("bge_reference", "docket_number_2", "decision_id")).alias("ref"), F.lit(1).alias("held"), F.lit(None).cast("timestamp_ntz").alias("since"), F.lit(0).alias("removed"))
    v = removals.select(F.explode(F.array("docket_number", "decision_id")).alias("ref"), F.lit(0).alias("held"), F.lit(None).cast("timestamp_ntz").alias("since"), F.lit(1).alias("removed"))
    if dict(decisions.dtypes)["scraped_at"] != "timestamp_ntz":
        b, v = (x.withColumn("since", F.col("since").cast(dict(decisions.dtypes)["scraped_at"])) for x in (b, v))
    return d.unionByName(b).unionByName(v).select(reference_key(F.col("ref")).alias("key"), "held", "since", "removed").where(F.col("key").isNotNull()).groupBy("key").agg(F.max("held").alias("held"), F.min("since").alias("since"), F.max("removed").alias("removed"))


def orphans(references: DataFrame, decisions: DataFrame, register: DataFrame, removals: DataFrame) -> DataFrame:
    """The orphan references with their status: ``missing``, ``deleted`` or ``late``.

    ``references``: table_name, source_decision_id, target_ref, seen_at; other
    columns are left out. Repeated rows come out once. A null ``seen_at`` has a null month and is never late.
    """
    from tessera.session import materialize

    keyed = references.select("table_name", "source_decision_id", "target_ref", "seen_at").withColumn("key", reference_key(F.col("target_ref"))).where(F.col("key").isNotNull())
    known = materialize(parents(decisions, register, removals), "parents")
    bloom = Bloom(known.select("key"), "key")
    keyed = keyed.withColumn("maybe", bloom.might_hold(F.col("key")))
    surely = keyed.where(~F.col("maybe")).withColumn("status", F.lit("missing"))
    likely = keyed.where("maybe")
    # one row for each key, however many references share it; keys without any orphan end here
    keys = likely.groupBy("key").agg(F.min("seen_at").alias("first_seen"))
    state = (
        keys.join(known, "key", "left")
        .select("key", "since", F.when(F.col("held") == 1, "held").when(F.col("since").isNotNull(), F.when(F.col("first_seen") < F.col("since"), "late").otherwise("held")).when(F.col("removed") == 1, "deleted").otherwise("missing").alias("state"))
        .where("state <> 'held'")
    )
    state = materialize(state, "orphan_keys")
    # of the references that may have a parent only those under an orphan key, but for the filter's few errors, travel to the join
    under = likely.where(Bloom(state.select("key"), "key").might_hold(F.col("key")))
    checked = under.join(state, "key").withColumn("status", F.when(F.col("state") != "late", F.col("state")).when(F.col("seen_at") < F.col("since"), F.lit("late"))).where(F.col("status").isNotNull())
    columns = ["table_name", "source_decision_id", "target_ref", "seen_at", "status"]
    return surely.select(*columns).unionByName(checked.select(*columns)).select("table_name", "source_decision_id", "target_ref", F.date_format("seen_at", "yyyy-MM").alias("ref_month"), "status").distinct()


def citation_references(citations: DataFrame, gaps: DataFrame) -> DataFrame:
    """Both reference tables in the shape that ``orphans`` takes."""
    return citations.select(F.lit("decision_citations").alias("table_name"), F.coalesce("source_decision_id", F.lit("")).alias("source_decision_id"), "target_ref", F.col("extracted_at").alias("seen_at")).unionByName(
        gaps.select(F.lit("citation_gaps").alias("table_name"), F.lit("").alias("source_decision_id"), "target_ref", F.col("checked_at").alias("seen_at"))
    )


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphan references for each table, month and status, with their distinct targets."""
    return found.groupBy("table_name", "ref_month", "status").agg(F.count("*").alias("n_references"), F.countDistinct("target_ref").alias("n_targets"))
