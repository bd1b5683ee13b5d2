"""The citation graph: edges, targets with confidence, neighbours, chains and leading cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import text as T
from tessera.operators import joins as J


def edges(citations: DataFrame) -> DataFrame:
    """source, ref, mentions, prior: one edge for each source and reference."""
    return citations.groupBy(F.col("source_decision_id").alias("source"), F.col("target_ref").alias("ref")).agg(F.sum("mention_count").alias("mentions"), F.max("is_prior_instance").alias("prior"))


def resolve(graph: DataFrame, decisions: DataFrame, register: DataFrame, window: int = 30) -> DataFrame:
    """source, ref, target, method, confidence: what each reference may mean.

    Four passes, each over what the ones before left open: docket, the series
    with its prefix, the series without, and the last beginning within
    ``window`` pages before. Candidates of a reference are ranked newest first.
    """
    from tessera.session import materialize

    own = materialize(
        decisions.groupBy(F.col("decision_id").alias("id")).agg(F.min("court").alias("court"), F.min("canton").alias("canton"), F.max("decision_date").alias("date"), F.min("docket_number").alias("docket")).withColumn("key", T.graph_docket(F.col("docket"))).drop("docket"), "own"
    )
    pairs = materialize(graph.select("source", "ref").distinct(), "pairs")
    # a reference's spelling is resolved once, however many decisions cite it
    refs = materialize(pairs.select("ref").distinct().withColumn("key", T.graph_docket(F.col("ref"))), "refs")
    facts = F.struct("court", "canton", "date")
    by_docket = refs.join(own.select(F.col("id").alias("target"), facts.alias("t"), "key"), "key")
    hits = pairs.join(by_docket, "ref").where(F.col("target") != F.col("source")).join(own.select(F.col("id").alias("source"), facts.alias("s")), "source", "left")
    w = Window.partitionBy("source", "ref")
    hits = hits.withColumn("rank", F.row_number().over(w.orderBy(F.col("t.date").desc_nulls_last(), "target"))).withColumn("count", F.count("*").over(w))
    side = lambda a: {k: F.col(f"{a}.{k}") for k in ("court", "canton", "date")}
    docket = materialize(hits.select("source", "ref", "target", F.lit("docket_norm").alias("method"), T.citation_confidence(side("s"), side("t"), F.col("key"), F.col("rank"), F.col("count")).alias("confidence")), "docket")
    series = register.select("bge_reference", F.col("decision_id").alias("target"), "volume", "division", "first_page")
    told = lambda df, method, confidence: df.select("ref", "target", F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))
    prefixed = told(refs.join(series, F.regexp_replace(F.upper(F.trim("ref")), r"^(?:ATF|DTF) ", "BGE ") == F.col("bge_reference")), "bge_norm", 0.9)
    still = refs.join(docket.select("ref").union(prefixed.select("ref")).distinct(), "ref", "left_anti")
    bare = told(still.join(series, F.concat(F.lit("BGE "), F.col("ref")) == F.col("bge_reference")), "bge_bare", 0.85)
    still = still.join(bare.select("ref").distinct(), "ref", "left_anti")
    p = r"^(?:BGE|ATF|DTF)? ?(\d{1,3}) ([IVX]{1,4}) (\d{1,4})$"
    pages = still.where(F.col("ref").rlike(p)).select("ref", F.regexp_extract("ref", p, 1).cast("int").alias("volume"), F.regexp_extract("ref", p, 2).alias("division"), F.regexp_extract("ref", p, 3).cast("int").alias("page"))
    begun = J.asof_join(pages, series, ["volume", "division"], "page", "first_page", window, ["target"])
    by_ref = materialize(prefixed.unionByName(bare).unionByName(told(begun, "bge_pincite", 0.75)), "by_ref")
    found = docket.unionByName(pairs.join(by_ref, "ref").select(*docket.columns))
    return found.where(F.col("source") != F.col("target")).groupBy("source", "ref", "target").agg(F.max_by("method", "confidence").alias("method"), F.max("confidence").alias("confidence"))


def neighbours(resolved: DataFrame) -> DataFrame:
    """id, cites, cited_by."""
    out = resolved.groupBy(F.col("source").alias("id")).agg(F.countDistinct("target").alias("cites"))
    into = resolved.groupBy(F.col("target").alias("id")).agg(F.countDistinct("source").alias("cited_by"))
    return out.join(into, "id", "full").select("id", F.coalesce("cites", F.lit(0)).alias("cites"), F.coalesce("cited_by", F.lit(0)).alias("cited_by"))


def chains(links: DataFrame, starts: DataFrame, depth: int = 4) -> DataFrame:
    """start, hop, node: what is reached from each of ``starts`` (node) over at most ``depth`` links (source, target).

    Every hop is one join of the newly reached pairs; pairs reached before are
    left out, so cycles end.
    """
    from tessera.session import materialize

    step = materialize(links.select("source", "target").where("source <> target").distinct(), "links")
    begun = starts.select(F.col(starts.columns[0]).alias("source")).distinct()
    reached = step.join(begun, "source", "left_semi").select(F.col("source").alias("start"), F.col("target").alias("node"), F.lit(1).alias("hop"))
    front = reached
    for hop in range(2, depth + 1):
        further = front.join(step, F.col("node") == F.col("source")).select("start", F.col("target").alias("node")).where("start <> node").distinct()
        front = materialize(further.join(reached, ["start", "node"], "left_anti").withColumn("hop", F.lit(hop)), "front")
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached.select("start", "hop", "node")


def leading(resolved: DataFrame, topic: DataFrame, top: int = 20) -> DataFrame:
    """target, in_topic, in_all of the decisions most cited by those of ``topic`` (decision_id)."""
    unique = resolved.select("source", "target").distinct()
    inside = unique.join(topic.select(F.col("decision_id").alias("source")).distinct(), "source", "left_semi").groupBy("target").agg(F.count("*").alias("in_topic"))
    everywhere = unique.groupBy("target").agg(F.count("*").alias("in_all"))
    return inside.join(everywhere, "target").orderBy(F.col("in_topic").desc(), F.col("in_all").desc(), "target").limit(top)
