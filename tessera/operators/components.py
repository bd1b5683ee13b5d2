"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations with a map-side minimum; a node with very many
links is one row of the aggregate, and the join back to its links is split by
adaptive execution. Rounds are cut by a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root for every id in ``links``; root is the smallest id of its component.

    Repeated links, links in either direction and links to itself make no
    difference; a null or blank end leaves the other end as a node of its own.
    No links give an empty result. Stops when a round changes nothing.
    """
    ends = links.select(F.nullif(F.trim(F.col(a)), F.lit("")).alias("u"), F.nullif(F.trim(F.col(b)), F.lit("")).alias("v"))
    ends = ends.select(F.coalesce("u", "v").alias("u"), F.coalesce("v", "u").alias("v")).where(F.col("u").isNotNull())
    nodes = materialize(ends.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    edges = materialize(ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not edges.isEmpty():
        # large star: hang every larger neighbour on the smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: hang a node's smaller neighbours, and itself, on the smallest of them
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        following = materialize(small, "edges")
        if following.count() == edges.count() and following.join(edges, ["u", "v"], "left_anti").isEmpty():
            edges = following
            break
        edges = following
    return nodes.join(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
