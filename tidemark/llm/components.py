"""Connected components of a graph by alternating large-star and small-star steps.

Every step is an aggregation on node ids that combines on the map side, and a join in which both sides
are dealt for the join itself, so that Spark can split the partition of a node with very many links
(see ``dealt_join``). Lineage is cut by checkpoint() in each round; the
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, dealt_join


def _least(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the least id among itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns u and v. Returns node, component (the least id that it reaches).

    Nodes without a link, or linked to themselves only, are not in the result. Null ends are ignored.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    links = cut(links)
    before = None
    while True:
        # Large star: each node's larger neighbours link to the least of its neighbourhood.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = dealt_join(both, _least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        # Small star: each node's smaller neighbours, and itself, link to the least of them.
        low = links.groupBy("u").agg(F.min("v").alias("m"))
        links = dealt_join(links, low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u > v").distinct()
        links = cut(links)
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = seen
