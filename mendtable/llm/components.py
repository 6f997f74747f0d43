"""Connected components of an edge table by alternating stars.

Every node is linked to the smallest of its neighbours, first the larger neighbours of each node, then
the smaller ones, until every component is a star around its smallest node; the number of rounds
grows with the logarithm of the longest path. Each round is a few shuffles of the edges and ends in
the shared folder. A node with very many neighbours is no group: the minimum is combined map-side and
joined back to the edges, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _linked(pairs: DataFrame, keep: str, with_self: bool) -> DataFrame:
    """Link the neighbours of each node u that satisfy ``keep`` to the smallest around u."""
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")), "least")
    links = pairs.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if with_self:
        links = links.unionByName(least.select("u", F.col("m").alias("v")))
    return links.filter("u <> v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Nodes and the smallest node of their component, for edges (u, v) between bigint nodes: u, root.
    The smallest node itself has no row."""
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_linked(both, "v > u", False), "large")
        now = stored(_linked(large, "v < u", True), "small")
        last, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return now.select("u", F.col("v").alias("root"))
