"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskstream.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node that has a link; a component is named by its smallest node.

    Every round, each node's links go to the smallest of its neighbours, once from larger nodes
    and once from smaller ones, until all of them point at the smallest node of their
    component. Rounds grow with the logarithm of the longest chain; a round is two
    aggregations, so that a node with very many links is combined before it is shuffled.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    while True:
        # large star: larger neighbours of a node are linked to the smallest of all its neighbours and itself
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: smaller neighbours of a node, and itself, are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = stored(small.where("u <> v").distinct(), "links")
        moved = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        edges = after
        if not moved:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
