"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally.llm.storage import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours on one side are tied to the least of the node and its neighbours.

    The least neighbour is an aggregate joined back, not a window, so that a node with very many links is combined on
    the map side and its rows can be split in the join.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    tied = both.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"), F.col("u").alias("centre"))
    if large:
        tied = tied.filter("u > centre")
    else:
        tied = tied.unionByName(least.select("u", F.col("least").alias("v"), F.col("u").alias("centre")))
    return tied.filter("u != v").select("u", "v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node that each linked node reaches. ``links`` has u, v (long), in any order, with repeats.

    The links of each round are stored in the shared folder. Rounds stop when a round changes nothing, which is read
    from one row of counts and sums; their number grows with the logarithm of the longest chain.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    current, seen = stored(ordered), None
    while True:
        # Links run from the larger to the smaller node, so the large star sees both directions, the small star one.
        current = stored(_star(_star(current, large=True), large=False))
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (state := tuple(row)) == seen or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def with_component(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` (node, ...) with root; a node without links is its own root."""
    found = components(links).withColumnRenamed("node", "linked")
    return nodes.join(found, nodes["node"] == found["linked"], "left").select(
        *nodes.columns, F.coalesce("root", "node").alias("root")
    )
