"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.shared import cut, forget


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `edges`; the component is named by its least node.

    Each round links every node to the least node of its neighbourhood, so that a component becomes a star in a
    logarithmic number of rounds.  No neighbourhood is collected: the least neighbour comes from an aggregate, and
    one partial result per node and task is shuffled, so a hub of a third of all edges does no harm.  Rounds are cut
    in the shared folder.  Self-loops give a component of one node; null ends are ignored; no edges give no rows.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes = e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    e = cut(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        # large star: every larger neighbour of a node is linked to the least of its neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        # small star: the smaller neighbours of a node, and the node itself, are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = cut(linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
        same = small.exceptAll(e).isEmpty() and e.exceptAll(small).isEmpty()
        forget(e, large)
        e = small
        if same:
            break
    return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
