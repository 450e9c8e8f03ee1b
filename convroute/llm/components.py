"""Connected components of a graph given as a table of links, with every step a shuffle and no driver state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convroute.workspace import Workspace

#: Rounds double the distance that labels travel, so this is beyond any graph.
MOST_ROUNDS = 100


def smallest_reachable(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node that has a link.

    ``links`` has ``a`` and ``b``, in any order and with repeats.  Two steps take turns until nothing changes: every
    node points its larger neighbours, then its smaller ones, at the least of its neighbourhood.  Links never get
    more, and a hub's neighbours are combined before the shuffle: only the least is grouped, then joined back.
    Each round is stored, which cuts lineage and survives lost executors.
    """
    spark = links.sparkSession
    workspace = Workspace(spark, name)
    both = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high <> low")
    edges = workspace.save(both.distinct(), "links")
    before = None
    for number in range(MOST_ROUNDS):
        # Large step: each node's larger neighbours are tied to the least of the node and all its neighbours.
        around = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        around = around.toDF("node", "neighbour")
        least = around.groupBy("node").agg(F.least(F.min("neighbour"), F.first("node")).alias("least"))
        large = (
            around.where("neighbour > node")
            .join(least, "node")
            .select(F.col("neighbour").alias("high"), F.col("least").alias("low"))
            .where("high <> low")
            .distinct()
        )
        # Small step: each node and its smaller neighbours are tied to the least of them.
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        tied = large.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        small = tied.unionByName(least.select("high", F.col("least").alias("low"))).where("high <> low").distinct()
        edges = workspace.save(small, f"round-{number}")
        # Links that a whole round leaves as they are tie every node to the least of its component.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {MOST_ROUNDS} rounds")
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component")).distinct()
