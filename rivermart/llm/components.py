"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b).

    Each round every node points to its smallest neighbour, the pointers are
    followed twice, and the links are rewritten between what is left, which at
    least halves the nodes that still have links. Only minima per node are
    shuffled together, so a node with very many links is no large task. Tables
    between rounds are written to the shared folder.
    """
    left = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = common.stored(left, "links")
    known = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        parent = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).withColumnRenamed("a", "node")
        for _ in range(2):
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("node", F.col("pp").alias("p"))
        parent = common.stored(parent, "parents")
        if known is None:
            known = parent.select("node", F.col("p").alias("component"))
        else:
            step = parent.select(F.col("node").alias("component"), "p")
            known = known.join(step, "component", "left").select(
                "node", F.coalesce("p", "component").alias("component"))
        known = common.stored(known, "components")
        a = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        b = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        left = left.join(a, "a").join(b, "b").where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        left = common.stored(left, "links")
    if known is None:
        known = left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return known
