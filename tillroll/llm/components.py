"""Connected components of an edge table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: longs); the component is its smallest node.

    Contraction: each node hooks on to its smallest neighbour if that is
    smaller, chains of hooks are halved until they are flat, and the edges are
    rewritten to the roots. A star is done in one round; every round at least
    halves the nodes that still have an edge. Each step is a written table, and
    a node with very many edges is counted map-side before it is shuffled."""
    edges = stage(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("up")), "cc-hooks")
        while True:
            far = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = stage(up.join(far, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "cc-jump")
            up = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        levels.append(up)
        to = lambda side: up.select(F.col("node").alias(side), F.col("up").alias(f"_{side}"))
        edges = stage(edges.join(to("a"), "a").join(to("b"), "b").filter("_a <> _b")
                      .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "cc-edges")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = levels[0].select("node", F.col("up").alias("component"))
    for level in levels[1:]:
        found = (found.join(level.select(F.col("node").alias("component"), "up"), "component", "left")
                 .select("node", F.coalesce("up", "component").alias("component")))
    return stage(found, "cc-components") if levels[1:] else found
