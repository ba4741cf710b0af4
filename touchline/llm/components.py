"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise


def _least(pairs: DataFrame) -> DataFrame:
    """Every pair (u, v) with the least of u and all its v; the minimum is combined early, and the
    join back has one row per node on one side, so a node with very many links can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").withColumn("least", F.least("u", "least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (columns a, b).

    Nodes are those of the edges. Every round links neighbours to the smallest node seen, which
    takes a number of rounds that grows with the logarithm of the longest path. Each round is
    written to the shared folder, so no executor holds the only copy.
    """
    pairs = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "links")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least(both).where("v > u").select(F.col("v").alias("u"),
                                                     F.col("least").alias("v"))
                 .where("u <> v").distinct())
        small = _least(large)
        pairs = materialise(
            small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(small.select("u", F.col("least").alias("v")))
            .where("u <> v").distinct(), "links")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    found = pairs.groupBy("u").agg(F.min("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return (found.select(F.col("u").alias("node"), "component")
            .unionByName(roots.join(found, roots.node == found.u, "left_anti")
                         .select("node", F.col("node").alias("component"))))
