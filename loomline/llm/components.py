"""Connected components of an edge table, by contraction towards the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.shared import written


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges (a, b); component is the smallest id reached.

    Each round maps a vertex to its smallest neighbour's smallest neighbour and keeps the
    edges whose ends still differ, so a path of n edges needs about log n rounds and a
    star two. Rounds go through written tables; nothing is gathered but a row count.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "cc-edges")
    labels = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        parent = written(ends.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("p")), "cc-parents")
        up = parent.select(F.col("v").alias("w"), F.col("p").alias("q"))
        parent = written(parent.join(up, F.col("p") == F.col("w")).select("v", F.col("q").alias("p")), "cc-parents")
        labels = written(labels.join(parent, F.col("component") == F.col("v"), "left").select("id", F.coalesce("p", "component").alias("component")), "cc-labels")
        left = parent.select(F.col("v").alias("va"), F.col("p").alias("pa"))
        right = parent.select(F.col("v").alias("vb"), F.col("p").alias("pb"))
        moved = edges.join(left, F.col("a") == F.col("va")).join(right, F.col("b") == F.col("vb")).filter("pa <> pb")
        edges = written(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
    return labels
