"""Connected components of an edge table by min-label propagation with pointer jumping.

All state is tables; an iteration costs joins on node ids and one pass of partial minima, and ends in a
written table. Nothing of the graph comes to the driver but the number of changed labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is the smallest node reachable."""
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        # the smallest label among the neighbours
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        # and the label of the own label
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = labels.join(near, "node").join(jump, "component")
        least = F.least("component", "near", "root")
        new = settle(new.select("node", least.alias("component"), (least < F.col("component")).alias("changed")), "labels")
        discard(labels)
        labels = new.select("node", "component")
        if new.where("changed").limit(1).count() == 0:
            discard(both)
            return labels


def extend_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``labels`` and ``edges`` once the edges join components.

    Only edges between different components count, each pair of components once, so what is walked is small.
    """
    own = labels.select(F.col("node").alias("a"), F.col("component").alias("left"))
    other = labels.select(F.col("node").alias("b"), F.col("component").alias("right"))
    placed = settle(edges.join(own, "a", "left").join(other, "b", "left").select("a", "b", F.coalesce("left", "a").alias("left"), F.coalesce("right", "b").alias("right")), "placed")
    joined = connected_components(placed.select(F.col("left").alias("a"), F.col("right").alias("b")).where("a <> b").distinct())
    ends = placed.select(F.col("a").alias("node"), F.col("left").alias("component")).union(placed.select("b", "right"))
    every = labels.union(ends).groupBy("node").agg(F.min("component").alias("component"))
    found = joined.select(F.col("node").alias("component"), F.col("component").alias("found"))
    return settle(every.join(found, "component", "left").select("node", F.coalesce("found", "component").alias("component")), "labels")
