"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.plans.saved import save


def _least(edges: DataFrame) -> DataFrame:
    """``node, component``: each node with the least label that it or a neighbour of its neighbour's label has."""
    ends = [edges.groupBy(x).agg(F.min(y).alias("m")).withColumnRenamed(x, "node") for x, y in (("a", "b"), ("b", "a"))]
    near = ends[0].union(ends[1]).groupBy("node").agg(F.min("m").alias("m")).select("node", F.least("node", "m").alias("component"))
    labels = save(near, "labels")
    further = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return save(labels.join(further, "component").select("node", F.col("further").alias("component")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of the undirected edges ``a, b``: the smallest node each can reach.

    Each round labels every node with the least one near it and draws the nodes of a label
    together, so edges vanish quickly. Minima are combined before they are shuffled, and joins of a
    node with very many edges can be split; rounds are cut by stored tables.
    """
    edges = save(edges.select("a", "b").distinct(), "edges")
    reached = None
    while True:
        labels = _least(edges)
        if reached is None:
            reached = labels
        else:
            step = labels.withColumnsRenamed({"component": "next", "node": "component"})
            reached = save(reached.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component")), "reached")
        left, right = (labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_label")) for x in ("a", "b"))
        drawn = edges.join(left, "a").join(right, "b").filter("a_label != b_label")
        edges = save(drawn.select(F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return reached
