"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postloom.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``.

    The component is its smallest node. Each round takes the smallest label of the
    neighbours (merged in the tasks, so a node with very many neighbours is one row per
    task) and then the label of the label, which halves long chains. Rounds are written to
    the shared folder; the driver sees the number of changed labels only. Nulls and loops
    are left out; no edges give no rows.
    """
    edges = edges.select("a", "b").filter("a <> b")
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "component-labels")
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), "component")
        lowest = both.join(of_neighbour, "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lowered = labels.join(lowest, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        lowered = materialise(lowered, "component-lowered")
        target = lowered.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = materialise(lowered.join(target, "component").select("node", "before", F.col("root").alias("component")), "component-labels")
        changed = jumped.filter("before <> component").count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
