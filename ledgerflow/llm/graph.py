"""Connected components of an edge table, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each component, for edges (a, b) of longs.

    Labels spread along the edges and are then replaced by their label's label
    (pointer jumping), until none changes. Every step is a join and a partial
    minimum, so a hub with many edges is never gathered in one group. Nodes are
    the ends of edges; rows with a null end count as no edge; no edges, no rows.
    """
    ends = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = materialize(ends.union(ends.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialize(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(both["a"].alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = materialize(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new")), "labels")
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("far"))
        step = materialize(
            step.join(jump, "new").select("node", (F.col("far") < F.col("label")).alias("moved"), F.col("far").alias("label")),
            "labels",
        )
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels
