"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.shared import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)``: the smallest node of each component, for all nodes
    of ``edges``.  Rounds of minimum-over-neighbours and pointer jumping, each
    written to the shared folder; a round is two joins, and the number of
    rounds grows with the logarithm of a component's diameter."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = materialise(both.union(both.select("v", "u")).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.u).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("n"), F.col("label").alias("further"))
        new = materialise(step.join(jump, step.label == jump.n, "left")
                          .select("node", F.least("label", "further").alias("label"), "old"), "labels")
        labels = new.select("node", "label")
        if new.filter("label <> old").isEmpty():
            return labels
