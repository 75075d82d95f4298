"""Connected components by smallest labels, with jumps over labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.session import materialise


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round takes the smallest label among a node's neighbours and then the label of that label,
    so a star needs two rounds and a chain about the logarithm of its length. Rounds are written to
    the shared folder; only whether anything changed reaches the driver. Minima combine before the
    shuffle, so a node with very many edges does not gather them in one task.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = materialise(both.distinct(), "edges")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        of_label = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jumped = lower.join(of_label, F.col("label") == F.col("at"), "left")
        step = materialise(jumped.select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
