"""Connected components by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def components(edges: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; ``label`` is the
    smallest node of its component.

    Each round a node takes the least label among its neighbours and itself,
    then the label of that label, so distances halve. Aggregates combine on
    the map side, so a node with very many neighbours is no hot spot. Rounds
    are written to the shared folder.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    both = shared.written(both, f"{name}-edges", f"{folder}/{name}")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label"))
    labels = shared.written(labels, f"{name}-0", f"{folder}/{name}")
    k = 0
    while True:
        k += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        step = step.join(jump, "label").select("node", "was", F.least("label", "jump").alias("label"))
        step = shared.written(step, f"{name}-{k}", f"{folder}/{name}")
        if step.where("label != was").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
