"""Connected components by distributed label propagation with pointer jumping; no edge reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import settled


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every end of the edges (a, b); both never null.

    Each round takes the smallest label among a node and its neighbours and then that label's own label, so that the rounds
    grow with the logarithm of a component's breadth.  Labels are written to the checkpoint folder after each round.
    """
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        step = settled(step.join(jump, "component", "left").select("id", "old", F.least("component", F.coalesce("further", "component")).alias("component")))
        labels = step.select("id", "component")
        if step.where(F.col("old") != F.col("component")).isEmpty():
            return labels
