"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.session import materialized


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for every node of the edges ``a, b`` (longs).

    Rounds of taking the smallest label among the neighbours and then the label's own label, so that the
    number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder;
    only counts reach the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialized(both.where("a <> b").distinct(), "edges")
    labels = materialized(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near")
        )
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = step.join(jump, "component", "left").select("node", "old", F.least("component", "further").alias("component"))
        step = materialized(step, "labels")
        labels = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return labels
