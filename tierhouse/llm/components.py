"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierhouse.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each end of the links (a, b): the smallest node that can be reached.

    Each round a node takes the smallest label among its neighbours and then
    that label's own label, so chains halve. Labels are written every round;
    only the number of changes reaches the driver. A node with very many links
    is pre-aggregated before the shuffle, and its join is one that Spark splits.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "component-edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "component-labels")
    while True:
        seen = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = written(
            labels.join(seen, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")),
            "component-step",
        )
        far = step.select(F.col("node").alias("component"), F.col("component").alias("far"))
        labels = written(
            step.join(far, "component", "left").select("node", "old", F.least("component", F.coalesce("far", "component")).alias("component")),
            "component-labels",
        )
        if labels.where("old <> component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
