"""Connected components of links too many for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: every node of ``links(a, b)`` with the smallest node it reaches.

    Each round takes the smallest label among the neighbours and then the label of the label, so chains halve. Every
    round is written to the shared folder; rounds end when no label changes.
    """
    pairs = links.select("a", "b").filter("a <> b")
    edges = stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(
        edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels"
    )
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stage(
            hooked.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label")), "labels"
        )
        done = new.filter("label <> old").isEmpty()
        labels = new.select("node", "label")
        if done:
            return labels
