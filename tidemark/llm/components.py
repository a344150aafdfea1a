"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.settings import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (columns a, b); the label is the component's smallest node.

    A round takes the least label among a node and its neighbours, then the label's own label, and is
    written to the shared folder; rounds end when none changes. Stars end in two rounds, paths in about
    the logarithm of their length.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
        least = seen.groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(least, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = stored(
            step.join(jump, "next", "left").select(
                "node", F.least("next", F.coalesce("far", "next")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
