"""Delivery audits: was every expected value delivered exactly once?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit(delivered: DataFrame, expected: DataFrame, value: str) -> DataFrame:
    """Rows ``value, copies, issue`` for each value that is not delivered exactly once.

    ``expected`` has each value once. Values are counted on the map side first, so copies of one
    value do not pile up in a task.
    """
    counts = delivered.groupBy(value).agg(F.count(F.lit(1)).alias("copies"))
    wanted = expected.select(value).withColumn("_wanted", F.lit(True))
    both = counts.join(wanted, value, "full")
    issue = (
        F.when(F.col("_wanted").isNull(), "extra")
        .when(F.col("copies").isNull(), "missing")
        .when(F.col("copies") > 1, "duplicate")
    )
    copies = F.coalesce("copies", F.lit(0))
    return both.select(value, copies.alias("copies"), issue.alias("issue")).filter("issue IS NOT NULL")


def audit_range(delivered: DataFrame, value: str, count: int, start: int = 1) -> DataFrame:
    """As :func:`audit`, against the integers from ``start``, ``count`` of them."""
    return audit(delivered, delivered.sparkSession.range(start, start + count).toDF(value), value)


def audit_summary(issues: DataFrame) -> DataFrame:
    """Rows ``issue, n_values, n_copies``."""
    return issues.groupBy("issue").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("copies").alias("n_copies")
    )


def uncommitted(batches: DataFrame, commits: DataFrame) -> DataFrame:
    """The batches that the commit log does not hold yet."""
    return batches.join(commits, ["query_id", "batch_id"], "left_anti")
