"""What a changelog means: retracting aggregates, the current table, append-only checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The row kinds of a changelog.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def sign(kind: str = "row_kind") -> Column:
    """+1 for rows that enter the table, -1 for rows that leave it."""
    return F.when(F.col(kind).isin(INSERT, UPDATE_AFTER), 1).otherwise(-1)


def retracting(changes: DataFrame, by: Sequence[str], *, rows: str | None = None,
               sums: dict[str, Column] | None = None,
               first: dict[str, Column] | None = None,
               order: Sequence[str] = ("offset", "sub_order")) -> DataFrame:
    """Group a changelog as the table it stands for; a group without rows disappears.

    ``sums`` are added and retracted, ``first`` are the values of the earliest change of the group,
    ``rows`` names a count of the rows left. Every aggregate folds before the shuffle.
    """
    s = sign()
    aggregates = [F.sum(s).alias("_rows")]
    aggregates += [F.sum(c * s).alias(n) for n, c in (sums or {}).items()]
    earliest = F.struct(*order)
    aggregates += [F.min_by(c, earliest).alias(n) for n, c in (first or {}).items()]
    grouped = changes.groupBy(*by).agg(*aggregates).filter(F.col("_rows") > 0)
    count = [F.col("_rows").alias(rows)] if rows else []
    return grouped.select(*by, *(first or {}), *(sums or {}), *count)


def current_table(changes: DataFrame, key: Sequence[str], columns: Sequence[str],
                  order: Sequence[str] = ("offset", "sub_order")) -> DataFrame:
    """The last image of each primary key; deleted keys are gone.

    ``max_by`` keeps one image per key on the map side, so a key with many changes is not hot.
    """
    image = F.struct("row_kind", *[c for c in columns if c not in key])
    latest = changes.groupBy(*key).agg(F.max_by(image, F.struct(*order)).alias("_last"))
    alive = latest.filter(F.col("_last.row_kind").isin(INSERT, UPDATE_AFTER))
    return alive.select(*[c if c in key else F.col("_last").getField(c).alias(c) for c in columns])


def append_only(rows: DataFrame, kind: str = "row_kind") -> DataFrame:
    """Pass inserts through; any other row kind fails the query."""
    found = F.coalesce(kind, F.lit("null"))
    refuse = F.raise_error(F.concat(F.lit("append-only sink was given a row of kind "), found))
    # A filter, so that the check stays where the column itself is not read any further.
    return rows.filter(F.when(F.col(kind) == INSERT, F.lit(True)).otherwise(refuse.cast("boolean")))


def split_append_only(rows: DataFrame, kind: str = "row_kind") -> DataFrame:
    """Add ``accepted``: whether an append-only sink takes the row."""
    return rows.withColumn("accepted", F.col(kind) == INSERT)
