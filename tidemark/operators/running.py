"""Running totals over a long ordered table, without one task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.settings import stored

BLOCK = 65_536
# Rows that one task may run over as they are.
SMALL = 100_000

_MERGE = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
}
_FOLD = {"sum": F.sum, "max": F.max}


def running(
    df: DataFrame,
    order: str,
    value: Column,
    out: str,
    *,
    how: str,
    partition: Sequence[str] = (),
    inclusive: bool = True,
    block: int = BLOCK,
    rows_known: int | None = None,
) -> DataFrame:
    """Add ``out``: the running ``sum`` or ``max`` of ``value`` along the integer column ``order``.

    ``order`` is unique inside ``partition``; a null order comes first, and null partition values are
    a partition. Rows are cut by place, whatever their order values are, into ranges of about ``block``
    rows; each range is folded to one row per partition, only those are run over as a whole, and the
    result is added to the running value inside each range. With ``inclusive=False`` a row does not
    see its own value. Where the caller knows that the table has few rows, ``rows_known`` saves the
    ranges, with the same result.
    """
    fold, merge = _FOLD[how], _MERGE[how]
    if rows_known is not None and rows_known <= SMALL:
        end = W.currentRow if inclusive else -1
        whole = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, end)
        total = fold(value).over(whole)
        return df.withColumn(out, F.coalesce(total, F.lit(0)) if how == "sum" else total)
    count = rows_known if rows_known is not None else df.count()
    ranged = df.withColumn("_value", value).repartitionByRange(max(1, -(-count // block)), *partition, order)
    # Written, so that every later read finds the same rows in the same range.
    rows = stored(ranged.withColumn("_block", F.spark_partition_id()), "ranges")
    keys = [*partition, "_block"]
    end = W.currentRow if inclusive else -1
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, end)
    across = W.partitionBy(*partition) if partition else W.partitionBy()
    across = across.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys).agg(fold("_value").alias("_total"))
    blocks = blocks.select(*keys, fold("_total").over(across).alias("_before"))
    local = rows.withColumn("_inside", fold("_value").over(inside))
    renamed = blocks.toDF(*[f"_{k}_of" for k in keys], "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}_of")) for k in keys]
    joined = local.join(renamed, same)
    return joined.select(*df.columns, merge(F.col("_before"), F.col("_inside")).alias(out))
