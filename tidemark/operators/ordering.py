"""Per-key event-time order that a hot key cannot pull into one task.

A table with more rows than a task should sort is dealt over ranges of (key, event time, arrival), as many
as its rows need, so no range holds much more than its share of the rows, whatever share one key or
one event time has. A row's position is its place in its range plus the sizes of the key's parts in
earlier ranges. There is no limit on the number of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.settings import stored

# Rows that a task may comfortably sort.
ROWS_PER_SLICE = 4_000_000


def with_position(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    arrival: str,
    out: str = "position",
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Add each row's place (from 1) in its key's event-time order; ties keep arrival order.

    ``arrival`` is an integer, unique inside a key. ``measure`` is a table with as many rows to count,
    where ``df`` itself is costly to run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    measure = df if measure is None else measure
    ranges = -(-measure.count() // rows_per_slice)
    if ranges <= 1:
        place = F.row_number().over(W.partitionBy(*keys).orderBy(time, arrival))
        return df.withColumn(out, place.cast("bigint"))
    # Written, so that a row's range is settled and the rows are run once.
    ranged = df.repartitionByRange(ranges, *keys, time, arrival).withColumn("_range", F.spark_partition_id())
    rows = stored(ranged, "ranges")
    # One row for each key in each range; only a key that goes on in the next range has more than one.
    sizes = rows.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    names = [f"_key_{i}" for i in range(len(keys))]
    before = sizes.withColumn("_earlier", F.sum("_size").over(earlier)).filter(F.col("_earlier").isNotNull())
    before = stored(before.select(F.col("_range").alias("_of"), *[F.col(k).alias(n) for k, n in zip(keys, names)],
                                  "_earlier"), "sizes")
    same = [F.col("_range") == F.col("_of"), *[F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]]
    inside = F.row_number().over(W.partitionBy("_range", *keys).orderBy(time, arrival))
    ranked = rows.withColumn("_inside", inside).join(before, same, "left")
    position = F.coalesce("_earlier", F.lit(0)) + F.col("_inside")
    return ranked.select(*df.columns, position.cast("bigint").alias(out))


def in_event_time_order(
    df: DataFrame, key: str | Sequence[str], time: str, arrival: str, partitions: int | None = None
) -> DataFrame:
    """Rows in each key's event-time order across and inside partitions.

    Partitions are ranges of (key, time, arrival), so a hot key spans several of them.
    """
    columns = [*([key] if isinstance(key, str) else key), time, arrival]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)
