"""Event time as a number, and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session zones in which a zone-less time and a time name the same microsecond.
_UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch, increasing with time whatever the session time zone is."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC_NAMES:
            return F.unix_micros(value.cast("timestamp"))
        # Built from the fields: a cast to TIMESTAMP would fold an hour in zones with summer time.
        whole = F.unix_date(value.cast("date")).cast("bigint") * 86_400
        clock = F.hour(value) * 3_600 + F.minute(value) * 60
        second = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        return (whole + clock) * 1_000_000 + second
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    raise TypeError(f"{column} is {kind.simpleString()}, not an event time")


def tag_window(df: DataFrame, time: str, size: str) -> DataFrame:
    """Each row with the bounds of its tumbling window; rows stay where they are, no shuffle."""
    w = F.window(time, size)
    return df.withColumn("_window", w).select(
        *df.columns,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
    )


def tumbling(df: DataFrame, time: str, size: str, *keys: str, **aggregates: Column) -> DataFrame:
    """Aggregates per tumbling event-time window and ``keys``, with the bounds as columns."""
    grouped = df.groupBy(F.window(time, size), *keys)
    totals = grouped.agg(*[c.alias(name) for name, c in aggregates.items()])
    return totals.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        *aggregates,
    )


def watermarked(df: DataFrame, time: str, delay: str = "0 seconds") -> DataFrame:
    """Declare a bounded out-of-orderness watermark; zone-less times are taken in the session zone."""
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df.withWatermark(time, delay)
