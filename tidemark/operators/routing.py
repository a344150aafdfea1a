"""Routing events to segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_column(df: DataFrame, field: str) -> Column:
    """A string column as routing key; other types and missing columns are refused."""
    if field not in df.columns:
        raise ValueError(f"routing key column {field!r} is missing; there are {df.columns}")
    kind = df.schema[field].dataType
    if not isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        raise ValueError(f"routing key column {field!r} is {kind.simpleString()}, not a string")
    return F.col(field)


def segment_of(key: Column, segments: int) -> Column:
    """The segment of a routing key: equal keys share one; events without a key are spread."""
    hashed = F.pmod(F.xxhash64(key), F.lit(segments)).cast("int")
    return F.when(key.isNull(), spread(segments)).otherwise(hashed)


def spread(segments: int) -> Column:
    """A segment for events without a key: round-robin inside each task, no shuffle."""
    return F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(segments)).cast("int")


def route(df: DataFrame, segments: int, key: str | Column | None = None) -> DataFrame:
    """Add ``routing_key`` and ``segment``.

    ``key`` is a string column by name, an expression over the event, or None for random routing.
    """
    if segments < 1:
        raise ValueError(f"a stream has at least one segment, not {segments}")
    if key is None:
        return df.withColumns({"routing_key": F.lit(None).cast("string"), "segment": spread(segments)})
    column = key_column(df, key) if isinstance(key, str) else key.cast("string")
    routed = df.withColumn("routing_key", column)
    return routed.withColumn("segment", segment_of(F.col("routing_key"), segments))
