"""The given tables seen as logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENTS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table for work that is heavy per row: one whose files make fewer splits than there are
    cores is shuffled by ``key`` first; a larger one is read as it is."""
    rows = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def events_log(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """``events`` as a stream: routed by user, positioned by event id, props as payload."""
    rows = spread_table(spark, folder, "events", "event_id") if spread else table(spark, folder, "events")
    return rows.select(
        F.pmod("user_id", F.lit(SEGMENTS)).cast("int").alias("segment"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("routing_key"),
        F.col("ts").alias("event_time"),
        F.col("props").alias("payload"),
        "event_type",
        "value",
    )


def jittered_log(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """``events`` arriving out of order: event time up to 99 hours before arrival.

    An epoch is an hour of arrival.
    """
    log = events_log(spark, folder, spread)
    hours = F.pmod(F.col("offset") * 37, F.lit(100)).cast("int")
    arrived = F.unix_date(F.col("event_time").cast("date")).cast("bigint") * 24 + F.hour("event_time")
    return log.withColumns(
        {
            "epoch": arrived,
            "event_time": F.col("event_time") - F.make_dt_interval(hours=hours),
        }
    )


def ten_days(hours: Column) -> Column:
    """Ten-day epochs of arrival, from hours since 1970."""
    return F.floor(hours / 240)


PRICE = "decimal(12,2)"
ORDER_ROW = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    f"o_totalprice {PRICE}, o_orderpriority string"
)
# Changes of one order come in this order; each phase has its own range of offsets.
PHASE = 1 << 40


def _order_phases(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is inserted; open ones get 10 dearer; those of low priority are deleted."""
    orders = spread_table(spark, folder, "orders", "o_orderkey")
    names = [part.split(" ")[0] for part in ORDER_ROW.split(", ")]
    price = F.col("o_totalprice").cast(PRICE)
    dearer = (price + 10).cast(PRICE)

    def image(amount):
        return F.struct(*[amount.alias(n) if n == "o_totalprice" else F.col(n) for n in names])

    is_open, is_low = F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "5-LOW"
    first, last = image(price), image(F.when(is_open, dearer).otherwise(price))
    nothing = F.when(F.lit(False), first)

    def phase(number, op, before, after):
        return F.struct(
            F.lit(number).alias("phase"), F.lit(op).alias("op"), before.alias("before"), after.alias("after")
        )

    phases = F.array(
        phase(0, "c", nothing, first),
        F.when(is_open, phase(1, "u", first, last)),
        F.when(is_low, phase(2, "d", last, nothing)),
    )
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86_400_000
    exploded = orders.select("o_orderkey", day.alias("day"), F.explode(phases).alias("p"))
    return exploded.filter(F.col("p").isNotNull()).select(
        (F.col("p.phase") * F.lit(PHASE) + F.col("o_orderkey")).alias("offset"),
        (F.col("day") + F.col("p.phase") * 1000).alias("ts_ms"),
        "p.op",
        "p.before",
        "p.after",
    )


def orders_debezium(spark: SparkSession, folder: str) -> DataFrame:
    """The history of ``orders`` as Debezium JSON events."""
    source = F.struct(
        F.lit("inventory").alias("db"), F.lit("orders").alias("table"), F.col("ts_ms").alias("ts_ms")
    )
    envelope = F.struct("before", "after", source.alias("source"), "op", "ts_ms")
    return _order_phases(spark, folder).select("offset", F.to_json(envelope).alias("payload"))


def orders_canal(spark: SparkSession, folder: str) -> DataFrame:
    """The history of ``orders`` as Canal JSON events."""
    kind = F.when(F.col("op") == "c", "INSERT").when(F.col("op") == "u", "UPDATE").otherwise("DELETE")
    changed = F.struct(F.col("before.o_totalprice").cast("string").alias("o_totalprice"))
    envelope = F.struct(
        F.array(F.coalesce("after", "before")).alias("data"),
        F.when(F.col("op") == "u", F.array(changed)).alias("old"),
        kind.alias("type"),
        F.lit("inventory").alias("database"),
        F.lit("orders").alias("table"),
        F.col("ts_ms").alias("ts"),
    )
    return _order_phases(spark, folder).select("offset", F.to_json(envelope).alias("payload"))
