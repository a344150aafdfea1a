"""Replaying watermarks over a bounded log, and the late-data rule of event-time ordering.

An *epoch* is an integer column that grows with arrival: events of one epoch arrive while one
watermark is in force, and the watermark may advance between epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.running import running
from tidemark.settings import stored


def lower_bounds(log: DataFrame, epoch: str, time: str, segments: list | None = None) -> DataFrame:
    """Rows ``epoch, bound, in_force``: per epoch the lower bound after it, and the one during it.

    The bound is the least over segments of the newest event time each has delivered so far, and never falls: a
    segment that is silent in an epoch keeps the time it had. A segment counts from its first event with a time on; with
    ``segments`` given, there is no bound until all of them have delivered. ``in_force`` is the bound of the epochs before,
    null in the first. The log is folded to one row per epoch and segment in one pass and stored; the rest works on
    that table, which has epochs times segments rows.
    """
    return _lower_bounds(log, epoch, time, segments)[0]


def _lower_bounds(log: DataFrame, epoch: str, time: str, segments: list | None = None) -> tuple[DataFrame, int]:
    """As :func:`lower_bounds`, with the number of epochs."""
    times = log.select(epoch, "segment", F.col(time).alias("_time")).filter(F.col("_time").isNotNull())
    newest = times.groupBy(epoch, "segment").agg(F.max("_time").alias("_newest"))
    newest = stored(newest, "newest")
    # One row for each segment of a stream, null among them if there is one.
    known = segments or [r[0] for r in newest.select("segment").distinct().collect()]
    kind = newest.schema["segment"].dataType
    epochs = newest.select(epoch).distinct()
    dense = epochs.withColumn("segment", F.explode(F.lit(None).cast("array<string>") if not known else F.array(
        *[F.lit(s).cast(kind) for s in known])))
    same = (F.col(epoch) == F.col("_epoch")) & F.col("segment").eqNullSafe(F.col("_segment"))
    told = newest.withColumnsRenamed({epoch: "_epoch", "segment": "_segment"})
    dense = stored(dense.join(told, same, "left").select(epoch, "segment", "_newest"), "segments")
    count = dense.count()
    carried = running(dense, epoch, F.col("_newest"), "_known", how="max", partition=["segment"], rows_known=count)
    least = F.min("_known")
    if segments:
        least = F.when(F.count("_known") == len(segments), least)
    per_epoch = stored(carried.groupBy(epoch).agg(least.alias("_bound")), "epochs")
    count = count // max(1, len(known))
    grown = running(per_epoch, epoch, F.col("_bound"), "in_force", how="max", inclusive=False, rows_known=count)
    return grown.select(epoch, F.greatest("_bound", "in_force").alias("bound"), "in_force"), count


def advances(bounds: DataFrame, epoch: str) -> DataFrame:
    """Rows ``epoch, watermark``: only the epochs after which the watermark is strictly greater."""
    grew = F.col("in_force").isNull() | (F.col("bound") > F.col("in_force"))
    return bounds.filter(grew).select(epoch, F.col("bound").alias("watermark"))


def noted_marks(log: DataFrame, epoch: str, time: str, bounds: DataFrame | None = None) -> DataFrame:
    """Rows ``epoch, watermark, n_rows``: the watermarks a sink notes while it writes.

    A sink notes the watermark in force when it has grown since the last note and an event at or
    past it is written; later events of that epoch note nothing more.
    """
    bounds = lower_bounds(log, epoch, time) if bounds is None else bounds
    totals = log.groupBy(epoch).agg(F.max(time).alias("_newest"), F.count(F.lit(1)).alias("n_rows"))
    eligible = totals.join(bounds, epoch).filter(F.col("_newest") >= F.col("in_force"))
    eligible = stored(eligible, "marks")
    noted = running(
        eligible, epoch, F.col("in_force"), "_noted", how="max", inclusive=False, rows_known=eligible.count()
    )
    grew = F.col("_noted").isNull() | (F.col("in_force") > F.col("_noted"))
    return noted.filter(grew).select(epoch, F.col("in_force").alias("watermark"), "n_rows")


# Widths of the blocks that intervals are filed under grow by this power of two: fewer looks per
# row for a wider step, at the price of more intervals in a block.
LEVEL_STEP = 3


def _level(length: Column) -> Column:
    """The least multiple n of ``LEVEL_STEP`` with ``2**n >= length``, for lengths from 1."""
    exact = F.when(length > 1, F.length(F.bin(length - 1))).otherwise(0)
    return (F.ceil(exact / LEVEL_STEP) * LEVEL_STEP).cast("int")


def first_at_or_after(df: DataFrame, value: str, steps: DataFrame, out: str) -> DataFrame:
    """Add the ``label`` of the first step whose ``mark`` is at or above ``value``; null past the last.

    ``steps`` has integer columns ``label``, ``mark`` and ``previous``: the mark of the step before,
    null in the first; labels and marks are strictly ascending. Each step owns the interval from
    ``previous`` (excluded) to its own mark. An interval is filed under the one or two blocks it
    touches, a block being at least as wide as the interval. A row looks once for each width in
    use; intervals do not overlap, so it meets a bounded number of them per look, however densely
    the marks lie.
    """
    level = _level(F.col("mark") - F.col("previous"))
    edge = steps.agg(
        F.min("mark").alias("low"),
        F.max("mark").alias("high"),
        F.min("label").alias("label"),
        F.array_sort(F.collect_set(level)).alias("levels"),
    ).first()
    spans = steps.filter(F.col("previous").isNotNull()).withColumn("_level", level)
    if edge["low"] is None:
        return df.withColumn(out, F.lit(None).cast(steps.schema["label"].dataType))
    levels = edge["levels"]
    v = F.col(value)
    first = F.when(v <= edge["low"], F.lit(edge["label"]))
    if not levels:
        return df.withColumn(out, first)

    def block(column: Column, level: Column) -> Column:
        return F.call_function("shiftright", column, level.cast("int"))

    filed = spans.select(
        F.col("label").alias("_label"), F.col("previous").alias("_from"), F.col("mark").alias("_to"), "_level",
        F.explode(
            F.sequence(block(F.col("previous") + 1, F.col("_level")), block(F.col("mark"), F.col("_level")))
        ).alias("_block"),
    )
    inside = (v > edge["low"]) & (v <= edge["high"])
    looks = F.array(
        *[F.struct(F.lit(n).alias("level"), block(v, F.lit(n)).alias("block")) for n in levels]
    )
    rows = df.withColumn("_look", F.explode_outer(F.when(inside, looks)))
    met = (
        (F.col("_look.level") == F.col("_level"))
        & (F.col("_look.block") == F.col("_block"))
        & (v > F.col("_from"))
        & (v <= F.col("_to"))
    )
    # Inside the edges every value has exactly one interval, so unmet looks can go.
    found = rows.join(filed, met, "left").filter(F.col("_look").isNull() | F.col("_label").isNotNull())
    return found.select(*df.columns, F.coalesce(first, F.col("_label")).alias(out))


def replay(log: DataFrame, epoch: str, time: str) -> DataFrame:
    """The stored epoch table of a log: ``epoch, bound, in_force, turn``.

    A *turn* is a stretch of epochs under one watermark: the number of advances before the epoch.
    One row per epoch, so it is small beside the log; it is written once and its true size decides
    whether later joins broadcast it.
    """
    bounds, count = _lower_bounds(log, epoch, time)
    grew = F.col("in_force").isNull() | (F.col("bound") > F.col("in_force"))
    turns = running(
        bounds, epoch, grew.cast("bigint"), "turn", how="sum", inclusive=False, rows_known=count
    )
    return stored(turns, "turns")


def mark_late(
    log: DataFrame, key: str, epoch: str, time: str, *, epochs: DataFrame | None = None, out: str = "late"
) -> DataFrame:
    """Add whether event-time ordering drops the row: its time is not after the newest time
    already emitted for its key, which is laxer than comparing with the watermark.

    Rows without a time are never late, nor are rows ahead of the watermark in force, since nothing
    newer than it has been emitted: only rows behind it are judged. All timed rows tell when they fire; they are
    folded to the newest time per (key, turn) before they are shuffled, so a hot key costs no more than
    the number of turns.
    """
    epochs = replay(log, epoch, time) if epochs is None else epochs
    grew = F.col("in_force").isNull() | (F.col("bound") > F.col("in_force"))
    in_force = micros(epochs, "in_force")
    steps = epochs.filter(grew).select(
        (F.col("turn") + 1).alias("label"), micros(epochs, "bound").alias("mark"), in_force.alias("previous")
    )
    turns = epochs.select(epoch, F.col("turn").alias("_turn"), in_force.alias("_in_force"))
    rows = log.withColumn("_t", micros(log, time)).join(turns, epoch, "left")
    is_behind = F.coalesce(F.col("_t") <= F.col("_in_force"), F.lit(False))

    timed = rows.filter(F.col(time).isNotNull()).select(key, "_turn", "_t", is_behind.alias("_behind"))
    timed = first_at_or_after(timed, "_t", steps, "_reached")
    # An event fires when the watermark reaches its time, and never in the turn it arrives in.
    fires = F.when(F.col("_reached").isNotNull(), F.greatest(F.col("_turn") + 1, F.col("_reached")))
    asks = F.when(F.col("_behind"), F.col("_turn"))
    points = timed.select(
        key,
        F.explode(
            F.array(
                F.struct(asks.alias("turn"), F.lit(None).cast("bigint").alias("t")),
                F.struct(fires.alias("turn"), F.col("_t").alias("t")),
            )
        ).alias("_p"),
    )
    points = points.filter(F.col("_p.turn").isNotNull())
    points = points.groupBy(key, F.col("_p.turn").alias("_turn")).agg(F.max("_p.t").alias("_fired"))
    so_far = W.partitionBy(key).orderBy("_turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    emitted = points.select(key, "_turn", F.max("_fired").over(so_far).alias("_emitted"))

    ahead = rows.filter(~is_behind).select(*log.columns, F.lit(False).alias(out))
    emitted = emitted.withColumnsRenamed({key: "_key", "_turn": "_until"})
    met = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_turn") == F.col("_until"))
    judged = rows.filter(is_behind).join(emitted, met, "left")
    late = F.coalesce(F.col("_t") <= F.col("_emitted"), F.lit(False))
    return ahead.unionByName(judged.select(*log.columns, late.alias(out)))


def drop_late(log: DataFrame, key: str, epoch: str, time: str, *, epochs: DataFrame | None = None) -> DataFrame:
    """Only the rows that event-time ordering emits."""
    return mark_late(log, key, epoch, time, epochs=epochs, out="_late").filter(~F.col("_late")).drop("_late")
