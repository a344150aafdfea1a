"""Event-time ordering of a stream, per key.

Two forms. :func:`hold_until_watermark` is a plain stateful aggregation: rows wait, keyed by (key,
event time), until Spark's watermark passes them. Spark drops whatever arrives at or below its
watermark, which is stricter than the ordering rule. :class:`EventTimeOrdering` keeps the rule to
the letter - a row is late only when its time is not after the newest time *already emitted for its
key* - by running each micro-batch against state tables.

Rows released together are put in order by the sink, which splits them by ranges of event time, so
no key has to fit in a task.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros, watermarked
from tidemark.settings import shared_folder
from tidemark.sources.files import Files
from tidemark.streaming.sinks import EXACTLY_ONCE, StreamSink


def hold_until_watermark(stream: DataFrame, key: str, time: str, arrival: str, delay: str = "0 seconds",
                         rows_per_entry: int = 1024) -> DataFrame:
    """Release each row once the watermark has passed its event time.

    ``arrival`` is an integer, unique inside a key. State is keyed by key, time and a stretch of
    arrival numbers, so an entry holds at most ``rows_per_entry`` rows however hot a key or a moment
    is. Rows released in one micro-batch are unordered: give the sink ``order=[time, arrival]``.
    Micro-batches follow each other in event time. Rows without a time have nothing to wait for and pass
    at once.
    """
    timeless = stream.filter(F.col(time).isNull())
    rows = watermarked(stream, time, delay)
    stretch = F.floor(F.col(arrival) / rows_per_entry).alias("_stretch")
    rest = [c for c in rows.columns if c not in (key, time)]
    held = rows.groupBy(key, time, stretch).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    released = held.select(key, time, F.explode("_rows").alias("_row"))
    released = released.select(*[c if c in (key, time) else F.col("_row").getField(c).alias(c) for c in rows.columns])
    return released.unionByName(timeless.select(*rows.columns))


@dataclass
class EventTimeOrdering:
    """Use :meth:`write` with ``foreachBatch``; ``sink`` gets the rows that ordering emits.

    The watermark after a micro-batch is the least over ``segment`` of the newest time that each has delivered
    so far, and never falls: a silent segment holds it. ``state`` is a folder of the shared file system: per micro-batch the rows
    still held and the newest time emitted per key it changed. Every ``snapshot_every`` batches the
    latter are folded into one table.
    """

    sink: StreamSink
    state: str
    key: str
    time: str
    segment: str = "segment"
    snapshot_every: int = 20
    files: Files = field(init=False)

    def __post_init__(self):
        if self.sink.guarantee != EXACTLY_ONCE:
            raise ValueError("event-time ordering needs an exactly-once sink")
        if not self.sink.order or self.sink.order[0] != self.time:
            raise ValueError(f"the sink has to order by {self.time!r} first")
        self.spark = self.sink.table.spark
        self.files = Files(self.spark, self.state)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch: judge its rows, advance the watermark, emit what it has reached."""
        finished = self._finished()
        if finished is not None and batch_id > finished:
            raise ValueError(f"ordering was finished after batch {finished}: batch {batch_id} was not written")
        before = self._latest()
        if before is None or before < batch_id:
            folder = shared_folder(self.spark, "micro-batch")
            rows.write.parquet(folder)
            self._step(self.spark.read.schema(rows.schema).parquet(folder), batch_id)
            self.files.remove(folder)

    def finish(self) -> None:
        """Emit everything still held, as the end of a bounded input does.

        That is final: a micro-batch that comes later is refused. The emission has a state of its own
        beside the batches', and a name of its own in the sink.
        """
        batch = self._latest()
        if batch is not None and self._finished() is None:
            held = self._held(batch)
            self.sink.write(held.drop("_t"), -1 - batch)
            self.files.create(f"{self.state}.finished.json", json.dumps({"batch": batch}))

    def _finished(self) -> int | None:
        """The last batch before ``finish``."""
        name = f"{self.state}.finished.json"
        return json.loads(self.files.read(name))["batch"] if self.files.exists(name) else None

    # -- state -----------------------------------------------------------------------------

    def _folder(self, batch_id: int) -> str:
        return f"{self.state}/{batch_id:010d}"

    def _latest(self) -> int | None:
        """The newest batch whose state is complete."""
        for name in reversed(self.files.names(self.state)):
            if self.files.exists(f"{self.state}/{name}/done.json"):
                return int(name)
        return None

    def _note(self, batch_id: int) -> dict:
        return json.loads(self.files.read(f"{self._folder(batch_id)}/done.json"))

    def _held(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder(batch_id)}/rows").filter(~F.col("_fires")).drop("_fires")

    def _emitted(self, note: dict, batch_id: int) -> DataFrame:
        """Rows ``key, _emitted``, not yet folded: newest times emitted per key, up to a batch."""
        known = range(note["snapshot"], batch_id + 1)
        return self.spark.read.parquet(*[f"{self._folder(b)}/emitted" for b in known])

    def _newest(self, emitted: DataFrame) -> DataFrame:
        return emitted.groupBy(self.key).agg(F.max("_emitted").alias("_emitted"))

    def _timely(self, behind: DataFrame, emitted: DataFrame) -> DataFrame:
        """The rows behind the watermark that are newer than what their key has emitted.

        Few rows are behind, so their keys cut the emitted times down before those are folded.
        """
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        asked = emitted.join(behind.select(F.col(self.key).alias("_key")).distinct(), same, "left_semi")
        newest = self._newest(asked).withColumnRenamed(self.key, "_key")
        judged = behind.join(newest, same, "left")
        fresh = F.col("_emitted").isNull() | (F.col("_t") > F.col("_emitted"))
        return judged.filter(fresh).select(*behind.columns)

    # -- one batch -------------------------------------------------------------------------

    def _step(self, rows: DataFrame, batch_id: int) -> None:
        before = self._latest()
        folder = self._folder(batch_id)
        note = None if before is None else self._note(before)
        in_force = None if note is None else note["watermark"]

        arrived = rows.withColumn("_t", micros(rows, self.time))
        # One row a segment; one that is silent in this batch keeps the newest time it had.
        seen = arrived.groupBy(F.col(self.segment).cast("string").alias("_s")).agg(F.max("_t").alias("_newest")).collect()
        newest = {} if note is None else dict(note.get("newest", {}))
        for r in seen:
            if r["_newest"] is not None:
                name = f"segment {r['_s']}"
                newest[name] = max(r["_newest"], newest.get(name, r["_newest"]))
        bound = min(newest.values(), default=None)
        grew = bound is not None and (in_force is None or bound > in_force)
        watermark = bound if grew else in_force

        if in_force is not None:
            # Nothing newer than the watermark has been emitted: only rows behind it can be late.
            is_behind = F.coalesce(F.col("_t") <= F.lit(in_force), F.lit(False))
            timely = self._timely(arrived.filter(is_behind), self._emitted(note, before))
            arrived = arrived.filter(~is_behind).unionByName(timely)
        if before is not None:
            arrived = arrived.unionByName(self._held(before))
        reached = F.col("_t") <= F.lit(watermark) if grew else F.lit(False)
        fires = F.col("_t").isNull() | reached
        judged = arrived.withColumn("_fires", F.coalesce(fires, F.lit(False)))
        judged.write.mode("overwrite").parquet(f"{folder}/rows")

        # From here on the batch works on what was written, whatever happens to its input.
        fired = self.spark.read.schema(judged.schema).parquet(f"{folder}/rows").filter("_fires")
        delta = fired.filter(F.col("_t").isNotNull()).groupBy(self.key).agg(F.max("_t").alias("_emitted"))
        snapshot = batch_id if note is None else note["snapshot"]
        if note is not None and batch_id - snapshot >= self.snapshot_every:
            delta, snapshot = self._newest(self._emitted(note, before).unionByName(delta)), batch_id
        delta.write.mode("overwrite").parquet(f"{folder}/emitted")
        self.sink.write(fired.drop("_fires", "_t"), batch_id)
        self.files.create(f"{folder}/done.json", json.dumps({"watermark": watermark, "snapshot": snapshot, "newest": newest}))
        self._forget(snapshot, batch_id)

    def _forget(self, snapshot: int, batch_id: int) -> None:
        """Drop the state that neither this batch nor a replay of it can ask for."""
        for name in self.files.names(self.state):
            if int(name) < min(snapshot, batch_id - 1):
                self.files.remove(f"{self.state}/{name}")
