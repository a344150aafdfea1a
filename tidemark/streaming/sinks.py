"""Appending to stream tables, once or per micro-batch, with three delivery guarantees."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.changelog import append_only
from tidemark.sources.commits import Claim
from tidemark.sources.layout import Batch, StreamTable

logger = logging.getLogger(__name__)

# The delivery guarantees.
AT_LEAST_ONCE = "at-least-once"
EXACTLY_ONCE = "exactly-once"
BEST_EFFORT = "best-effort"
GUARANTEES = (AT_LEAST_ONCE, EXACTLY_ONCE, BEST_EFFORT)
# Under this name the times of a commit hold the watermark in force after it.
IN_FORCE = "in force"
# The column that makes rows a changelog; sinks take its inserts only.
KIND = "row_kind"


@dataclass
class SinkMetrics:
    """Counts since the sink was made."""

    stream: str
    records_out: int = 0
    batches_failed: int = 0
    watermark: int | None = None
    replays_skipped: int = 0


@dataclass
class WatermarkNotes:
    """Notes, with a commit, the watermark that was in force while its batch was written.

    In force during a batch is the least over source segments of the newest event time that each has delivered in
    earlier batches; it never falls, and a segment that is silent keeps its last time. It is noted when it has
    grown since the last note and the batch has an event at or past it. ``segment`` names the column with
    the source segment; without one all rows are of one segment. What the segments have delivered is kept in the
    commit log, so a restarted sink goes on where it stopped.
    """

    segment: str | None = None
    delay_micros: int = 0
    times: dict[str, int] | None = None
    noted: int | None = None

    def load(self, own: DataFrame) -> None:
        """Take up the state of the last commit among the commits of this query."""
        last = own.agg(F.max_by("times", "batch_id").alias("times"), F.max("watermark").alias("noted")).first()
        self.times, self.noted = dict(last["times"] or {}), last["noted"]

    def step(self, rows: DataFrame, time: str, newest: int | None) -> tuple[int | None, dict[str, int]]:
        """The watermark to note with a batch, or None, and the times after it."""
        in_force = self.times.get(IN_FORCE)
        grew = in_force is not None and (self.noted is None or in_force > self.noted)
        mark = in_force if grew and newest is not None and newest >= in_force else None
        after = dict(self.times)
        if newest is not None:
            if self.segment is None:
                seen = {"all": newest}
            else:
                newest_of = rows.groupBy(F.col(self.segment).cast("string").alias("s")).agg(F.max(micros(rows, time)).alias("t"))
                seen = {f"segment {r['s']}": r["t"] for r in newest_of.collect() if r["t"] is not None}  # one row a segment
            for name, value in seen.items():
                after[name] = max(value, after.get(name, value))
            bound = min(v for k, v in after.items() if k != IN_FORCE) - self.delay_micros
            after[IN_FORCE] = bound if in_force is None else max(bound, in_force)
        return mark, after


@dataclass
class StreamSink:
    """Writes batches to a stream table; use :meth:`write` with ``foreachBatch``.

    ``key`` routes events (a string column, an expression, or None for random routing). ``order``
    gives the columns whose order offsets follow inside a segment. ``event_time`` names the column
    from which a watermark is noted with each commit: the newest time written, less ``delay_micros``, or, with
    ``marks``, the watermark in force.
    ``keep_arrival`` keeps the order in which each input task delivers its rows. ``tasks`` is the
    number of write tasks.
    """

    table: StreamTable
    query_id: str
    guarantee: str = AT_LEAST_ONCE
    key: str | Column | None = None
    order: list[str] | None = None
    event_time: str | None = None
    delay_micros: int = 0
    keep_arrival: bool = True
    tasks: int | None = None
    marks: WatermarkNotes | None = None
    metrics: SinkMetrics = field(init=False)
    _recovered: bool = field(init=False, default=False)

    def __post_init__(self):
        if self.guarantee not in GUARANTEES:
            raise ValueError(f"guarantee is one of {list(GUARANTEES)}, not {self.guarantee!r}")
        if self.marks is not None and not self.event_time:
            raise ValueError("watermarks are noted from an event-time column")
        self.metrics = SinkMetrics(str(self.table.name))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        try:
            self._write(rows, batch_id)
        except Exception:
            self.metrics.batches_failed += 1
            if self.guarantee != BEST_EFFORT:
                raise
            logger.warning("%s: batch %s was lost", self.table.name, batch_id, exc_info=True)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        # Only exactly-once remembers which batches it has seen; the others write a replay again.
        once = self.guarantee == EXACTLY_ONCE
        query = self.query_id if once else f"{self.query_id}-{uuid.uuid4().hex}"
        if not self._recovered:
            self.table.recover(self.query_id, self._log_published)
            self._recovered = True
        claim = self.table.claimed(query, batch_id)
        if claim is not None and self.table.is_published(claim):
            if not self.table.is_committed(claim):
                self._log_published(claim)
            self.metrics.replays_skipped += 1
            return
        if once and self.table.transactions.is_done(query, batch_id):
            self.metrics.replays_skipped += 1
            return
        if KIND in rows.columns and KIND not in self.table.row_type.names:
            rows = append_only(rows, KIND)
        batch = self.table.prepare(rows, self.tasks)
        try:
            claim = self.table.claim(query, batch_id, batch.tasks or self.table.most_tasks())
            try:
                self._commit(batch, claim)
            except Exception:
                # What was staged goes; a batch that was published already stays and is logged by its replay.
                self.table.abort(claim)
                raise
            if not once:
                self.table.transactions.forget(claim)
        finally:
            self.table.discard(batch)

    def _commit(self, batch: Batch, claim: Claim) -> None:
        observed = [F.max(micros(batch.rows, self.event_time)).alias("newest")] if self.event_time else []
        facts = self.table.stage(
            batch, claim, key=self.key, order=self.order, keep_arrival=self.keep_arrival, observed=observed
        )
        # Observed while the batch was written, so there is no second pass.
        newest = facts.get("newest")
        if self.marks is not None:
            if self.marks.times is None:
                self.marks.load(self._own_commits())
            mark, times = self.marks.step(batch.rows, self.event_time, newest)
            self.table.publish(claim, facts, mark, times=times)
            self.marks.times, self.marks.noted = times, mark if mark is not None else self.marks.noted
            self.metrics.watermark = self.marks.noted
        else:
            if newest is not None:
                self._advance(newest)
            self.table.publish(claim, facts, self.metrics.watermark)
        self.metrics.records_out += facts["n_rows"]

    def _advance(self, newest: int) -> None:
        """The committed watermark never falls, nor does it after a restart."""
        if self.metrics.watermark is None:
            self.metrics.watermark = self._last_watermark()
        mark = newest - self.delay_micros
        known = self.metrics.watermark
        self.metrics.watermark = mark if known is None else max(mark, known)

    def _last_watermark(self) -> int | None:
        """The newest watermark that an earlier run of this query committed, under any of its names."""
        return self._own_commits().agg(F.max("watermark")).first()[0]

    def _log_marked(self, claim: Claim, published: DataFrame, row: dict) -> None:
        if self.marks.times is None:
            self.marks.load(self._own_commits())
        mark, times = self.marks.step(published, self.event_time, row["newest"])
        self.table.log(claim, {"n_rows": row["n_rows"]}, mark, times=times)
        self.marks.times, self.marks.noted = times, mark if mark is not None else self.marks.noted

    def _own_commits(self) -> DataFrame:
        name = F.col("query_id")
        return self.table.commits().filter((name == self.query_id) | name.startswith(f"{self.query_id}-"))

    def _log_published(self, claim: Claim) -> None:
        """An earlier attempt published the batch and stopped before logging it."""
        published = self.table.read_epochs([claim.epoch])
        totals = [F.count(F.lit(1)).alias("n_rows")]
        if self.event_time:
            totals.append(F.max(micros(published, self.event_time)).alias("newest"))
        row = published.agg(*totals).first().asDict()
        if self.marks is not None:
            self._log_marked(claim, published, row)
            return
        if row.get("newest") is not None:
            self._advance(row["newest"])
        self.table.log(claim, {"n_rows": row["n_rows"]}, self.metrics.watermark)


def append(table: StreamTable, rows: DataFrame, *, key: str | Column | None = None,
           order: list[str] | None = None, event_time: str | None = None, keep_arrival: bool = False,
           tasks: int | None = None) -> SinkMetrics:
    """Append a batch; the call returns when it is published, and raises when it failed."""
    sink = StreamSink(
        table, f"append-{uuid.uuid4().hex}", EXACTLY_ONCE, key, order, event_time,
        keep_arrival=keep_arrival, tasks=tasks,
    )
    sink.write(rows, 0)
    return sink.metrics


def append_in_event_time_order(table: StreamTable, rows: DataFrame, key: str | Column, time: str,
                               arrival: str, tasks: int | None = None) -> SinkMetrics:
    """Append so that, inside each segment and so for each key, offsets follow event time.

    Ties keep arrival order. A hot key's segment spans several ranges of time, not one task.
    """
    return append(table, rows, key=key, order=[time, arrival], event_time=time, tasks=tasks)


def insert_into(table: StreamTable, query: str, *, key: str | None = None) -> SinkMetrics:
    """``INSERT INTO`` a stream: append the result of a SQL query, matching columns by position."""
    rows = table.spark.sql(query)
    names = table.row_type.names
    if len(rows.columns) != len(names):
        raise ValueError(f"{len(rows.columns)} columns for the {len(names)} of {table.name}")
    typed = rows.toDF(*names).select(*[F.col(f.name).cast(f.dataType) for f in table.row_type.fields])
    return append(table, typed, key=key)


def start(stream: DataFrame, sink: StreamSink, checkpoint: str, *, available_now: bool = False,
          interval: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Start a query that writes ``stream`` to ``sink``; ``checkpoint`` is what identifies it.

    ``prepare`` is applied to each micro-batch before it is written.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        sink.write(prepare(rows) if prepare else rows, batch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.queryName(sink.query_id)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
