"""Stream tables: how a stream is kept as Parquet.

``<root>/<scope>/<stream>/`` holds

* ``data/ingest_epoch=<e>/segment=<s>/`` - the published events, ``data-<v>/`` those of later row types,
* ``staging/ingest_epoch=<e>/`` - epochs being written, which no reader looks at,
* ``claims/``, ``commits/`` and ``log/`` - the transactions (``commits.py``),
* ``types/`` - the versions of the row type, ``truncated/`` the cuts before which events are gone,
* ``schema.json`` - the number of segments and the first row type.

Offsets grow inside a segment but are not dense: an epoch owns ``2**36`` of them, a write task of
the epoch ``2**23``. An append of more than 8,192 tasks takes several epoch numbers at once. A batch is
written to the shared folder first: its row count gives the number of tasks, and a task that runs
again after a lost executor reads the same rows in the same order. That copy goes once the batch is published.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import as_type
from tidemark.operators.routing import route
from tidemark.settings import shared_folder
from tidemark.sources.commits import ABORTED, COMMITTED, FOLD_EVERY, SPAN, Claim, CommitLog
from tidemark.sources.cuts import Cut, after
from tidemark.sources.files import Files
from tidemark.sources.names import StreamName, resolve

EPOCH_BITS = 36
TASK_BITS = 23
TASKS_PER_EPOCH = 1 << (EPOCH_BITS - TASK_BITS)
ROWS_PER_TASK = 1 << TASK_BITS
# Rows a write task is planned for. Ranges and hashes are uneven, so it is far below what its offsets allow.
PLANNED_ROWS = 1 << 20

# Up to so many segments, spans are counted while a batch is written; beyond, its offsets are read once more.
OBSERVED_SEGMENTS = 64

_PLACES = (
    T.StructType()
    .add("offset", T.LongType())
    .add("routing_key", T.StringType())
    .add("ingest_epoch", T.LongType())
    .add("segment", T.IntegerType())
)


def _offset(epoch: int) -> Column:
    """Offsets of one write: the epoch's base, then the task, then the row inside the task."""
    place = F.monotonically_increasing_id()
    task = F.shiftright(place, 33)
    row = place.bitwiseAND(F.lit((1 << 33) - 1))
    # An assertion: the number of tasks follows from the row count.
    full = F.raise_error(F.lit(f"a write task has more than {ROWS_PER_TASK} rows"))
    row = F.when(row < ROWS_PER_TASK, row).otherwise(full.cast("bigint"))
    return F.lit(epoch << EPOCH_BITS).cast("bigint") + F.shiftleft(task, TASK_BITS) + row


@dataclass(frozen=True)
class Batch:
    """A batch as it lies in the shared folder, its rows numbered by arrival, and its write tasks."""

    rows: DataFrame
    n_rows: int
    tasks: int | None
    folder: str


def event_bytes(row: T.StructType) -> Column:
    """Bytes of an event's texts and binaries."""
    sized = [f.name for f in row.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    total = F.lit(0).cast("bigint")
    for name in sized:
        total = total + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return total


class StreamTable:
    """One stream: append to it, read it as a batch, or tail it."""

    def __init__(self, spark: SparkSession, root: str, name: str | StreamName,
                 default_scope: str | None = None):
        self.spark = spark
        self.name = resolve(name, default_scope)
        self.folder = f"{root.rstrip('/')}/{self.name.scope}/{self.name.stream}"
        self.data = f"{self.folder}/data"
        self.files = Files(spark, root)
        self.transactions = CommitLog(spark, self.files, self.folder)

    # -- definition ------------------------------------------------------------------------

    def create(self, schema: T.StructType | str, segments: int = 4) -> StreamTable:
        """Define the stream; an existing one keeps its definition."""
        row = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self._check(row)
        if segments < 1:
            raise ValueError(f"a stream has at least one segment, not {segments}")
        self.files.make_folder(self.data)
        self.transactions.create()
        text = json.dumps({"segments": segments, "row": row.jsonValue()})
        self.files.create(f"{self.folder}/schema.json", text)
        return self

    @staticmethod
    def _check(row: T.StructType) -> None:
        taken = set(row.names) & set(_PLACES.names)
        if taken:
            raise ValueError(f"columns {sorted(taken)} are set by the stream itself")

    def exists(self) -> bool:
        return self.files.exists(f"{self.folder}/schema.json")

    def drop(self) -> None:
        self.files.remove(self.folder)

    def _definition(self) -> dict:
        if not self.exists():
            raise ValueError(f"no stream {self.name}")
        return json.loads(self.files.read(f"{self.folder}/schema.json"))

    @property
    def row_types(self) -> list[T.StructType]:
        """All versions of the row type, the one in force last."""
        first = T.StructType.fromJson(self._definition()["row"])
        names = self.files.names(f"{self.folder}/types")
        later = [T.StructType.fromJson(json.loads(self.files.read(f"{self.folder}/types/{n}"))) for n in names]
        return [first, *later]

    @property
    def row_type(self) -> T.StructType:
        return self.row_types[-1]

    def evolve(self, row: T.StructType) -> int:
        """Write with another row type from now on; gives its version. Events written before stay as they are
        and are cast when they are read."""
        self._check(row)
        known = self.row_types
        if known[-1] == row:
            return len(known) - 1
        version = len(known)
        self.files.make_folder(self._data(version))
        while not self.files.create(f"{self.folder}/types/{version:06d}.json", row.json()):
            version += 1
            self.files.make_folder(self._data(version))
        return version

    def _data(self, version: int) -> str:
        return f"{self.data}-{version}" if version else self.data

    @property
    def segments(self) -> int:
        return self._definition()["segments"]

    @property
    def stored_type(self) -> T.StructType:
        return self.typed()

    # -- reading ---------------------------------------------------------------------------

    def typed(self, row: T.StructType | None = None) -> T.StructType:
        """The stored columns with another version of the row type; fields that a file lacks are null."""
        places = _PLACES.fields
        return T.StructType([*places[:2], *(row or self.row_type).fields, *places[2:]])

    def _versions(self, row: T.StructType | None, load) -> DataFrame:
        """The events of every row type, each read as it was written and cast to the wanted one."""
        known = self.row_types
        wanted = row or known[-1]
        parts = []
        for version, written in enumerate(known):
            part = load(self.typed(written), self._data(version))
            if written != wanted:
                cast = [as_type(written, f) for f in wanted.fields]
                part = part.select("offset", "routing_key", *cast, "ingest_epoch", "segment")
            parts.append(part)
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return after(whole, self.head()) if self.head() else whole

    def read(self, row: T.StructType | None = None) -> DataFrame:
        """All published events; filters on segment and offset reach the file scan."""
        return self._versions(row, lambda schema, folder: self.spark.read.schema(schema).parquet(folder))

    def read_epochs(self, epochs: list[int], row: T.StructType | None = None) -> DataFrame:
        """The events of a few epochs; no other folder is listed."""

        def load(schema: T.StructType, folder: str) -> DataFrame:
            there = [p for p in (f"{folder}/ingest_epoch={e}" for e in epochs) if self.files.exists(p)]
            if not there:
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).option("basePath", folder).parquet(*there)

        return self._versions(row, load)

    def tail(self, max_files_per_trigger: int | None = None, row: T.StructType | None = None,
             **options: str) -> DataFrame:
        """The published events as a stream; files truncated away are skipped, not an error."""

        def load(schema: T.StructType, folder: str) -> DataFrame:
            reader = self.spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
            if max_files_per_trigger:
                reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
            return reader.options(**options).parquet(folder)

        return self._versions(row, load)

    def commits(self) -> DataFrame:
        """The commit log: one row per committed batch."""
        return self.transactions.entries().filter(F.col("state") == COMMITTED)

    # -- positions -------------------------------------------------------------------------

    def positions(self) -> DataFrame:
        """Rows ``ingest_epoch, segment, first, last, n_rows, n_bytes``: where each committed epoch lies.

        Taken from the log alone, as are the cuts and backlogs below: no event is read.
        """
        spans = self.commits().select("ingest_epoch", F.inline("segments"))
        head = self.head()
        return spans if not head else after(spans.withColumn("offset", F.col("last")), head).drop("offset")

    def head_cut(self) -> Cut:
        """Per segment the first position still there."""
        low = self.positions().groupBy("segment").agg(F.min("first").alias("first")).collect()  # one row a segment
        head = self.head()
        return Cut({r["segment"]: max(r["first"], head.get(r["segment"], 0)) for r in low})

    def tail_cut(self) -> Cut:
        """Per segment the position after the last event. Epochs beyond an open one are left out, so
        that nothing can still be committed before the cut."""
        settled = self.positions().filter(F.col("ingest_epoch") < self.transactions.frontier())
        high = settled.groupBy("segment").agg(F.max("last").alias("last")).collect()  # one row a segment
        return Cut({r["segment"]: r["last"] + 1 for r in high})

    def epochs_between(self, start: Cut | None = None, end: Cut | None = None) -> DataFrame:
        """The rows of :meth:`positions` with events from ``start`` on and before ``end``."""
        spans = self.positions()
        if start:
            lows = after(spans.withColumn("offset", F.col("last")), start)
            spans = lows.drop("offset")
        if end is not None:
            named = [(F.col("segment") == s) & (F.col("first") < o) for s, o in end.items()]
            wanted = F.lit(False)
            for one in named:
                wanted = wanted | one
            spans = spans.filter(wanted)
        return spans

    def backlog(self, read_to: Cut | None) -> DataFrame:
        """Rows ``segment, unread_events, unread_bytes`` beyond a position.

        Whole epochs are counted from the log; only the few that the position (or a truncation) cuts through are read.
        """
        known = Cut(read_to or {})
        for segment, offset in self.head().items():
            known[segment] = max(offset, known.get(segment, 0))
        spans = self.epochs_between(known)
        cut_through = F.lit(False)
        for segment, offset in known.items():
            cut_through = cut_through | ((F.col("segment") == segment) & (F.col("first") < offset))
        # A position cuts through at most one epoch of a segment.
        through = spans.filter(cut_through).select("segment", "ingest_epoch").collect()
        whole = spans.filter(~cut_through).select("segment", "n_rows", "n_bytes")
        if through:
            rows = after(self.read_epochs(sorted({r["ingest_epoch"] for r in through})), known)
            of = F.lit(False)
            for r in through:
                of = of | ((F.col("segment") == r["segment"]) & (F.col("ingest_epoch") == r["ingest_epoch"]))
            rows = rows.filter(of).select(
                "segment", F.lit(1).cast("bigint").alias("n_rows"), event_bytes(self.row_type).alias("n_bytes")
            )
            whole = whole.unionByName(rows)
        return whole.groupBy("segment").agg(
            F.sum("n_rows").alias("unread_events"), F.sum("n_bytes").alias("unread_bytes")
        )

    # -- truncation ------------------------------------------------------------------------

    def head(self) -> Cut:
        """The cut before which events have been truncated away."""
        names = self.files.names(f"{self.folder}/truncated")
        return Cut.parse(self.files.read(f"{self.folder}/truncated/{names[-1]}")) if names else Cut()

    def truncate(self, cut: Cut) -> None:
        """Drop all events before ``cut``; a truncation never goes back.

        The cut is noted first and holds for every read from then on; epochs that lie before it in all their segments
        are removed, one it cuts through is filtered.
        """
        merged = self.head()
        for segment, offset in Cut(cut).items():
            merged[segment] = max(offset, merged.get(segment, 0))
        number = len(self.files.names(f"{self.folder}/truncated"))
        while not self.files.create(f"{self.folder}/truncated/{number:06d}.txt", merged.text()):
            number += 1
        keep = F.lit(False)
        spans = self.commits().select("ingest_epoch", F.inline("segments"))
        for segment, offset in merged.items():
            keep = keep | ((F.col("segment") == segment) & (F.col("last") >= offset))
        keep = keep | ~F.col("segment").isin(*merged)
        kept = {r[0] for r in spans.filter(keep).select("ingest_epoch").distinct().collect()}
        settled = self.transactions.frontier()
        self._remove(lambda epoch: epoch < settled and epoch not in kept)

    def truncate_before(self, epoch: int) -> None:
        """Drop the events of all epochs before ``epoch``."""
        self.truncate(Cut({s: epoch << EPOCH_BITS for s in range(self.segments)}))

    def _remove(self, gone) -> None:
        for version in range(len(self.row_types)):
            for name in self.files.names(self._data(version)):
                if name.startswith("ingest_epoch=") and gone(int(name.partition("=")[2])):
                    self.files.remove(f"{self._data(version)}/{name}")

    # -- writing ---------------------------------------------------------------------------

    def prepare(self, rows: DataFrame, tasks: int | None = None) -> Batch:
        """Store a batch and plan its write: more tasks than asked for where its rows need them.

        Without a number, and with no more rows than one task may hold, neighbouring tasks are merged
        at run time. :meth:`discard` removes what was stored.
        """
        folder = shared_folder(self.spark, "batch")
        arriving = rows.withColumn("_arrival", F.monotonically_increasing_id())
        seen = Observation()
        try:
            arriving.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.parquet(folder)
        except Exception:
            self.files.remove(folder)
            raise
        kept = self.spark.read.schema(arriving.schema).parquet(folder)
        n_rows = seen.get["n_rows"]
        needed = -(-n_rows // PLANNED_ROWS)
        if tasks or needed > 1:
            tasks = max(tasks or self.most_tasks(), needed)
        return Batch(kept, n_rows, tasks, folder)

    def discard(self, batch: Batch) -> None:
        """Remove the stored copy of a batch."""
        self.files.remove(batch.folder)

    def claimed(self, query_id: str, batch_id: int) -> Claim | None:
        """The epoch a batch has claimed before."""
        return self.transactions.claimed(query_id, batch_id)

    def claim(self, query_id: str, batch_id: int, tasks: int) -> Claim:
        """The epoch of a batch: the one it claimed before, or the next free one."""
        return self.transactions.claim(query_id, batch_id, -(-tasks // TASKS_PER_EPOCH))

    def is_committed(self, claim: Claim) -> bool:
        return self.transactions.state(claim) == COMMITTED

    def is_published(self, claim: Claim) -> bool:
        return self._published(claim) is not None

    def _published(self, claim: Claim) -> str | None:
        for version in range(len(self.row_types)):
            if self.files.exists(f"{self._data(version)}/ingest_epoch={claim.epoch}"):
                return f"{self._data(version)}/ingest_epoch={claim.epoch}"
        return None

    def _staged(self, claim: Claim) -> str:
        return f"{self.folder}/staging/ingest_epoch={claim.epoch}"

    def stage(self, batch: Batch, claim: Claim, *, key: str | Column | None = None,
              order: list[str] | None = None, keep_arrival: bool = True,
              observed: list[Column] = ()) -> dict:
        """Write a batch where no reader sees it, over whatever an earlier attempt left there.

        Gives what was seen on the way: ``n_rows``, the spans of the ``segments``, and the ``observed``
        aggregates by their names.

        Rows are split into ranges of (segment, order, arrival): a segment with a hot key spans many
        tasks, each task writes few files, and offsets follow ``order``, then the order in which
        each input task delivers its rows. Finding the ranges reads the input once more; where
        neither order matters, ``keep_arrival=False`` counts the rows per segment instead, which
        reads the routing key only, and spreads each segment over its share of the tasks.
        """
        segments, row = self.segments, self.row_type
        routed, tasks = route(batch.rows, segments, key), batch.tasks
        ranges = ["segment", *(order or []), "_arrival"]
        # Without a given number of tasks, small neighbouring ones are merged at run time.
        number = [tasks] if tasks else []
        if order or keep_arrival:
            spread = routed.repartitionByRange(*number, *ranges)
        else:
            shares = self._slots(routed, segments, tasks or self.most_tasks())
            slot = F.pmod(F.col("_arrival"), F.get(F.lit(shares), F.col("segment")))
            spread = routed.withColumn("_slot", slot).repartition(*number, "segment", "_slot")
        ranged = spread.sortWithinPartitions(*ranges)
        placed = ranged.withColumn("offset", _offset(claim.epoch))
        placed = placed.select("offset", "routing_key", *row.names, "segment")
        # After the range split, whose sampling would otherwise be counted as well.
        seen, spans = Observation(), []
        if segments <= OBSERVED_SEGMENTS:
            here = [F.col("segment") == s for s in range(segments)]
            spans = [F.struct(
                F.lit(s).alias("segment"), F.min(F.when(h, F.col("offset"))).alias("first"),
                F.max(F.when(h, F.col("offset"))).alias("last"), F.count_if(h).alias("n_rows"),
                F.sum(F.when(h, event_bytes(row))).alias("n_bytes"),
            ).alias(f"span_{s}") for s, h in enumerate(here)]
        placed = placed.observe(seen, F.count(F.lit(1)).alias("n_rows"), *spans, *observed)
        placed.write.mode("overwrite").partitionBy("segment").parquet(self._staged(claim))
        facts = dict(seen.get)
        if spans:
            found = [facts.pop(f"span_{s}").asDict() for s in range(segments)]
        else:
            found = [r.asDict() for r in self._spans(self._staged(claim)).collect()]  # one row a segment
        return facts | {"segments": [s for s in found if s["n_rows"]]}

    def _spans(self, folder: str) -> DataFrame:
        """The spans of an epoch's segments, from its files."""
        rows = self.spark.read.schema(self.typed()).parquet(folder)
        spans = rows.groupBy("segment").agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"),
            F.count(F.lit(1)).alias("n_rows"), F.sum(event_bytes(self.row_type)).alias("n_bytes"),
        )
        return spans.select(*[part.split(" ")[0] for part in SPAN.split(", ")])

    def _slots(self, routed: DataFrame, segments: int, tasks: int) -> list[int]:
        """Per segment, into how many parts its rows are cut: four per task its share is worth."""
        counts = {r["segment"]: r["count"] for r in routed.groupBy("segment").count().collect()}
        total = max(1, sum(counts.values()))
        return [max(1, -(-4 * tasks * counts.get(s, 0) // total)) for s in range(segments)]

    def publish(self, claim: Claim, facts: dict, watermark: int | None = None, **notes) -> None:
        """Make a staged batch visible by one rename, then log it."""
        self.reveal(claim)
        self.log(claim, facts, watermark, **notes)

    def reveal(self, claim: Claim) -> None:
        """The rename: from here on readers see the batch, and it can only be logged."""
        if self.transactions.state(claim) == ABORTED:
            raise RuntimeError(f"{self.name}: epoch {claim.epoch} was aborted")
        target = f"{self._data(len(self.row_types) - 1)}/ingest_epoch={claim.epoch}"
        if not self.is_published(claim) and not self.files.move(self._staged(claim), target):
            raise RuntimeError(f"{self.name}: epoch {claim.epoch} could not be published")

    def log(self, claim: Claim, facts: dict, watermark: int | None = None, **notes) -> None:
        spans = facts["segments"] if "segments" in facts else self._published_spans(claim)
        self.transactions.note(
            claim, COMMITTED, n_rows=facts["n_rows"], watermark=watermark, segments=spans, **notes
        )
        if claim.epoch // FOLD_EVERY != (claim.epoch + claim.width) // FOLD_EVERY:
            self.transactions.fold()

    def _published_spans(self, claim: Claim) -> list[dict]:
        return [r.asDict() for r in self._spans(self._published(claim)).collect()]  # one row a segment

    def abort(self, claim: Claim) -> bool:
        """Give a claim up: what was staged is removed and its epoch stays empty. False once it is published."""
        if self.is_published(claim):
            return False
        self.files.remove(self._staged(claim))
        self.transactions.note(claim, ABORTED)
        self.transactions.forget(claim)
        return True

    def recover(self, query_id: str, finish=None) -> dict[str, int]:
        """Settle what an earlier run of a query left open.

        Batches it published are logged (by ``finish``, or with their rows alone), all others are aborted. A query has one
        writer at a time, so its open epochs are not in use when a new run begins.
        """
        out = {"committed": 0, "aborted": 0}
        for epoch in self.transactions.open_epochs():
            claim = self.transactions.owner(epoch)
            attempt = claim.query_id.removeprefix(f"{query_id}-")
            if claim.query_id != query_id and not (len(attempt) == 32 and claim.query_id == f"{query_id}-{attempt}"):
                continue
            if claim.epoch != epoch and self.transactions.state(claim) is not None:
                # The head of a wide claim is settled; the rest of it follows.
                self.transactions.note(Claim(claim.query_id, claim.batch_id, epoch, 1), "covered")
            elif self.is_published(claim):
                if finish:
                    finish(claim)
                else:
                    self.log(claim, {"n_rows": self.read_epochs([claim.epoch]).count()})
                out["committed"] += 1
            elif self.abort(claim):
                out["aborted"] += 1
        return out

    def most_tasks(self) -> int:
        """The most write tasks an append can have when it is given no number."""
        conf = self.spark.conf
        initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        return max(int(conf.get("spark.sql.shuffle.partitions")), int(initial or 0))
