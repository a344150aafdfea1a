"""Streams read by position: a streaming source whose offsets are cuts.

``follow`` gives a streaming DataFrame of one stream table. The offset of the query is the epoch up to which the commit
log is settled, with the cut it stands for; a trigger reads the log's new entries, admits whole
commits up to a number of rows, and plans one split per file of just those epochs. No folder of epochs is listed.

A read with an end may end beyond today's tail: it goes on until its cut is reached (``run_until_end``). With a ``uid`` the position
outlives the checkpoint: a new query with that uid starts where the last one was told that its batches were done.

The log and the Parquet files are read through pyarrow's file systems (local disks, HDFS, ABFS, S3, GCS); where a
stream lies on anything else, ``StreamTable.tail`` reads it through Spark's own file source.
"""

from __future__ import annotations

import json
import time
import uuid as uuids
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.commits import COMMITTED, first_unsettled
from tidemark.sources.cuts import UNBOUNDED, Cut
from tidemark.sources.layout import EPOCH_BITS, StreamTable

FORMAT = "tidemark"


@dataclass
class FileSplit(InputPartition):
    """The rows of one file whose offsets lie in a range."""

    path: str
    segment: int
    epoch: int
    low: int
    high: int


class _Folder:
    """A stream's folder through pyarrow."""

    def __init__(self, folder: str):
        if "://" in folder or folder.startswith("file:"):
            self.fs, self.root = pafs.FileSystem.from_uri(folder)
        else:
            self.fs, self.root = pafs.LocalFileSystem(), folder

    def names(self, path: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{path}", allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith("."))

    def text(self, path: str) -> str:
        with self.fs.open_input_stream(f"{self.root}/{path}") as stream:
            return stream.read().decode()

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(f"{self.root}/{path}").type != pafs.FileType.NotFound

    def write(self, path: str, text: str) -> None:
        """Replace a small file in one step."""
        target = f"{self.root}/{path}"
        self.fs.create_dir(target.rpartition("/")[0], recursive=True)
        beside = f"{target.rpartition('/')[0]}/.{uuids.uuid4().hex}"
        with self.fs.open_output_stream(beside) as stream:
            stream.write(text.encode())
        self.fs.move(beside, target)


class _Log:
    """The commit log as the driver's source process sees it; entries are read once."""

    def __init__(self, folder: _Folder):
        self.folder, self.known = folder, {}
        self.folded_to = 1

    def refresh(self) -> int:
        """Read what is new; gives the frontier."""
        folds = [n for n in self.folder.names("log") if self.folder.exists(f"log/{n}/_SUCCESS")]
        folded = max((int(n) for n in folds), default=1)
        if folded > self.folded_to:
            table = pq.read_table(
                f"{self.folder.root}/log/{folded:010d}", filesystem=self.folder.fs,
                filters=[("ingest_epoch", ">=", self.folded_to)],
            )
            for entry in table.to_pylist():
                self.known.setdefault(entry["ingest_epoch"], entry)
            self.folded_to = folded
        names = self.folder.names("commits")
        for name in names:
            epoch = int(name[:10])
            if epoch not in self.known and epoch >= self.folded_to:
                self.known[epoch] = json.loads(self.folder.text(f"commits/{name}"))
        claimed = [int(n) for n in self.folder.names("claims/epochs")]
        settled = {int(n[:10]) for n in names}
        return first_unsettled(claimed, settled, self.folded_to)

    def forget(self, below: int) -> None:
        for epoch in [e for e in self.known if e < below]:
            del self.known[epoch]

    def spans(self, low: int, high: int):
        """(epoch, span) of the committed epochs in a range, in order."""
        for epoch in sorted(e for e in self.known if low <= e < high):
            if self.known[epoch]["state"] == COMMITTED:
                for span in self.known[epoch]["segments"]:
                    yield epoch, span


class CutReader(DataSourceStreamReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.folder = _Folder(options["folder"])
        self.start, self.end = Cut.parse(options.get("start")), Cut.parse(options.get("end"))
        self.uid, self.limit = options["uid"], int(options.get("rowspertrigger") or 0)
        self.log = _Log(self.folder)
        self.at: int | None = None

    # -- positions, on the driver ----------------------------------------------------------

    def _place(self, name: str) -> int | None:
        path = f"positions/{self.uid}/{name}.json"
        return json.loads(self.folder.text(path))["epoch"] if self.folder.exists(path) else None

    def _offset(self, epoch: int) -> dict:
        return {"epoch": epoch, "offset": epoch << EPOCH_BITS}

    def initialOffset(self) -> dict:
        """Only a query without a checkpoint asks: it starts where its uid was done."""
        epoch = self._place("done") or 1
        self._plan(epoch)
        return self._offset(epoch)

    def _plan(self, epoch: int) -> None:
        self.folder.write(f"positions/{self.uid}/planned.json", json.dumps(self._offset(epoch)))
        self.at = epoch

    def latestOffset(self) -> dict:
        frontier = self.log.refresh()
        if self.at is None:
            # After a restart: what was planned before is at or past what the checkpoint knows.
            self.at = self._place("planned") or 1
            return self._offset(self.at)
        upto, rows = self.at, 0
        while upto < min(frontier, self._last()):
            size = sum(s["n_rows"] for e, s in self.log.spans(upto, upto + 1))
            if self.limit and rows and rows + size > self.limit:
                break
            upto, rows = upto + 1, rows + size
            if self.limit and rows >= self.limit:
                break
        if upto > self.at:
            self._plan(upto)
        return self._offset(upto)

    def _last(self) -> float:
        """The epoch from which on nothing lies before the end cut."""
        if self.end is UNBOUNDED:
            return float("inf")
        return max(((o - 1) >> EPOCH_BITS) + 1 for o in self.end.values()) if self.end else 1

    def partitions(self, start: dict, end: dict) -> list[FileSplit]:
        self.log.refresh()
        heads = self.folder.names("truncated")
        head = Cut.parse(self.folder.text(f"truncated/{heads[-1]}")) if heads else Cut()
        # A version beyond the first has a folder of its own.
        data = sorted(n for n in self.folder.names("") if n == "data" or n.startswith("data-"))
        splits = []
        for epoch, span in self.log.spans(start["epoch"], end["epoch"]):
            segment = span["segment"]
            low = max(span["first"], (self.start or {}).get(segment, 0), head.get(segment, 0))
            high = span["last"] + 1
            if self.end is not UNBOUNDED:
                high = min(high, self.end.get(segment, 0))
            if low >= high:
                continue
            for version in data:
                place = f"{version}/ingest_epoch={epoch}/segment={segment}"
                splits += [
                    FileSplit(f"{place}/{name}", segment, epoch, low, high)
                    for name in self.folder.names(place) if name.endswith(".parquet")
                ]
        return splits

    def commit(self, end: dict) -> None:
        self.folder.write(f"positions/{self.uid}/done.json", json.dumps(end))
        self.log.forget(end["epoch"])

    # -- events, in tasks ------------------------------------------------------------------

    def read(self, partition: FileSplit):
        wanted = to_arrow_schema(self.schema)
        with self.folder.fs.open_input_file(f"{self.folder.root}/{partition.path}") as file:
            parquet = pq.ParquetFile(file)
            there = set(parquet.schema_arrow.names)
            columns = [n for n in wanted.names if n in there]
            for batch in parquet.iter_batches(columns=columns):
                offsets = batch.column("offset")
                keep = pc.and_(pc.greater_equal(offsets, partition.low), pc.less(offsets, partition.high))
                batch = batch.filter(keep)
                if batch.num_rows:
                    yield _shaped(batch, wanted, {"segment": partition.segment, "ingest_epoch": partition.epoch})


def _shaped(batch: pa.RecordBatch, wanted: pa.Schema, fixed: dict) -> pa.RecordBatch:
    """The batch with the wanted columns and types; what a file lacks is null."""
    columns = []
    for field in wanted:
        if field.name in fixed:
            columns.append(pa.array([fixed[field.name]] * batch.num_rows, field.type))
        elif field.name in batch.schema.names:
            columns.append(_timed(batch.column(field.name), field.type))
        else:
            columns.append(pa.nulls(batch.num_rows, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=wanted)


def _timed(column: pa.Array, kind: pa.DataType) -> pa.Array:
    return column if column.type == kind else pc.cast(column, kind)


class CutSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema) -> CutReader:
        return CutReader(schema, self.options)


def follow(stream: StreamTable, start: Cut | None = UNBOUNDED, end: Cut | None = UNBOUNDED, *,
           uid: str | None = None, rows_per_trigger: int | None = None) -> DataFrame:
    """The events of a stream between two cuts, as they are committed.

    Segments that ``start`` does not name are read from their head, those that ``end`` does not name not at all.
    A trigger admits whole commits, at least one, up to ``rows_per_trigger`` rows. ``uid`` identifies the reader; two
    queries must not use one at the same time.
    """
    stream.spark.dataSource.register(CutSource)
    reader = stream.spark.readStream.format(FORMAT).schema(stream.stored_type).option("folder", stream.folder)
    options = {
        "uid": uid or f"once-{uuids.uuid4().hex}",
        "start": None if start is UNBOUNDED else Cut(start).text(),
        "end": None if end is UNBOUNDED else Cut(end).text(),
        "rowsPerTrigger": str(rows_per_trigger) if rows_per_trigger else None,
    }
    return reader.options(**{k: v for k, v in options.items() if v is not None}).load()


def position(stream: StreamTable, uid: str) -> Cut:
    """The cut up to which the reader ``uid`` is done; the head if it has done nothing."""
    path = f"{stream.folder}/positions/{uid}/done.json"
    if not stream.files.exists(path):
        return Cut()
    done = json.loads(stream.files.read(path))
    return Cut({s: done["offset"] for s in range(stream.segments)})


def run_until_end(query: StreamingQuery, stream: StreamTable, end: Cut, *, uid: str | None = None,
                  timeout: float | None = None) -> bool:
    """Wait until a query has read up to ``end``, then stop it; False when the time ran out first.

    Raises what the query failed with. Progress is reported when the sink has the batch, so the position of ``uid``
    is noted here and does not wait for a next batch.
    """
    wanted = max(((o - 1) >> EPOCH_BITS) + 1 for o in end.values()) if end else 1
    began = time.monotonic()
    try:
        while True:
            stopped = query.awaitTermination(0.05)
            reached = _reached(query)
            if reached is not None and reached["epoch"] >= wanted:
                if uid:
                    _Folder(stream.folder).write(f"positions/{uid}/done.json", json.dumps(reached))
                return True
            if stopped or (timeout is not None and time.monotonic() - began > timeout):
                return False
    finally:
        query.stop()


def _reached(query: StreamingQuery) -> dict | None:
    """The position up to which the sink has the events."""
    progress = query.lastProgress
    if not progress:
        return None
    return json.loads(progress.json)["sources"][0]["endOffset"]
