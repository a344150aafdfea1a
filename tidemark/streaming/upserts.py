"""The current table of a live changelog."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changelog import current_table
from tidemark.sources.files import Files

_DONE = "_SUCCESS"


@dataclass
class UpsertView:
    """Use :meth:`write` with ``foreachBatch`` on changelog rows; :meth:`read` is the table they make.

    Per micro-batch the last change of each key it touched is kept in a folder of its own, which a
    replay writes over. Every ``snapshot_every`` batches the folders are folded into one.
    """

    folder: str
    key: list[str]
    columns: list[str]
    order: Sequence[str] = ("offset", "sub_order")
    snapshot_every: int = 20
    files: Files | None = field(default=None, init=False)

    def _files(self, df: DataFrame) -> Files:
        if self.files is None:
            self.files = Files(df.sparkSession, self.folder)
        return self.files

    def _parts(self) -> list[str]:
        """Folders to read: the newest complete snapshot and the complete batches after it."""
        names = [n for n in self.files.names(self.folder) if self.files.exists(f"{self.folder}/{n}/{_DONE}")]
        snapshots = [n for n in names if n.endswith("-all")]
        since = snapshots[-1] if snapshots else ""
        return ([since] if since else []) + [n for n in names if not n.endswith("-all") and n > since]

    def _last_changes(self, changes: DataFrame) -> DataFrame:
        kept = [c for c in dict.fromkeys([*self.columns, "row_kind", *self.order]) if c not in self.key]
        last = F.max_by(F.struct(*kept), F.struct(*self.order)).alias("_last")
        return changes.groupBy(*self.key).agg(last).select(*self.key, "_last.*")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        files = self._files(changes)
        name = f"{batch_id:010d}"
        self._last_changes(changes).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        parts = self._parts()
        if len(parts) > self.snapshot_every:
            known = changes.sparkSession.read.parquet(*[f"{self.folder}/{p}" for p in parts])
            self._last_changes(known).write.mode("overwrite").parquet(f"{self.folder}/{name}-all")
            for part in parts:
                if part != name:
                    files.remove(f"{self.folder}/{part}")

    def read(self, spark) -> DataFrame:
        """The live rows: the last image of each key that was not deleted."""
        self.files = self.files or Files(spark, self.folder)
        changes = spark.read.parquet(*[f"{self.folder}/{p}" for p in self._parts()])
        return current_table(changes, self.key, self.columns, self.order)
