"""Reader and writer metrics of running queries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQueryListener


@dataclass
class Progress:
    batches: int = 0
    rows: int = 0
    last_batch: int = -1
    watermark: str | None = None
    positions: dict = field(default_factory=dict)
    failed: str | None = None


class MetricsListener(StreamingQueryListener):
    """Per query name: batches and rows read, the watermark, and the source positions."""

    def __init__(self):
        self.queries: dict[str, Progress] = {}
        self._names: dict[str, str] = {}

    def _of(self, name) -> Progress:
        return self.queries.setdefault(name, Progress())

    def onQueryStarted(self, event):
        self._names[str(event.runId)] = event.name
        self._of(event.name)

    def onQueryProgress(self, event):
        progress = event.progress
        known = self._of(progress.name)
        if progress.batchId > known.last_batch:
            known.batches += 1
            known.last_batch = progress.batchId
        known.rows += progress.numInputRows
        known.watermark = progress.eventTime.get("watermark", known.watermark)
        known.positions = {s.description: s.endOffset for s in progress.sources}

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        name = self._names.pop(str(event.runId), None)
        if event.exception and name is not None:
            self._of(name).failed = event.exception
