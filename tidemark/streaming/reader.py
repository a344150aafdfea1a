"""Tailing stream tables: one or many streams as one stream, from a cut on."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from tidemark.sources.cuts import Cut, before, head, load_cut
from tidemark.sources.files import Files
from tidemark.sources.layout import StreamTable
from tidemark.sources.names import StreamName
from tidemark.sources.scan import StreamRange, is_bounded, read_streams


def tail_streams(ranges: Sequence[StreamRange], open_table: Callable[[StreamName], StreamTable],
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Many streams tailed as one, each between its own cuts.

    Where a query starts again is decided by its checkpoint; without one it starts at the cuts.
    """
    return read_streams(ranges, lambda name: open_table(name).tail(max_files_per_trigger))


def trigger_for(ranges: Sequence[StreamRange]) -> dict:
    """Trigger options: a read whose every stream has an end stops when it is done."""
    return {"availableNow": True} if is_bounded(ranges) else {"processingTime": "0 seconds"}


class EndOfStream:
    """Drops the end-of-stream marker of each segment of a live stream, and all that follows it.

    Give it to ``sinks.start`` as ``prepare``. Where segments have ended is kept as one small file
    per batch in ``state``, so that a restarted query still knows. ``ended`` is the cut so far.
    """

    def __init__(self, marker: Column, state: str, files: Files):
        self.marker, self.state, self.files = marker, state, files
        self.ended = Cut()
        for name in files.names(state):
            self._note(json.loads(files.read(f"{state}/{name}")))

    def _note(self, found: dict) -> None:
        for segment, offset in Cut(found).items():
            self.ended[segment] = min(offset, self.ended.get(segment, offset))

    def __call__(self, rows: DataFrame) -> DataFrame:
        found = load_cut(rows.filter(self.marker), head())
        fresh = {s: o for s, o in found.items() if o < self.ended.get(s, o + 1)}
        if fresh:
            self._note(fresh)
            self.files.create(f"{self.state}/{len(self.files.names(self.state)):06d}.json", json.dumps(fresh))
        return before(rows, self.ended, open_segments=True) if self.ended else rows
