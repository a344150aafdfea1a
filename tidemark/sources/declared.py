"""Declared tables: physical, computed and metadata columns and a watermark over a stream's rows.

Columns are declared in the order in which they are wanted. Metadata come from the log, computed columns from SQL
expressions over any other columns of the declaration, in whatever order those are declared. The same declaration
reads batches and streams.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import watermarked
from tidemark.sources.scan import event_pointer


@dataclass(frozen=True)
class Physical:
    """A column of the stored rows."""

    name: str
    type: str


@dataclass(frozen=True)
class Computed:
    """A column computed by an SQL expression; never written."""

    name: str
    expression: str


@dataclass(frozen=True)
class Metadata:
    """A column with something the log knows about an event. A virtual one is not written."""

    name: str
    key: str
    type: str | None = None
    virtual: bool = True


#: What the log knows about an event, for a log with ``scope`` and ``stream`` columns.
METADATA = {
    "event_pointer": event_pointer,
    "scope": lambda: F.col("scope"),
    "stream": lambda: F.col("stream"),
    "segment": lambda: F.col("segment"),
    "offset": lambda: F.col("offset"),
    "routing_key": lambda: F.col("routing_key"),
    "ingest_epoch": lambda: F.col("ingest_epoch"),
}


@dataclass(frozen=True)
class Declaration:
    """The columns of a table and, perhaps, the column that carries its watermark with the delay behind it."""

    columns: Sequence[Physical | Computed | Metadata]
    watermark: str | None = None
    delay: str = "0 seconds"

    def __post_init__(self):
        names = [c.name.lower() for c in self.columns]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"columns {twice} are declared twice")
        for c in self.columns:
            if isinstance(c, Metadata) and c.key not in METADATA:
                raise ValueError(f"unknown metadata key {c.key!r}; there are {sorted(METADATA)}")
        if self.watermark is not None and self.watermark.lower() not in names:
            raise ValueError(f"the watermark column {self.watermark!r} is not declared")

    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def written(self) -> list[str]:
        """The columns a sink writes."""
        return [
            c.name for c in self.columns
            if isinstance(c, Physical) or (isinstance(c, Metadata) and not c.virtual)
        ]

    def read(self, log: DataFrame) -> DataFrame:
        """The declared table over a log. On streams the watermark is in force for what follows."""
        known = []
        for c in self.columns:
            if isinstance(c, Physical):
                if c.name not in log.columns:
                    raise ValueError(f"column {c.name!r} is not stored; there are {log.columns}")
                known.append(F.col(f"`{c.name}`").cast(c.type).alias(c.name))
            elif isinstance(c, Metadata):
                value = METADATA[c.key]()
                known.append((value.cast(c.type) if c.type else value).alias(c.name))
        rows = self._computed(log.select(*known))
        if self.watermark is not None:
            rows = watermarked(rows, self.watermark, self.delay) if rows.isStreaming else rows
        return rows.select(*[F.col(f"`{n}`") for n in self.names()])

    def _computed(self, rows: DataFrame) -> DataFrame:
        """Add computed columns as soon as all they refer to is there."""
        left = {c.name: c.expression for c in self.columns if isinstance(c, Computed)}
        while left:
            ready = [n for n, text in left.items() if not any(_mentions(text, other) for other in left)]
            if not ready:
                raise ValueError(f"columns {sorted(left)} refer to each other")
            for name in ready:
                rows = rows.withColumn(name, F.expr(left.pop(name)))
        return rows

    def to_write(self, rows: DataFrame) -> DataFrame:
        """What a sink writes of rows with the declared columns; computed and virtual ones may be missing."""
        return rows.select(*[F.col(f"`{n}`") for n in self.written()])


def _mentions(text: str, name: str) -> bool:
    """Whether an expression has a name in it, outside of longer words and of quoted texts."""
    bare = re.sub(r"'[^']*'", "''", text)
    return re.search(rf"(?<![\w]){re.escape(name)}(?![\w(])", bare, re.IGNORECASE) is not None
