"""Scans of a log between positions, of one stream or many, and lookup by event pointer.

A *log* is any DataFrame, batch or streaming, with ``segment``, ``offset`` and the event's own
columns; ``routing_key``, ``event_time`` and ``payload`` are used where an operator needs them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.settings import stored
from tidemark.sources.cuts import (
    UNBOUNDED,
    Cut,
    after,
    before,
    clamp,
    head,
    load_cut,
)
from tidemark.sources.names import StreamName, resolve

POINTER_FIELDS = ("scope", "stream", "segment", "offset")


def scan(log: DataFrame, start: Cut | None = UNBOUNDED, end: Cut | None = UNBOUNDED) -> DataFrame:
    """Events between two cuts: ``start`` included, ``end`` excluded."""
    return before(after(log, start), end)


def scan_untruncated(log: DataFrame, start: Cut | None, end: Cut | None = UNBOUNDED) -> DataFrame:
    """As :func:`scan`, but a start that was truncated away moves to the first event still there."""
    return scan(log, clamp(start, load_cut(log, head())), end)


def until_marker(log: DataFrame, marker: Column) -> DataFrame:
    """Drop the end-of-stream marker of each segment and everything after it.

    The first marker of each segment is found by an aggregate over the marker rows alone, and the
    scan stops there; no segment is gathered or sorted.
    """
    return before(log, load_cut(log.filter(marker), head()), open_segments=True)


@dataclass(frozen=True)
class StreamRange:
    """A stream with the cuts between which it is read."""

    name: StreamName
    start: Cut | None = UNBOUNDED
    end: Cut | None = UNBOUNDED


def is_bounded(ranges: Iterable[StreamRange]) -> bool:
    """Bounded only when every stream has an end."""
    return all(r.end is not UNBOUNDED for r in ranges)


def stream_ranges(
    streams: Sequence[str | StreamName],
    starts: Sequence[Cut | str | None] | None = None,
    ends: Sequence[Cut | str | None] | None = None,
    default_scope: str | None = None,
) -> list[StreamRange]:
    """Pair streams with their cuts; lists of cuts follow the order of ``streams``."""
    if not streams:
        raise ValueError("at least one stream is needed")
    for label, cuts in (("start", starts), ("end", ends)):
        if cuts is not None and len(cuts) != len(streams):
            raise ValueError(f"{len(cuts)} {label} cuts for {len(streams)} streams")

    def as_cut(cut):
        return Cut.parse(cut) if isinstance(cut, str) or cut is None else Cut(cut)

    return [
        StreamRange(
            resolve(spec, default_scope),
            as_cut(starts[i]) if starts is not None else UNBOUNDED,
            as_cut(ends[i]) if ends is not None else UNBOUNDED,
        )
        for i, spec in enumerate(streams)
    ]


def named(log: DataFrame, name: StreamName) -> DataFrame:
    """Add the ``scope`` and ``stream`` of a log as columns."""
    return log.withColumns({"scope": F.lit(name.scope), "stream": F.lit(name.stream)})


def read_streams(ranges: Sequence[StreamRange], open_log: Callable[[StreamName], DataFrame]) -> DataFrame:
    """Read many streams as one, each between its own cuts."""
    logs = [named(scan(open_log(r.name), r.start, r.end), r.name) for r in ranges]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def event_pointer() -> Column:
    """The position of an event as bytes, for a log that has ``scope`` and ``stream`` columns."""
    return F.encode(F.to_json(F.struct(*POINTER_FIELDS)), "UTF-8")


def pointer_position(pointer: Column) -> Column:
    """Inverse of :func:`event_pointer`: a struct of scope, stream, segment and offset."""
    return F.from_json(
        F.decode(pointer, "UTF-8"),
        "scope string, stream string, segment int, offset bigint",
        {"mode": "FAILFAST"},
    )


def with_metadata(
    log: DataFrame, physical: Sequence[str], metadata: dict[str, Column], order: Sequence[str] | None = None
) -> DataFrame:
    """Physical columns followed by metadata columns, or all of them in the declared ``order``."""
    produced = log.select(*physical, *[c.alias(k) for k, c in metadata.items()])
    if order is None:
        return produced
    unknown = set(order) - set(produced.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return produced.select(*order)


def fetch(log: DataFrame, pointers: DataFrame, pointer: str = "event_pointer") -> DataFrame:
    """The events that ``pointers`` name, each pointer row once per event it names.

    An equi-join on the unpacked position; positions are unique, so no key is hot. The pointers are
    stored first: the planner then knows their true size and broadcasts them only while small.
    """
    wanted = pointers.select(pointer).withColumn("_at", pointer_position(F.col(pointer)))
    wanted = wanted.select(pointer, *[F.col(f"_at.{f}").alias(f) for f in POINTER_FIELDS])
    return log.join(stored(wanted, "pointers"), list(POINTER_FIELDS))


def local_streams(logs: dict[str, DataFrame]) -> Callable[[StreamName], DataFrame]:
    """An ``open_log`` over DataFrames at hand, keyed by ``scope/stream``."""

    def open_log(name: StreamName) -> DataFrame:
        try:
            return logs[str(name)]
        except KeyError:
            raise ValueError(f"no stream {name}") from None

    return open_log
