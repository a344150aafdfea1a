"""Stream cuts: a consistent position, one offset per segment.

At the API edge a cut is a small Python mapping (one entry per segment of one stream). Inside a
query it is either a filter or a table of ``segment, offset`` rows.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNBOUNDED = None
"""No position: the head of the stream as a start, no end as an end."""

UNBOUNDED_TEXT = ""
"""Text form of :data:`UNBOUNDED`."""

# A cut of at most this many segments becomes a plain filter; a larger one becomes a join.
FILTER_SEGMENTS = 64
# A cut of at most this many segments (some 16 MB) is broadcast when it is joined.
BROADCAST_SEGMENTS = 1_000_000


class Cut(dict):
    """``{segment: offset}``; the offset is the first one that lies beyond the cut."""

    def __init__(self, positions: Mapping[int, int] = ()):
        super().__init__({int(s): int(o) for s, o in dict(positions).items()})

    def text(self) -> str:
        """Base64 of the JSON object ``{"segment": offset}``, segments ascending."""
        body = json.dumps({str(s): self[s] for s in sorted(self)}, separators=(",", ":"))
        return base64.b64encode(body.encode()).decode()

    @classmethod
    def parse(cls, text: str | None) -> Cut | None:
        if text is None or text == UNBOUNDED_TEXT:
            return UNBOUNDED
        try:
            return cls(json.loads(base64.b64decode(text, validate=True)))
        except (ValueError, TypeError, AttributeError) as error:
            raise ValueError(f"not the text form of a cut: {text!r}") from error

    def table(self, spark: SparkSession, offset: str = "offset") -> DataFrame:
        """The cut as rows; broadcast in joins, unless it names more segments than fit a task."""
        rows = spark.createDataFrame(list(self.items()), f"segment int, {offset} bigint")
        return F.broadcast(rows) if len(self) <= BROADCAST_SEGMENTS else rows


def cut_text(rows: DataFrame, *by: str) -> DataFrame:
    """Text form of cuts held as rows ``by..., segment, offset``: one ``cut_text`` per group.

    A group has one row per segment of a stream, so gathering it is bounded by the segment count.
    """
    entries = F.array_sort(F.collect_list(F.struct("segment", "offset")))
    body = F.to_json(F.map_from_entries(entries))
    encoded = F.translate(F.base64(F.encode(body, "UTF-8")), "\r\n", "")
    return rows.groupBy(*by).agg(encoded.alias("cut_text"))


def parse_cut_text(text: Column) -> Column:
    """Column form of :meth:`Cut.parse`: a map from segment to offset."""
    parsed = F.from_json(
        F.decode(F.unbase64(text), "UTF-8"), "map<string,bigint>", {"mode": "FAILFAST"}
    )
    return F.transform_keys(parsed, lambda k, _: k.cast("int"))


def head() -> Column:
    """As an aggregate over a segment: the position of the first event still there."""
    return F.min("offset")


def tail() -> Column:
    """As an aggregate over a segment: the position after the last event."""
    return F.max("offset") + 1


def at_time(moment: Column) -> Column:
    """As an aggregate over a segment: the first event at or after ``moment``, else the tail."""
    return F.coalesce(F.min(F.when(F.col("event_time") >= moment, F.col("offset"))), tail())


def positions(log: DataFrame, where: Column, *by: str) -> DataFrame:
    """Rows ``by..., segment, offset`` of one position: :func:`head`, :func:`tail`, :func:`at_time`."""
    return log.groupBy(*by, "segment").agg(where.alias("offset"))


def load_cuts(log: DataFrame, **where: Column) -> dict[str, Cut]:
    """Several cuts of a log in one pass; each comes to the driver as one row per segment."""
    rows = log.groupBy("segment").agg(*[c.alias(name) for name, c in where.items()]).collect()
    return {
        name: Cut({row["segment"]: row[name] for row in rows if row[name] is not None and row["segment"] is not None})
        for name in where
    }


def load_cut(log: DataFrame, where: Column) -> Cut:
    """One cut of a log. Segments for which ``where`` is null are left out."""
    rows = log.groupBy("segment").agg(where.alias("offset")).collect()
    return Cut({row["segment"]: row["offset"] for row in rows
                if row["offset"] is not None and row["segment"] is not None})


def clamp(cut: Cut | None, head: Cut) -> Cut:
    """Move positions that were truncated away forward to the first event still there."""
    wanted = cut or {}
    return Cut({s: max(o, wanted.get(s, o)) for s, o in head.items()} | {
        s: o for s, o in wanted.items() if s not in head
    })


def _unnamed(cut: Cut) -> Column:
    """Segments a cut does not name; a null segment is one of them."""
    return ~F.coalesce(F.col("segment").isin(*cut), F.lit(False)) if cut else F.lit(True)


def after(log: DataFrame, cut: Cut | None, strict_segments: bool = False) -> DataFrame:
    """Events at or after ``cut``.

    A segment the cut does not name is newer than the cut and is read from its head, unless
    ``strict_segments`` keeps to the named ones.
    """
    if cut is UNBOUNDED:
        return log
    if len(cut) <= FILTER_SEGMENTS:
        parts = [(F.col("segment") == s) & (F.col("offset") >= o) for s, o in cut.items()]
        if not strict_segments:
            parts.append(_unnamed(cut))
        return log.filter(reduce(or_, parts, F.lit(False)))
    lower = cut.table(log.sparkSession, "cut_lower")
    joined = log.join(lower, "segment", "inner" if strict_segments else "left")
    kept = joined.filter(F.col("cut_lower").isNull() | (F.col("offset") >= F.col("cut_lower")))
    return kept.select(*log.columns)


def before(log: DataFrame, cut: Cut | None, open_segments: bool = False) -> DataFrame:
    """Events before ``cut``. A segment the cut does not name lies beyond it and is left out,
    unless ``open_segments`` leaves such segments without an end."""
    if cut is UNBOUNDED:
        return log
    if len(cut) <= FILTER_SEGMENTS:
        parts = [(F.col("segment") == s) & (F.col("offset") < o) for s, o in cut.items()]
        if open_segments:
            parts.append(_unnamed(cut))
        return log.filter(reduce(or_, parts, F.lit(False)))
    upper = cut.table(log.sparkSession, "cut_upper")
    joined = log.join(upper, "segment", "left" if open_segments else "inner")
    kept = joined.filter(F.col("cut_upper").isNull() | (F.col("offset") < F.col("cut_upper")))
    return kept.select(*log.columns)


def backlog(log: DataFrame, read_to: Cut | None, *by: str) -> DataFrame:
    """Events and payload bytes that lie beyond the position read so far."""
    return after(log, read_to).groupBy(*by).agg(
        F.count(F.lit(1)).alias("unread_events"),
        F.sum(F.octet_length("payload")).alias("unread_bytes"),
    )
