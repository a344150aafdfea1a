"""Options of declared stream tables, checked before anything is read or written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from tidemark.sources.names import StreamName, resolve
from tidemark.sources.scan import StreamRange, is_bounded, stream_ranges

# Option keys and the values they take.
EXECUTION_TYPES = ("streaming", "batch")
SEMANTICS = ("at-least-once", "exactly-once", "best-effort")
SCAN_KEYS = {
    "scope",
    "scan.execution.type",
    "scan.streams",
    "scan.start-streamcuts",
    "scan.end-streamcuts",
    "scan.uid",
    "scan.max-files-per-trigger",
    "scan.max-rows-per-trigger",
}
SINK_KEYS = {
    "scope",
    "sink.stream",
    "sink.semantic",
    "sink.enable.watermark-propagation",
    "sink.routing-key.field.name",
}


def _listed(text: str | None) -> list[str] | None:
    return None if text is None else text.split(";")


def _unknown(options: Mapping[str, str], prefix: str, known: set[str]) -> None:
    strange = sorted(k for k in options if k.startswith(prefix) and k not in known)
    if strange:
        raise ValueError(f"unknown options {strange}")


def _one_of(options: Mapping[str, str], key: str, values: tuple[str, ...], default: str) -> str:
    value = options.get(key, default)
    if value not in values:
        raise ValueError(f"{key} is one of {list(values)}, not {value!r}")
    return value


@dataclass(frozen=True)
class ScanOptions:
    ranges: tuple[StreamRange, ...]
    streaming: bool
    uid: str
    max_files_per_trigger: int | None

    @property
    def bounded(self) -> bool:
        return not self.streaming or is_bounded(self.ranges)


@dataclass(frozen=True)
class SinkOptions:
    stream: StreamName
    semantic: str
    watermark_propagation: bool
    routing_key: str | None


def scan_options(options: Mapping[str, str]) -> ScanOptions:
    """Read the ``scan.*`` options; the mapping given is not changed."""
    _unknown(options, "scan.", SCAN_KEYS)
    execution = _one_of(options, "scan.execution.type", EXECUTION_TYPES, "streaming")
    streams = _listed(options.get("scan.streams"))
    if not streams:
        raise ValueError("scan.streams is required")
    scope = options.get("scope")
    ranges = stream_ranges(
        streams,
        _listed(options.get("scan.start-streamcuts")),
        _listed(options.get("scan.end-streamcuts")),
        scope,
    )
    limit = options.get("scan.max-files-per-trigger")
    if limit is not None and int(limit) < 1:
        raise ValueError(f"scan.max-files-per-trigger is a positive integer, not {limit}")
    uid = options.get("scan.uid") or "+".join(str(r.name) for r in ranges)
    return ScanOptions(tuple(ranges), execution == "streaming", uid, int(limit) if limit else None)


def sink_options(options: Mapping[str, str]) -> SinkOptions:
    """Read the ``sink.*`` options; the mapping given is not changed."""
    _unknown(options, "sink.", SINK_KEYS)
    if not options.get("sink.stream"):
        raise ValueError("sink.stream is required")
    semantic = _one_of(options, "sink.semantic", SEMANTICS, "at-least-once")
    marks = _one_of(options, "sink.enable.watermark-propagation", ("true", "false"), "false")
    return SinkOptions(
        resolve(options["sink.stream"], options.get("scope")),
        semantic,
        marks == "true",
        options.get("sink.routing-key.field.name"),
    )
