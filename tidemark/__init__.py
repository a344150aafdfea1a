"""Tidemark: segmented, append-only event logs as Spark tables and streams."""

from tidemark.settings import build_session, shared_folder
from tidemark.sources.cuts import UNBOUNDED, Cut
from tidemark.sources.layout import StreamTable
from tidemark.sources.names import StreamName, resolve
from tidemark.sources.scan import StreamRange, read_streams, scan

__all__ = [
    "UNBOUNDED",
    "Cut",
    "StreamName",
    "StreamRange",
    "StreamTable",
    "build_session",
    "read_streams",
    "resolve",
    "scan",
    "shared_folder",
]
