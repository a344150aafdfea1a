"""Stream names: ``scope/stream``, or a bare ``stream`` inside a default scope."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class StreamName(NamedTuple):
    scope: str
    stream: str

    def __str__(self) -> str:
        return f"{self.scope}/{self.stream}"


def resolve(spec: str | StreamName, default_scope: str | None = None) -> StreamName:
    """Split on the first ``/`` only; a bare name needs ``default_scope``."""
    if isinstance(spec, StreamName):
        return spec
    scope, slash, stream = spec.partition("/")
    if not slash:
        scope, stream = default_scope or "", spec
    if not scope:
        raise ValueError(f"stream {spec!r} has no scope and there is no default scope")
    if not stream:
        raise ValueError(f"stream {spec!r} has an empty name")
    return StreamName(scope, stream)


def split_name(spec: Column, default_scope: str | None = None) -> Column:
    """Column form of :func:`resolve`: a struct of ``scope`` and ``stream``."""
    parts = F.split(spec, "/", 2)
    qualified = F.size(parts) == 2
    return F.struct(
        F.when(qualified, parts[0]).otherwise(F.lit(default_scope)).alias("scope"),
        F.when(qualified, F.get(parts, F.lit(1))).otherwise(parts[0]).alias("stream"),
    )


def is_hidden(name: Column) -> Column:
    """Names that start with an underscore are internal."""
    return name.startswith("_")
