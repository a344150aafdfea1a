"""A catalog over a root folder: scopes are databases, streams with a schema are tables.

Schemas are kept per (scope, group) in versions; a table reads with its latest version.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import as_type
from tidemark.functions.events import (
    as_nullable,
    avro_available,
    decode_avro,
    decode_json,
    encode_avro,
    encode_json,
)
from tidemark.functions.schematext import avro_schema_text, json_schema_text
from tidemark.operators.routing import key_column
from tidemark.sources.declared import Declaration
from tidemark.sources.files import Files
from tidemark.sources.layout import StreamTable
from tidemark.sources.names import StreamName, is_hidden, resolve
from tidemark.sources.options import scan_options, sink_options
from tidemark.sources.scan import named, read_streams
from tidemark.streaming.follow import follow
from tidemark.streaming.sinks import StreamSink

SCHEMA_TABLE = "namespace string, group_id string, version int, format string, json_schema string, row_type string"
FORMATS = ("json", "avro")


class Catalog:
    def __init__(self, spark: SparkSession, root: str, default_scope: str | None = None,
                 format: str = "json"):
        if format not in FORMATS:
            raise ValueError(f"format is one of {list(FORMATS)}, not {format!r}")
        self.spark, self.root, self.default_scope = spark, root.rstrip("/"), default_scope
        self.format = format
        self.files = Files(spark, root)
        self.files.make_folder(self.root)
        if default_scope and not self.database_exists(default_scope):
            self.create_database(default_scope)

    # -- databases -------------------------------------------------------------------------

    def list_databases(self) -> list[str]:
        return [n for n in self.files.names(self.root) if not n.startswith("_")]

    def database_exists(self, name: str) -> bool:
        return self.files.exists(f"{self.root}/{name}")

    def get_database(self, name: str) -> dict:
        self._need_database(name)
        return {"name": name, "location": f"{self.root}/{name}"}

    def create_database(self, name: str, if_not_exists: bool = False) -> None:
        if self.database_exists(name):
            if not if_not_exists:
                raise ValueError(f"database {name} exists")
            return
        self.files.make_folder(f"{self.root}/{name}")

    def drop_database(self, name: str, if_exists: bool = False, cascade: bool = False) -> None:
        if not self.database_exists(name):
            if not if_exists:
                raise ValueError(f"no database {name}")
            return
        if self.list_tables(name) and not cascade:
            raise ValueError(f"database {name} is not empty")
        self.files.remove(f"{self.root}/{name}")
        self.files.remove(f"{self.root}/_schemas/{name}")

    def _need_database(self, name: str) -> None:
        if not self.database_exists(name):
            raise ValueError(f"no database {name}")

    # -- tables ----------------------------------------------------------------------------

    def list_tables(self, database: str) -> list[str]:
        """Streams that also have a schema group; names with an underscore in front are internal."""
        self._need_database(database)
        groups = set(self.files.names(f"{self.root}/_schemas/{database}"))
        streams = self.files.names(f"{self.root}/{database}")
        return [s for s in streams if s in groups and not s.startswith("_")]

    def table_exists(self, table: str) -> bool:
        return self.stream(table).exists()

    def stream(self, table: str | StreamName) -> StreamTable:
        return StreamTable(self.spark, self.root, table, self.default_scope)

    def create_table(self, table: str, schema: T.StructType | str, segments: int = 4,
                     if_not_exists: bool = False) -> StreamTable:
        name = resolve(table, self.default_scope)
        self._need_database(name.scope)
        row = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        if self.table_exists(table):
            if not if_not_exists:
                raise ValueError(f"table {name} exists")
            return self.stream(name)
        self.register_schema(name, row)
        return self.stream(name).create(row, segments)

    def drop_table(self, table: str, if_exists: bool = False) -> None:
        name = resolve(table, self.default_scope)
        if not self.table_exists(table):
            if not if_exists:
                raise ValueError(f"no table {name}")
            return
        self.stream(name).drop()
        self.files.remove(f"{self.root}/_schemas/{name.scope}/{name.stream}")

    def get_table(self, table: str) -> dict:
        """The row type by the latest schema version, and the options to read and write it."""
        name = resolve(table, self.default_scope)
        if not self.table_exists(table):
            raise ValueError(f"no table {name}")
        options = {"scope": name.scope, "scan.streams": name.stream, "sink.stream": name.stream}
        return {"name": name, "row_type": self.latest_schema(name), "options": options}

    def create_view(self, table: str, view: str, computed: Mapping[str, str] | None = None) -> None:
        """Make a stream readable from SQL under ``view``, with columns computed by SQL expressions."""
        rows = self.stream(table).read()
        rows = rows.select("*", *[F.expr(e).alias(name) for name, e in (computed or {}).items()])
        rows.createOrReplaceTempView(view)

    # -- schemas ---------------------------------------------------------------------------

    def register_schema(self, table: str | StreamName, row: T.StructType) -> int:
        """Add a version; any change of the row type is allowed. The stream of the group writes with it from now on."""
        name = resolve(table, self.default_scope)
        folder = f"{self.root}/_schemas/{name.scope}/{name.stream}"
        version = len(self.files.names(folder))
        entry = {
            "namespace": name.scope,
            "group_id": name.stream,
            "format": self.format,
            "json_schema": json_schema_text(row),
            "row_type": row.json(),
        }
        while not self.files.create(f"{folder}/{version:06d}.json", json.dumps(entry | {"version": version})):
            version += 1
        if self.table_exists(name):
            self.stream(name).evolve(row)
        return version

    def latest_schema(self, table: str | StreamName) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._latest_entry(table)["row_type"]))

    def _latest_entry(self, table: str | StreamName) -> dict:
        name = resolve(table, self.default_scope)
        folder = f"{self.root}/_schemas/{name.scope}/{name.stream}"
        versions = self.files.names(folder)
        if not versions:
            raise ValueError(f"{name} has no registered schema")
        return json.loads(self.files.read(f"{folder}/{versions[-1]}"))

    def schemas(self) -> DataFrame:
        """All versions of all groups as a table."""
        reader = self.spark.read.schema(SCHEMA_TABLE).option("recursiveFileLookup", "true")
        return reader.json(f"{self.root}/_schemas/")

    def decode(self, log: DataFrame, table: str | StreamName, **options) -> DataFrame:
        """Decode payloads by the latest schema and the format of the group, looked up once."""
        entry = self._latest_entry(table)
        row = T.StructType.fromJson(json.loads(entry["row_type"]))
        if entry["format"].lower() == "json":
            return decode_json(log, row, **options)
        if not avro_available(self.spark):
            raise ValueError(f"{table} is a group of format {entry['format']}, which needs the spark-avro module")
        payload, keep = options.get("payload", "payload"), options.get("keep", ())
        decoded = log.select(*keep, decode_avro(F.col(payload), avro_schema_text(row)).alias("_row"))
        return decoded.select(*keep, *[F.col("_row").getField(n).alias(n) for n in row.names])

    def encode(self, rows: DataFrame, table: str, *, payload: str = "payload", keep: Sequence[str] = (), **options) -> DataFrame:
        """The ``keep`` columns and one payload per row, by the latest schema and the format of the group.

        Rows need the columns of the schema, which are cast to its types; :meth:`decode` gives them back. ``options``
        are those of ``encode_json``.
        """
        entry = self._latest_entry(table)
        row = T.StructType.fromJson(json.loads(entry["row_type"]))
        missing = sorted(set(row.names) - set(rows.columns))
        if missing:
            raise ValueError(f"columns {missing} of the schema of {table} are missing")
        typed = rows.select(
            F.struct(*keep).alias("_keep") if keep else F.lit(None).alias("_keep"),
            *[as_type(rows.schema, f) for f in as_nullable(row).fields],
        )
        if entry["format"].lower() == "json":
            body = encode_json(typed, row.names, **{"plain_decimals": True, **options})
        elif avro_available(self.spark):
            body = encode_avro(F.struct(*row.names), avro_schema_text(row))
        else:
            raise ValueError(f"{table} is a group of format {entry['format']}, which needs the spark-avro module")
        return typed.select(*[F.col("_keep").getField(k).alias(k) for k in keep], body.alias(payload))

    # -- declared tables -------------------------------------------------------------------

    def open(self, options: Mapping[str, str], declaration: Declaration | None = None) -> DataFrame:
        """A declared table by its ``scan.*`` options: a stream or a batch, between its cuts, with the
        columns of a declaration, if one is given."""
        declared = scan_options({"scope": self.default_scope or "", **options})
        if declared.streaming:
            limit = declared.max_files_per_trigger
            rows = read_streams(
                declared.ranges, lambda name: self.stream(name).tail(limit, self.version_in_force(name))
            )
        else:
            rows = read_streams(declared.ranges, lambda name: self.stream(name).read(self.version_in_force(name)))
        return rows if declaration is None else declaration.read(rows)

    def follow(self, options: Mapping[str, str], declaration: Declaration | None = None) -> DataFrame:
        """As :meth:`open` for one stream, read by position: ``scan.uid`` says where it goes on, and an end may
        lie beyond today's tail (``tidemark.streaming.follow``)."""
        declared = scan_options({"scope": self.default_scope or "", **options})
        if len(declared.ranges) != 1:
            raise ValueError("one stream is followed at a time")
        of = declared.ranges[0]
        limit = options.get("scan.max-rows-per-trigger")
        rows = follow(self.stream(of.name), of.start, of.end, uid=declared.uid.replace("/", "."),
                      rows_per_trigger=int(limit) if limit else None)
        return named(rows, of.name) if declaration is None else declaration.read(named(rows, of.name))

    def version_in_force(self, table: str | StreamName) -> T.StructType | None:
        """The latest registered row type; None for a stream without a schema group."""
        name = resolve(table, self.default_scope)
        known = self.files.names(f"{self.root}/_schemas/{name.scope}/{name.stream}")
        return self.latest_schema(name) if known else None

    def sink(self, options: Mapping[str, str], query_id: str, event_time: str | None = None) -> StreamSink:
        """The sink a declared table stands for, by its ``sink.*`` options.

        ``event_time`` is the column whose watermark is noted when propagation is on.
        """
        declared = sink_options({"scope": self.default_scope or "", **options})
        stream = self.stream(declared.stream)
        if declared.routing_key:
            key_column(self.spark.createDataFrame([], stream.row_type), declared.routing_key)
        return StreamSink(
            stream,
            query_id,
            declared.semantic,
            declared.routing_key,
            event_time=event_time if declared.watermark_propagation else None,
        )


def visible_tables(streams: DataFrame, groups: DataFrame, on: list[str], name: str) -> DataFrame:
    """Streams that are not internal and have a schema group."""
    return streams.filter(~is_hidden(F.col(name))).join(groups, on, "left_semi")


def latest_versions(schemas: DataFrame, by: list[str]) -> DataFrame:
    """The latest version of each schema group, folded before the shuffle."""
    last = F.max_by(F.struct("version", "schema"), "version").alias("_last")
    return schemas.groupBy(*by).agg(last).select(*by, "_last.version", "_last.schema")
