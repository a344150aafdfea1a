"""Change events: Debezium and Canal JSON to changelog rows.

A changelog row has ``row_kind`` (``+I``, ``-U``, ``+U``, ``-D``), ``sub_order`` (0, or 1 for the
second row of an update, which shares its event's offset) and the row's own fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a Debezium source block that are read.
_SOURCE = T.StructType(
    [
        T.StructField("ts_ms", T.LongType()),
        T.StructField("db", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
    ]
)

# Metadata keys of the two change formats.
DEBEZIUM_METADATA = (
    "ingestion-timestamp",
    "source.timestamp",
    "source.database",
    "source.schema",
    "source.table",
    "source.properties",
)
CANAL_METADATA = ("database", "table", "sql-type", "pk-names", "ingestion-timestamp")


def _fields(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _wanted(keys: Sequence[str], known: Sequence[str]) -> None:
    unknown = [k for k in keys if k not in known]
    if unknown:
        raise ValueError(f"unknown metadata {unknown}; known are {list(known)}")


def _change(kind: str, order: int, image: Column) -> Column:
    return F.struct(F.lit(kind).alias("row_kind"), F.lit(order).alias("sub_order"), image.alias("image"))


def _spread(rows: DataFrame, changes: Column, keep: Sequence[str], schema: T.StructType,
            metadata: dict[str, Column]) -> DataFrame:
    exploded = rows.select(
        *keep, *[c.alias(f"_meta_{i}") for i, c in enumerate(metadata.values())],
        F.explode(changes).alias("_c"),
    )
    return exploded.select(
        *keep,
        F.col("_c.row_kind").alias("row_kind"),
        F.col("_c.sub_order").alias("sub_order"),
        *[F.col("_c.image").getField(n).alias(n) for n in schema.names],
        *[F.col(f"_meta_{i}").alias(k) for i, k in enumerate(metadata)],
    )


def debezium_changes(
    df: DataFrame,
    schema: T.StructType | str,
    *,
    payload: str = "payload",
    keep: Sequence[str] = (),
    metadata: Sequence[str] = (),
    schema_include: bool = False,
) -> DataFrame:
    """Changelog rows of Debezium JSON: ``c``/``r`` insert, ``u`` update, ``d`` delete.

    Columns are ``keep``, ``row_kind``, ``sub_order``, the row's fields, then ``metadata``.
    ``schema_include`` is for events wrapped in ``{"schema": ..., "payload": ...}``.
    """
    _wanted(metadata, DEBEZIUM_METADATA)
    row = _fields(schema)
    kind = (
        T.StructType()
        .add("before", row)
        .add("after", row)
        .add("source", _SOURCE)
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
    )
    if schema_include:
        kind = T.StructType().add("payload", kind)
    parsed = df.withColumn("_e", F.from_json(payload, kind, {"mode": "FAILFAST"}))
    if schema_include:
        parsed = parsed.withColumn("_e", F.col("_e.payload"))
    e = F.col("_e")
    prefix = "$.payload.source" if schema_include else "$.source"
    sources = {
        "ingestion-timestamp": F.timestamp_millis(e["ts_ms"]),
        "source.timestamp": F.timestamp_millis(e["source"]["ts_ms"]),
        "source.database": e["source"]["db"],
        "source.schema": e["source"]["schema"],
        "source.table": e["source"]["table"],
        "source.properties": F.from_json(F.get_json_object(payload, prefix), "map<string,string>"),
    }
    op = e["op"]

    def needed(name: str) -> Column:
        """An image the operation must carry; without it, sums over the changelog would be wrong in silence."""
        refuse = F.raise_error(F.concat(F.lit("change operation "), op, F.lit(f" without {name}")))
        return F.when(e[name].isNull(), refuse.cast(row)).otherwise(e[name])

    # A null payload (a tombstone) parses to null and explodes to no row.
    changes = (
        F.when(e.isNull(), None)
        .when(op.isin("c", "r"), F.array(_change("+I", 0, needed("after"))))
        .when(op == "u", F.array(_change("-U", 0, needed("before")), _change("+U", 1, needed("after"))))
        .when(op == "d", F.array(_change("-D", 0, needed("before"))))
        .otherwise(F.raise_error(F.concat(F.lit("unknown change operation "), F.coalesce(op, F.lit("null")))))
    )
    return _spread(parsed, changes, keep, row, {k: sources[k] for k in metadata})


def canal_changes(
    df: DataFrame,
    schema: T.StructType | str,
    *,
    payload: str = "payload",
    keep: Sequence[str] = (),
    metadata: Sequence[str] = (),
    database: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Changelog rows of Canal JSON: ``data[]`` holds the rows, ``old[]`` the changed fields.

    Field values come as strings and are cast.

    ``database`` and ``table`` are regular expressions that the whole name must match. A field
    that ``old`` does not name has not changed.
    """
    _wanted(metadata, CANAL_METADATA)
    row = _fields(schema)
    texts = T.MapType(T.StringType(), T.StringType())
    kind = (
        T.StructType()
        .add("data", T.ArrayType(texts))
        .add("old", T.ArrayType(texts))
        .add("type", T.StringType())
        .add("database", T.StringType())
        .add("table", T.StringType())
        .add("sqlType", T.MapType(T.StringType(), T.IntegerType()))
        .add("pkNames", T.ArrayType(T.StringType()))
        .add("ts", T.LongType())
    )
    parsed = df.withColumn("_e", F.from_json(payload, kind, {"mode": "FAILFAST"}))
    e = F.col("_e")
    # Inside the explode, not as a filter: that would be pushed below the parse and parse again.
    foreign = F.lit(False)
    for name, pattern in (("database", database), ("table", table)):
        if pattern is not None:
            foreign = foreign | ~F.coalesce(e[name].rlike(f"^(?:{pattern})$"), F.lit(False))

    def value(field: T.StructField, texts: Column) -> Column:
        text = texts[field.name]
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, field.dataType, {"mode": "FAILFAST"})
        return F.unbase64(text) if isinstance(field.dataType, T.BinaryType) else text.cast(field.dataType)

    def image(texts: Column) -> Column:
        return F.struct(*[value(f, texts).alias(f.name) for f in row.fields])

    def update(now: Column, i: Column) -> Column:
        refuse = F.raise_error(F.lit("an UPDATE without its old values")).cast(texts)
        changed = F.when(old[i].isNull(), refuse).otherwise(old[i])
        before = F.map_concat(F.map_filter(now, lambda k, _: ~F.map_contains_key(changed, k)), changed)
        return F.array(_change("-U", 0, image(before)), _change("+U", 1, image(now)))

    old = e["old"]
    kind_of = e["type"]
    changes = (
        F.when(e.isNull() | foreign | (kind_of == "CREATE"), None)
        .when(kind_of == "INSERT", F.transform(e["data"], lambda r: _change("+I", 0, image(r))))
        .when(kind_of == "UPDATE", F.flatten(F.transform(e["data"], update)))
        .when(kind_of == "DELETE", F.transform(e["data"], lambda r: _change("-D", 0, image(r))))
        .otherwise(F.raise_error(F.concat(F.lit("unknown change type "), F.coalesce(kind_of, F.lit("null")))))
    )
    sources = {
        "database": e["database"],
        "table": e["table"],
        "sql-type": e["sqlType"],
        "pk-names": e["pkNames"],
        "ingestion-timestamp": F.timestamp_millis(e["ts"]),
    }
    return _spread(parsed, changes, keep, row, {k: sources[k] for k in metadata})
