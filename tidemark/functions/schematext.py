"""JSON-schema text of row types, for the schema table and the registry format."""

from __future__ import annotations

import json

from pyspark.sql import types as T

_NUMBERS = (
    T.DecimalType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DayTimeIntervalType,
    T.YearMonthIntervalType,
)


def json_type(kind: T.DataType) -> dict:
    """The JSON-schema keywords of one type; element types of arrays and maps are not kept."""
    if isinstance(kind, T.NullType):
        return {"type": "null"}
    if isinstance(kind, T.BooleanType):
        return {"type": "boolean"}
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return {"type": "string"}
    if isinstance(kind, T.BinaryType):
        return {"type": "string", "contentEncoding": "base64"}
    if isinstance(kind, _NUMBERS):
        return {"type": "number"}
    if isinstance(kind, T.DateType):
        return {"type": "string", "format": "date"}
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return {"type": "string", "format": "date-time"}
    if kind.typeName() == "time":
        return {"type": "string", "format": "time"}
    if isinstance(kind, T.ArrayType):
        return {"type": "array"}
    if isinstance(kind, T.MapType):
        return {"type": "object"}
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: json_type(f.dataType) for f in kind.fields}}
    raise TypeError(f"type {kind.simpleString()} has no JSON-schema form")


def json_schema_text(row: T.StructType) -> str:
    """The JSON schema of a row type. It loses element types; keep ``row.json()`` beside it."""
    return json.dumps({"title": "Json Schema", **json_type(row)})


# Avro's primitive and logical types.
_AVRO = {
    T.NullType: "null",
    T.BooleanType: "boolean",
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "string",
    T.CharType: "string",
    T.VarcharType: "string",
    T.BinaryType: "bytes",
    T.DateType: {"type": "int", "logicalType": "date"},
    T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"},
    T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"},
}


def avro_type(kind: T.DataType, name: str, nullable: bool = True):
    """The Avro schema of one type; ``name`` becomes the name of a record."""
    if isinstance(kind, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": avro_type(kind.elementType, f"{name}_item", kind.containsNull)}
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError("the keys of an Avro map are strings")
        out = {"type": "map", "values": avro_type(kind.valueType, f"{name}_value", kind.valueContainsNull)}
    elif isinstance(kind, T.StructType):
        fields = [{"name": f.name, "type": avro_type(f.dataType, f"{name}_{f.name}", f.nullable)} for f in kind.fields]
        out = {"type": "record", "name": name, "fields": fields}
    elif type(kind) in _AVRO:
        out = _AVRO[type(kind)]
    else:
        raise TypeError(f"type {kind.simpleString()} has no Avro form")
    return ["null", out] if nullable and out != "null" else out


def avro_schema_text(row: T.StructType, name: str = "record") -> str:
    """The Avro schema of a row type."""
    return json.dumps(avro_type(row, name, nullable=False))
