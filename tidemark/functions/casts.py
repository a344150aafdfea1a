"""Reading rows of one type as rows of another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_type(row: T.StructType, field: T.StructField) -> Column:
    """The column of ``row`` that ``field`` names, cast to its type; null where ``row`` has none.

    Fields of nested rows go by name as well. A value that the new type cannot hold fails the query.
    """
    if field.name not in row.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return _cast(F.col(f"`{field.name}`"), row[field.name].dataType, field.dataType).alias(field.name)


def _cast(column: Column, had: T.DataType, wanted: T.DataType) -> Column:
    if had == wanted:
        return column
    if isinstance(had, T.StructType) and isinstance(wanted, T.StructType):
        parts = [
            _cast(column.getField(f.name), had[f.name].dataType, f.dataType).alias(f.name)
            if f.name in had.names else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(had, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: _cast(x, had.elementType, wanted.elementType))
    if isinstance(had, T.MapType) and isinstance(wanted, T.MapType) and had.keyType == wanted.keyType:
        return F.transform_values(column, lambda _, x: _cast(x, had.valueType, wanted.valueType))
    if isinstance(had, (T.StructType, T.ArrayType, T.MapType)) and isinstance(wanted, T.StringType):
        return F.to_json(column)
    return column.cast(wanted)
