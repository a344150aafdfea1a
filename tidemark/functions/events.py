"""Decoding event payloads to rows and encoding rows to payloads, as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two timestamp notations.
TIMESTAMP_FORMATS = {
    "SQL": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "ISO-8601": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}

# The same for reading, where up to nine fraction digits may come; microseconds are kept.
READING_FORMATS = {
    "SQL": "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
    "ISO-8601": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]",
}

_CORRUPT = "_corrupt"


def decode_text(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")


def encode_text(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def decode_int(payload: Column) -> Column:
    """Four big-endian bytes, two's complement."""
    unsigned = F.conv(F.hex(payload), 16, 10).cast("bigint")
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def encode_int(value: Column) -> Column:
    return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(8)))


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _missing(text: Column, schema: T.StructType, path: str = "") -> list[Column]:
    """Per declared field: its dotted name where the JSON object in ``text`` lacks it."""
    keys = F.json_object_keys(text)
    found = []
    for field in schema.fields:
        name = f"{path}{field.name}"
        found.append(F.when(~F.array_contains(keys, field.name), F.lit(name)))
        if isinstance(field.dataType, T.StructType):
            inner = F.get_json_object(text, f"$['{field.name}']")
            found += _missing(inner, field.dataType, f"{name}.")
    return found


def _time_options(timestamp_format: str | None, formats: dict[str, str] = TIMESTAMP_FORMATS) -> dict[str, str]:
    if timestamp_format is None:
        return {}
    try:
        pattern = formats[timestamp_format]
    except KeyError:
        raise ValueError(f"timestamp format is one of {sorted(TIMESTAMP_FORMATS)}") from None
    return {"timestampNTZFormat": pattern, "timestampFormat": pattern}


def decode_json(
    df: DataFrame,
    schema: T.StructType | str,
    *,
    payload: str = "payload",
    keep: Sequence[str] = (),
    ignore_parse_errors: bool = False,
    fail_on_missing_field: bool = False,
    timestamp_format: str | None = None,
    observe: Observation | None = None,
) -> DataFrame:
    """One row per JSON event: the ``keep`` columns, then the declared fields.

    Numbers and booleans may come as JSON strings. A malformed event fails the query. With
    ``ignore_parse_errors`` it is dropped, and a field that does not fit its type is null. Null
    payloads carry no row and are dropped. ``observe`` receives the counts ``events`` and
    ``malformed`` when the result is run.
    """
    if ignore_parse_errors and fail_on_missing_field:
        raise ValueError("fail_on_missing_field and ignore_parse_errors exclude each other")
    wanted = _as_schema(schema)
    fields = times_as_text(wanted)  # JSON readers know no TIME
    options = _time_options(timestamp_format, READING_FORMATS)
    rows = df.filter(F.col(payload).isNotNull())
    if fail_on_missing_field:
        first = F.coalesce(*_missing(F.col(payload), fields))
        refuse = F.raise_error(F.concat(F.lit("missing field "), first))
        rows = rows.withColumn(payload, F.when(first.isNotNull(), refuse).otherwise(F.col(payload)))
    wide = T.StructType([*fields.fields, T.StructField(_CORRUPT, T.StringType())])
    typed = F.from_json(payload, wide, options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = rows.select(*keep, F.col(payload).alias("_text"), typed.alias("_typed"))
    # The second, slower parse runs only for the events that the first could not take as they are.
    fits = F.col("_typed").isNotNull() & F.col(f"_typed.{_CORRUPT}").isNull()
    taken = F.struct(*[F.col("_typed").getField(n).alias(n) for n in fields.names])
    mode = "PERMISSIVE" if ignore_parse_errors else "FAILFAST"
    loose = F.from_json("_text", _as_text(fields), options | {"mode": mode})
    loose = loose.try_cast(fields) if ignore_parse_errors else loose.cast(fields)
    row = F.when(fits, taken)
    if observe is not None:
        broken = ~fits & F.json_object_keys("_text").isNull()
        parsed = parsed.observe(observe, F.count(F.lit(1)).alias("events"), F.count_if(broken).alias("malformed"))
    if ignore_parse_errors:
        row = row.when(F.json_object_keys("_text").isNotNull(), loose)
        # Exploding at most one row drops the others without parsing twice, as a filter would.
        parsed = parsed.select(*keep, F.explode(F.when(row.isNotNull(), F.array(row))).alias("_row"))
    else:
        blank = F.raise_error(F.lit("a JSON event is blank"))
        parsed = parsed.select(*keep, row.otherwise(F.coalesce(loose, blank)).alias("_row"))

    def typed_field(had: T.StructField, field: T.StructField) -> Column:
        column = F.col("_row").getField(field.name)
        if had.dataType != field.dataType:
            column = column.try_cast(field.dataType) if ignore_parse_errors else column.cast(field.dataType)
        return column.alias(field.name)

    # The names of both are the same; only times differ.
    return parsed.select(*keep, *[typed_field(h, f) for h, f in zip(fields.fields, as_nullable(wanted).fields)])


def times_as_text(kind: T.DataType) -> T.DataType:
    """The same type with times of day as strings, at any depth; everything may be null."""
    return _rebuilt(kind, lambda k: T.StringType() if isinstance(k, T.TimeType) else k)


def as_nullable(kind: T.DataType) -> T.DataType:
    """The same type, everything of which may be null."""
    return _rebuilt(kind, lambda k: k)


def _rebuilt(kind: T.DataType, leaf) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _rebuilt(f.dataType, leaf)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_rebuilt(kind.elementType, leaf))
    if isinstance(kind, T.MapType):
        return T.MapType(_rebuilt(kind.keyType, leaf), _rebuilt(kind.valueType, leaf))
    return leaf(kind)


def _as_text(kind: T.DataType) -> T.DataType:
    """The same type with numbers and booleans as strings."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _as_text(kind.valueType))
    return T.StringType() if isinstance(kind, (T.NumericType, T.BooleanType)) else kind


def decode_json_rows(
    df: DataFrame, element: T.StructType | str, *, payload: str = "payload", keep: Sequence[str] = ()
) -> DataFrame:
    """Events that hold a JSON array: one row per element, none for an empty or null array."""
    fields = _as_schema(element)
    elements = F.from_json(payload, T.ArrayType(fields), {"mode": "FAILFAST"})
    rows = df.select(*keep, F.posexplode(elements).alias("element_index", "_row"))
    return rows.select(
        *keep, "element_index", *[F.col("_row").getField(n).alias(n) for n in fields.names]
    )


def assign_timestamps(
    elements: Column, extract: Callable[[Column, Column], Column]
) -> Column:
    """Timestamps for the elements decoded from one event.

    ``extract(element, previous)`` gives an element's timestamp from the element and the timestamp
    of the element before it in the same event (null for the first). Returns an array of structs
    ``element, ts``; the fold stays inside the row, so nothing is shuffled.
    """
    start = F.slice(
        F.transform(elements, lambda e: F.struct(e.alias("element"), F.lit(None).cast("bigint").alias("ts"))),
        1,
        0,
    )

    def step(done: Column, element: Column) -> Column:
        previous = F.try_element_at(done, F.lit(-1))["ts"]
        stamped = F.struct(element.alias("element"), extract(element, previous).cast("bigint").alias("ts"))
        return F.concat(done, F.array(stamped))

    return F.aggregate(elements, start, step)


def _plain_decimals(value: Column, kind: T.DataType) -> Column | None:
    """JSON text of a top-level decimal without an exponent; None for other types."""
    return value.cast("string") if isinstance(kind, T.DecimalType) else None


def encode_json(
    df: DataFrame,
    columns: Sequence[str],
    *,
    timestamp_format: str = "SQL",
    plain_decimals: bool = False,
    ignore_null_fields: bool = False,
) -> Column:
    """A JSON object of ``columns``. ``plain_decimals`` writes top-level decimals without an exponent."""
    options = _time_options(timestamp_format) | {"ignoreNullFields": str(ignore_null_fields).lower()}

    def written(name: str) -> Column:
        kind = df.schema[name].dataType
        text = times_as_text(kind)  # JSON writers know no TIME
        return F.col(f"`{name}`").cast(text).alias(name) if text != as_nullable(kind) else F.col(f"`{name}`")

    if not plain_decimals:
        return F.to_json(F.struct(*[written(n) for n in columns]), options)
    parts = []
    for name in columns:
        alone = F.to_json(F.struct(written(name)), options)
        text = _plain_decimals(F.col(name), df.schema[name].dataType)
        if text is not None:
            label = F.to_json(F.array(F.lit(name)))
            label = F.substring(label, F.lit(2), F.length(label) - 2)
            alone = F.when(text.isNull(), alone).otherwise(
                F.concat(F.lit("{"), label, F.lit(":"), text, F.lit("}"))
            )
        # Strip the braces; an ignored null field leaves nothing to join.
        body = F.substring(alone, F.lit(2), F.length(alone) - 2)
        parts.append(F.when(F.length(body) > 0, body))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def map_from_nullable(entries: Column, mode: str = "FAIL", literal: str = "null") -> Column:
    """A map from an array of ``key, value`` structs whose keys may be null.

    ``FAIL`` refuses a null key, ``DROP`` leaves the entry out, ``LITERAL`` writes ``literal``.
    """
    if mode == "DROP":
        return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))
    if mode == "LITERAL":
        return F.map_from_entries(
            F.transform(
                entries,
                lambda e: F.struct(
                    F.coalesce(e["key"], F.lit(literal)).alias("key"), e["value"].alias("value")
                ),
            )
        )
    if mode == "FAIL":
        refuse = F.raise_error(F.lit("a map key is null"))
        bad = F.exists(entries, lambda e: e["key"].isNull())
        return F.when(bad, refuse).otherwise(F.map_from_entries(entries))
    raise ValueError("mode is one of FAIL, DROP, LITERAL")


def avro_available(spark: SparkSession) -> bool:
    """Whether the optional spark-avro module is on the class path."""
    from pyspark.sql.avro.functions import to_avro

    try:
        return bool(spark.range(1).select(to_avro("id")).columns)
    except AnalysisException:
        return False


def decode_avro(payload: Column, schema_text: str) -> Column:
    """Avro binary to a struct; needs the spark-avro module."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, schema_text, {"mode": "FAILFAST"})


def encode_avro(row: Column, schema_text: str = "") -> Column:
    """A struct to Avro binary; needs the spark-avro module."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro(row, schema_text)
