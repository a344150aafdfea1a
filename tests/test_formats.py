"""Decoding and encoding of events, change events and schema text."""

import datetime
import decimal
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cdc, events
from tidemark.functions.schematext import json_schema_text
from tidemark.operators import changelog


def payloads(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset bigint, payload string")


def test_int_events(spark):
    numbers = [0, 1, -1, 2**31 - 1, -(2**31), 123456]
    df = spark.createDataFrame([(n,) for n in numbers], "n int").withColumn("b", events.encode_int(F.col("n")))
    rows = df.withColumn("back", events.decode_int(F.col("b"))).collect()
    assert [bytes(r.b) for r in rows] == [n.to_bytes(4, "big", signed=True) for n in numbers]
    assert [r.back for r in rows] == numbers


def test_text_events(spark):
    df = spark.createDataFrame([("é",), ("",)], "t string").withColumn("b", events.encode_text(F.col("t")))
    assert [(bytes(r.b).decode(), r.back) for r in df.withColumn("back", events.decode_text(F.col("b"))).collect()] == [
        ("é", "é"), ("", "")
    ]


def test_json_rows(spark):
    df = payloads(spark, '{"key": "a", "value": 1, "more": 2}', '{"key": "b"}', None)
    got = events.decode_json(df, "key string, value int", keep=["offset"])
    assert got.columns == ["offset", "key", "value"]
    assert sorted(map(tuple, got.collect())) == [(0, "a", 1), (1, "b", None)]


def test_json_errors(spark):
    df = payloads(spark, '{"k": 1, "s": {"b": true}}', '{"k": ', '{"k": "x", "s": {"b": "true"}}', "[]", "")
    for bad in df.filter("offset > 0").collect():
        with pytest.raises((PySparkException, Py4JJavaError)):
            events.decode_json(payloads(spark, bad.payload), "k int, s struct<b: boolean>").collect()
    lenient = events.decode_json(df, "k int, s struct<b: boolean>", keep=["offset"], ignore_parse_errors=True)
    assert {(r.offset, r.k, r.s.b) for r in lenient.collect()} == {(0, 1, True), (2, None, True)}
    with pytest.raises(ValueError, match="exclude"):
        events.decode_json(df, "k int", ignore_parse_errors=True, fail_on_missing_field=True)


def test_malformed_events_are_counted(spark):
    seen = Observation()
    df = payloads(spark, '{"k": 1}', "{", '{"k": "x"}', "[1]", None)
    assert events.decode_json(df, "k int", ignore_parse_errors=True, observe=seen).count() == 2
    assert seen.get == {"events": 4, "malformed": 2}


def test_numbers_may_be_json_strings(spark):
    df = payloads(spark, '{"i": "5", "d": "1.50", "b": "true", "a": ["1", 2], "m": {"x": "7"}, "s": 3}')
    got = events.decode_json(df, "i int, d decimal(5,2), b boolean, a array<int>, m map<string,bigint>, s string")
    assert tuple(got.first()) == (5, decimal.Decimal("1.50"), True, [1, 2], {"x": 7}, "3")


def test_missing_fields(spark):
    schema = "a int, b struct<c: int>"
    whole = payloads(spark, '{"a": null, "b": {"c": 1}}')
    assert events.decode_json(whole, schema, fail_on_missing_field=True).count() == 1
    for text, name in (('{"b": {"c": 1}}', "a"), ('{"a": 1, "b": {}}', "b.c")):
        with pytest.raises(PySparkException, match=f"missing field {name}"):
            events.decode_json(payloads(spark, text), schema, fail_on_missing_field=True).collect()


ALL_TYPES = (
    "bool boolean, tinyint tinyint, smallint smallint, int int, bigint bigint, float float, double double, "
    "name string, bytes binary, dec decimal(9,6), doubles array<double>, date date, ts3 timestamp_ntz, "
    "zoned timestamp, map map<string,bigint>, multi map<string,int>, map2map map<string,map<string,int>>, "
    "map2array map<string,array<int>>, nulls map<string,string>, row struct<a: int, b: string>"
)


def all_types():
    utc = datetime.timezone.utc
    return (
        True, -128, 32767, 1, 2**62, 1.5, -2.25, "héllo \"q\"", bytearray(range(256)),
        decimal.Decimal("123.456789"), [1.1, None, 3.3], datetime.date(1990, 10, 14),
        datetime.datetime(1990, 10, 14, 12, 12, 43, 123000),
        datetime.datetime(1990, 10, 14, 12, 12, 43, 123456, tzinfo=utc),
        {"a": 1}, {"blue": 2, "red": 1}, {"o": {"i": 5}}, {"k": [1, 2]}, {"n": None}, (7, None),
    )


@pytest.mark.parametrize("style", ["SQL", "ISO-8601"])
def test_all_types_come_back(spark, style):
    df = spark.createDataFrame([all_types()], ALL_TYPES)
    text = df.select(events.encode_json(df, df.columns, timestamp_format=style).alias("payload"))
    again = events.decode_json(text, df.schema, timestamp_format=style)
    assert again.collect() == df.collect()
    encoded = json.loads(text.first()[0])
    assert encoded["date"] == "1990-10-14"
    assert encoded["ts3"] == ("1990-10-14T12:12:43.123000" if style == "ISO-8601" else "1990-10-14 12:12:43.123000")
    with pytest.raises(ValueError):
        events.encode_json(df, df.columns, timestamp_format="RFC")


def test_plain_decimals(spark):
    df = spark.sql("SELECT cast(0 AS decimal(38,18)) AS `a\"b`, cast(NULL AS decimal(5,2)) AS n, 'x' AS s")
    plain = df.select(events.encode_json(df, df.columns, plain_decimals=True)).first()[0]
    assert plain == '{"a\\"b":0.000000000000000000,"n":null,"s":"x"}'
    short = df.select(events.encode_json(df, df.columns, plain_decimals=True, ignore_null_fields=True)).first()[0]
    assert short == '{"a\\"b":0.000000000000000000,"s":"x"}'
    assert "E-" in df.select(events.encode_json(df, df.columns)).first()[0]


def test_null_map_keys(spark):
    df = spark.createDataFrame([([(None, 1), ("a", 2)],)], "e array<struct<key: string, value: int>>")
    assert df.select(events.map_from_nullable(F.col("e"), "DROP")).first()[0] == {"a": 2}
    assert df.select(events.map_from_nullable(F.col("e"), "LITERAL", "none")).first()[0] == {"none": 1, "a": 2}
    with pytest.raises(PySparkException, match="map key is null"):
        df.select(events.map_from_nullable(F.col("e"))).collect()
    with pytest.raises(ValueError):
        events.map_from_nullable(F.col("e"), "KEEP")


def test_one_event_many_rows(spark):
    df = payloads(spark, '[{"k": 1}, {"k": 2}]', "[]", None)
    got = events.decode_json_rows(df, "k int", keep=["offset"])
    assert [tuple(r) for r in got.collect()] == [(0, 0, 1), (0, 1, 2)]


def test_previous_timestamp_stays_inside_the_event(spark):
    df = spark.createDataFrame([(0, [5, None, None]), (1, [None, 9])], "offset int, e array<bigint>")
    stamped = events.assign_timestamps(F.col("e"), lambda e, p: F.coalesce(e, p + 1, F.lit(-1)))
    got = df.select("offset", F.explode(stamped).alias("r")).select("offset", "r.ts").collect()
    assert sorted(map(tuple, got)) == [(0, 5), (0, 6), (0, 7), (1, -1), (1, 9)]


def test_avro_is_optional(spark):
    if not events.avro_available(spark):
        pytest.skip("spark-avro is not on the class path")
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    schema = '{"type":"record","name":"r","fields":[{"name":"i","type":["int","null"]},{"name":"s","type":["string","null"]}]}'
    data = df.select(events.encode_avro(F.struct("i", "s"), schema).alias("b"))
    assert tuple(data.select(events.decode_avro(F.col("b"), schema).alias("r")).first().r) == (1, "a")


PRODUCT = "id int, name string, description string, weight decimal(10,3)"


def envelope(op, before=None, after=None, at=0, **extra):
    names = ("id", "name", "description", "weight")
    image = lambda v: None if v is None else dict(zip(names, v))
    source = {"db": "inventory", "table": "products", "ts_ms": at, "pos": 4}
    return json.dumps({"before": image(before), "after": image(after), "source": source, "op": op, "ts_ms": at + 5, **extra})


def product_history():
    """Nine products, two of them changed, two more added and changed, one of those deleted."""
    first = [
        (101, "scooter", "Small 2-wheel scooter", 3.140000104904175),
        (102, "car battery", "12V car battery", 8.100000381469727),
        (103, "12-pack drill bits", "sizes #40 to #3", 0.800000011920929),
        (104, "hammer", "12oz", 0.75),
        (105, "hammer", "14oz", 0.875),
        (106, "hammer", "16oz", 1),
        (107, "rocks", "box of assorted rocks", 5.300000190734863),
        (108, "jacket", "water resistant", 0.10000000149011612),
        (109, "spare tire", "24 inch", 22.200000762939453),
    ]
    history = [envelope("r" if i < 3 else "c", after=p, at=i) for i, p in enumerate(first)]
    hammer, rocks = first[5], first[6]
    history += [
        envelope("u", hammer, (106, "hammer", "18oz", 1)),
        envelope("u", rocks, (107, "rocks", "box of assorted rocks", 5.099999904632568)),
        envelope("c", None, (110, "jacket", "water resistant", 0.20000000298023224)),
        envelope("c", None, (111, "scooter", "Big", 5.179999828338623)),
        envelope("u", (110, "jacket", "water resistant", 0.20000000298023224), (110, "jacket", "new", 0.5)),
        envelope("u", (111, "scooter", "Big", 5.179999828338623), (111, "scooter", "Big", 5.170000076293945)),
        envelope("d", (111, "scooter", "Big", 5.170000076293945), None),
    ]
    return history


def test_debezium_golden_sums_and_table(spark):
    df = payloads(spark, *product_history(), None)
    changes = cdc.debezium_changes(df, PRODUCT, keep=["offset"], metadata=["source.table", "ingestion-timestamp"])
    assert changes.columns[:3] == ["offset", "row_kind", "sub_order"]
    assert changes.columns[-2:] == ["source.table", "ingestion-timestamp"]
    assert changes.count() == 20
    sums = changelog.retracting(
        changes, ["name"], sums={"weight": F.col("weight")}, first={"origin": F.col("`source.table`")}
    )
    assert {(r.origin, r.name, str(r.weight)) for r in sums.collect()} == {
        ("products", n, w)
        for n, w in {
            "scooter": "3.140", "car battery": "8.100", "12-pack drill bits": "0.800", "hammer": "2.625",
            "rocks": "5.100", "jacket": "0.600", "spare tire": "22.200",
        }.items()
    }
    table = changelog.current_table(changes, ["id"], ["id", "name", "description", "weight"])
    rows = {r.id: r for r in table.collect()}
    assert sorted(rows) == list(range(101, 111))
    assert (rows[106].description, str(rows[107].weight), str(rows[110].weight)) == ("18oz", "5.100", "0.500")


def test_debezium_wrapped_and_metadata(spark):
    wrapped = json.dumps({"schema": {}, "payload": json.loads(envelope("c", after=(1, "a", "b", 2), at=1000))})
    got = cdc.debezium_changes(
        payloads(spark, wrapped), PRODUCT, schema_include=True, metadata=list(cdc.DEBEZIUM_METADATA)
    ).select(
        "row_kind", F.unix_millis(F.col("`source.timestamp`")), F.unix_millis(F.col("`ingestion-timestamp`")),
        "`source.database`", "`source.schema`", "`source.properties`",
    ).first()
    assert tuple(got[:5]) == ("+I", 1000, 1005, "inventory", None)
    assert got[5]["pos"] == "4"


def test_debezium_refuses_what_it_does_not_know(spark):
    with pytest.raises(ValueError, match="unknown metadata"):
        cdc.debezium_changes(payloads(spark, "{}"), PRODUCT, metadata=["source.colour"])
    with pytest.raises(PySparkException, match="unknown change operation"):
        cdc.debezium_changes(payloads(spark, envelope("x")), PRODUCT).collect()


def test_canal(spark):
    base = {"database": "inventory", "table": "products", "ts": 7, "pkNames": ["id"], "sqlType": {"id": 4}}
    a = {"id": "1", "name": "a", "description": "x", "weight": "1.5"}
    b = {"id": "2", "name": "b", "description": None, "weight": "2.5"}
    history = [
        {"type": "CREATE", "data": None, "old": None},
        {"type": "INSERT", "data": [a, b], "old": None},
        {"type": "UPDATE", "data": [a | {"weight": "1.75"}, b | {"description": "y"}], "old": [{"weight": "1.5"}, {"description": None}]},
        {"type": "DELETE", "data": [a | {"weight": "1.75"}], "old": None},
    ]
    df = payloads(spark, *[json.dumps(base | h) for h in history])
    got = cdc.canal_changes(df, PRODUCT, keep=["offset"], metadata=["database", "pk-names"])
    rows = [(r.row_kind, r.sub_order, r.id, r.description, str(r.weight)) for r in got.collect()]
    assert rows == [
        ("+I", 0, 1, "x", "1.500"), ("+I", 0, 2, None, "2.500"),
        ("-U", 0, 1, "x", "1.500"), ("+U", 1, 1, "x", "1.750"),
        ("-U", 0, 2, None, "2.500"), ("+U", 1, 2, "y", "2.500"),
        ("-D", 0, 1, "x", "1.750"),
    ]
    assert cdc.canal_changes(df, PRODUCT, table="orders|product").count() == 0
    assert cdc.canal_changes(df, PRODUCT, table="orders|products").count() == 7
    odd = payloads(spark, json.dumps(base | {"type": "TRUNCATE", "data": None}))
    with pytest.raises(PySparkException, match="unknown change type"):
        cdc.canal_changes(odd, PRODUCT).collect()


def test_append_only_guard(spark):
    rows = spark.createDataFrame([("+I", 1)], "row_kind string, v int")
    assert changelog.append_only(rows).count() == 1
    more = rows.unionByName(spark.createDataFrame([("-U", 1)], rows.schema))
    with pytest.raises(PySparkException, match="append-only"):
        changelog.append_only(more).collect()


def test_schema_text():
    row = (
        T.StructType()
        .add("a", T.StringType())
        .add("b", T.BinaryType())
        .add("c", T.DecimalType(38, 18))
        .add("d", T.DateType())
        .add("e", T.TimestampNTZType())
        .add("f", T.ArrayType(T.IntegerType()))
        .add("g", T.MapType(T.StringType(), T.IntegerType()))
        .add("h", T.StructType().add("x", T.BooleanType()))
        .add("i", T.NullType())
    )
    text = json_schema_text(row)
    assert text.startswith('{"title": "Json Schema", "type": "object", "properties": {"a": {"type": "string"}, ')
    assert json.loads(text)["properties"] == {
        "a": {"type": "string"},
        "b": {"type": "string", "contentEncoding": "base64"},
        "c": {"type": "number"},
        "d": {"type": "string", "format": "date"},
        "e": {"type": "string", "format": "date-time"},
        "f": {"type": "array"},
        "g": {"type": "object"},
        "h": {"type": "object", "properties": {"x": {"type": "boolean"}}},
        "i": {"type": "null"},
    }
    with pytest.raises(TypeError):
        json_schema_text(T.StructType().add("v", T.VariantType()))


def test_times_of_day_at_any_depth(spark):
    """JSON text has no type for them: they are written and read as texts."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.sql(
            "SELECT time'12:12:43.5' AS t, array(time'01:02:03', NULL) AS a, named_struct('x', time'10:00:00', 'y', 1) AS s, "
            "map('k', time'10:00:01') AS m UNION ALL SELECT NULL, NULL, NULL, NULL"
        )
        text = df.select(events.encode_json(df, df.columns).alias("payload"))
        assert text.first()[0] == (
            '{"t":"12:12:43.5","a":["01:02:03",null],"s":{"x":"10:00:00","y":1},"m":{"k":"10:00:01"}}'
        )
        again = events.decode_json(text, df.schema)
        assert again.schema["t"].dataType == df.schema["t"].dataType
        assert again.selectExpr("CAST(t AS string)", "CAST(a[0] AS string)", "CAST(s.x AS string)", "s.y").first() == (
            "12:12:43.5", "01:02:03", "10:00:00", 1)
        broken = spark.createDataFrame([('{"t": "25:00:00", "n": 1}',)], "payload string")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            events.decode_json(broken, "t time, n int").collect()
        lax = events.decode_json(broken, "t time, n int", ignore_parse_errors=True)
        assert lax.selectExpr("t IS NULL", "n").first() == (True, 1)
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_encoding_by_the_registered_schema(spark, root):
    from tidemark.sources.catalog import Catalog
    from pyspark.sql import types as T

    catalog = Catalog(spark, root, "s")
    catalog.create_table("t", "old int")
    row = T.StructType.fromDDL("name string, amount decimal(20,12), tags array<string>, place struct<x:int,y:double>, at date")
    catalog.register_schema("t", row)
    df = spark.createDataFrame(
        [(1, "a", "0.000000000001", ["p", None], (1, 2.5), None), (2, None, "12", None, None, "2024-01-02")],
        "id int, name string, amount string, tags array<string>, place struct<x:int,y:double>, at string",
    )
    encoded = catalog.encode(df, "t", keep=["id"])
    assert encoded.columns == ["id", "payload"]
    assert '"amount":0.000000000001' in encoded.filter("id = 1").first().payload
    again = catalog.decode(encoded, "t", keep=["id"]).orderBy("id").collect()
    assert [(r.id, r.name, r.amount, r.tags) for r in again] == [
        (1, "a", decimal.Decimal("0.000000000001"), ["p", None]), (2, None, decimal.Decimal(12), None)]
    assert tuple(again[0].place) == (1, 2.5) and again[1].place is None and str(again[1].at) == "2024-01-02"
    with pytest.raises(ValueError, match="missing"):
        catalog.encode(df.drop("tags"), "t")
    with pytest.raises(ValueError, match="no registered schema"):
        catalog.encode(df, "ghost")
    avro = Catalog(spark, f"{root}/avro", "s", format="avro")
    avro.create_table("t", "name string")
    from tidemark.functions.events import avro_available
    if not avro_available(spark):
        with pytest.raises(ValueError, match="spark-avro"):
            avro.encode(df, "t")
