"""Streams read by position, and declared tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import tumbling
from tidemark.sources import cuts
from tidemark.sources.catalog import Catalog
from tidemark.sources.declared import Computed, Declaration, Metadata, Physical
from tidemark.sources.layout import EPOCH_BITS, StreamTable
from tidemark.sources.scan import fetch, named
from tidemark.streaming import sinks
from tidemark.streaming.follow import follow, position, run_until_end
from tidemark.streaming.sinks import EXACTLY_ONCE, StreamSink


def integers(spark, count, start=1):
    return spark.range(start, start + count).select(
        F.col("id").cast("int").alias("value"), F.col("id").cast("string").alias("key")
    )


@pytest.fixture
def pair(spark, root):
    return StreamTable(spark, root, "s/in").create("value int"), StreamTable(spark, root, "s/out").create("value int")


def values(table):
    return sorted(r.value for r in table.read().collect())


def up_to(stream, epoch):
    return cuts.Cut({s: epoch << EPOCH_BITS for s in range(stream.segments)})


def run(source, out, root, name="cp", end=None, query_id="q", **options):
    end = source.tail_cut() if end is None else end
    sink = StreamSink(out, query_id, EXACTLY_ONCE)
    query = sinks.start(follow(source, end=end, **options).select("value"), sink, f"{root}/{name}")
    assert run_until_end(query, source, end, uid=options.get("uid"), timeout=90)


def test_a_bounded_read_waits_for_its_end(spark, pair, root):
    source, out = pair
    sinks.append(source, integers(spark, 10))
    end = up_to(source, 4)
    query = sinks.start(follow(source, end=end).select("value"), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    query.processAllAvailable()
    assert not run_until_end(query, source, end, timeout=0)
    assert values(out) == list(range(1, 11))
    query = sinks.start(follow(source, end=end, uid="u").select("value"), StreamSink(out, "r", EXACTLY_ONCE), f"{root}/cp2")
    for start in (11, 21, 31):
        sinks.append(source, integers(spark, 10, start))
    assert run_until_end(query, source, end, uid="u", timeout=90)
    assert sorted(values(out)) == sorted([*range(1, 11), *range(1, 31)])
    assert position(source, "u") == end


def test_rows_admitted_per_trigger(spark, pair, root):
    source, out = pair
    for start in (1, 11, 21, 31, 41):
        sinks.append(source, integers(spark, 10, start))
    run(source, out, root, rows_per_trigger=20)
    sizes = [r.n_rows for r in out.commits().orderBy("batch_id").collect()]
    assert sum(sizes) == 50 and max(sizes) == 20
    assert values(out) == list(range(1, 51))


def test_a_reader_goes_on_by_its_uid(spark, pair, root):
    """A new checkpoint, the same uid: nothing is read twice. The same checkpoint: nothing either."""
    source, out = pair
    sinks.append(source, integers(spark, 10))
    run(source, out, root, "cp1", uid="reader")
    sinks.append(source, integers(spark, 10, 11))
    run(source, out, root, "cp2", uid="reader", query_id="second")
    assert values(out) == list(range(1, 21))
    sinks.append(source, integers(spark, 10, 21))
    run(source, out, root, "cp2", uid="reader", query_id="second", rows_per_trigger=5)
    assert values(out) == list(range(1, 31))
    run(source, out, root, "cp3", uid="another", query_id="third")
    assert len(values(out)) == 60


def test_cuts_inside_an_append(spark, pair, root):
    source, out = pair
    for start in (1, 41):
        sinks.append(source, integers(spark, 40, start), key="key", order=["value"])
    start = cuts.load_cut(source.read(), F.min(F.when(F.col("value") >= 21, F.col("offset"))))
    end = cuts.load_cut(source.read(), F.min(F.when(F.col("value") >= 61, F.col("offset"))))
    run(source, out, root, start=start, end=end)
    assert values(out) == list(range(21, 61))


def test_an_open_epoch_is_waited_for(spark, pair, root):
    """A writer that began earlier and commits later is not overtaken."""
    source, out = pair
    copy = source.prepare(integers(spark, 10))
    claim = source.claim("slow", 0, 1)
    facts = source.stage(copy, claim)
    sinks.append(source, integers(spark, 10, 11))
    end = up_to(source, 3)
    query = sinks.start(follow(source, end=end).select("value"), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    query.processAllAvailable()
    assert not run_until_end(query, source, end, timeout=0)
    assert values(out) == []
    query = sinks.start(follow(source, end=end).select("value"), StreamSink(out, "r", EXACTLY_ONCE), f"{root}/cp2")
    source.publish(claim, facts)
    assert run_until_end(query, source, end, timeout=90)
    assert values(out) == list(range(1, 21))


def test_folded_truncated_and_evolved_streams(spark, root):
    source = StreamTable(spark, root, "s/in").create("value int")
    out = StreamTable(spark, root, "s/out").create("value string, more int")
    for start in (1, 11):
        sinks.append(source, integers(spark, 10, start), key="key", order=["value"])
    source.truncate(cuts.load_cut(source.read(), F.min(F.when(F.col("value") >= 6, F.col("offset")))))
    source.transactions.fold()
    source.evolve(out.row_type)
    rows = integers(spark, 10, 21).select("key", F.col("value").cast("string").alias("value"), F.lit(1).alias("more"))
    sinks.append(source, rows, key="key")
    end = source.tail_cut()
    sink = StreamSink(out, "q", EXACTLY_ONCE)
    query = sinks.start(follow(source, end=end).select("value", "more"), sink, f"{root}/cp")
    assert run_until_end(query, source, end, timeout=90)
    got = sorted((int(r.value), r.more) for r in out.read().collect())
    assert got == [(v, None) for v in range(6, 21)] + [(v, 1) for v in range(21, 31)]


PRICES = [
    ("2.02", "Euro", "00:00:01", "2019-12-12 00:00:01.001001"),
    ("1.11", "US Dollar", "00:00:02", "2019-12-12 00:00:02.002001"),
    ("50", "Yen", "00:00:03", "2019-12-12 00:00:03.004001"),
    ("3.1", "Euro", "00:00:04", "2019-12-12 00:00:04.005001"),
    ("5.33", "US Dollar", "00:00:05", "2019-12-12 00:00:05.006001"),
    ("0", "DUMMY", "00:00:10", "2019-12-12 00:00:10"),
]


def test_declared_prices_in_windows(spark, root):
    """Golden windows over a declared table, as a batch; and its columns in declared order."""
    catalog = Catalog(spark, root, "shop")
    stream = catalog.create_table("prices", "price decimal(38,18), currency string, log_date date, log_time string, log_ts timestamp")
    rows = spark.createDataFrame(PRICES, "price string, currency string, log_time string, log_ts string")
    typed = rows.select(
        F.col("price").cast("decimal(38,18)").alias("price"), "currency", F.to_date(F.lit("2019-12-12")).alias("log_date"),
        "log_time", F.date_trunc("MILLISECOND", F.col("log_ts").cast("timestamp")).alias("log_ts"),
    )
    sinks.append(stream, typed, key="currency")
    declaration = Declaration(
        [
            Computed("computed-price", "price + 1.0"), Physical("price", "decimal(38,18)"), Physical("currency", "string"),
            Physical("log_date", "date"), Physical("log_time", "string"), Physical("log_ts", "timestamp"),
            Computed("ts", "log_ts + INTERVAL 1 SECOND"),
        ],
        watermark="ts",
    )
    table = catalog.open({"scan.streams": "prices", "scan.execution.type": "batch"}, declaration)
    assert table.columns == ["computed-price", "price", "currency", "log_date", "log_time", "log_ts", "ts"]
    got = tumbling(
        table.filter("currency <> 'DUMMY'"), "ts", "5 seconds", max_time=F.max("log_time"), max_ts=F.max("ts"),
        n=F.count(F.lit(1)), max_price=F.max("price").cast("decimal(10,2)"),
    ).orderBy("window_end").collect()
    assert [(r.max_time, r.n, str(r.max_price)) for r in got] == [("00:00:03", 3, "50.00"), ("00:00:05", 2, "5.33")]
    assert declaration.written() == ["price", "currency", "log_date", "log_time", "log_ts"]
    # The live table carries the watermark: a window closes when the DUMMY row has passed it.
    live = catalog.open({"scan.streams": "prices"}, declaration)
    assert live.isStreaming and "EventTimeWatermark" in live._jdf.queryExecution().analyzed().toString()


def test_declared_pointer_fetches_its_row(spark, root):
    catalog = Catalog(spark, root, "s")
    stream = catalog.create_table("users", "name string, phone int, vip boolean")
    people = [("jack", 888888, False), ("pony", 10000, True), ("yiming", 12345678, False)]
    declaration = Declaration([
        Physical("name", "string"), Physical("phone", "int"), Metadata("event_pointer", "event_pointer"), Physical("vip", "boolean"),
    ])
    rows = spark.createDataFrame([(n, p, None, v) for n, p, v in people], "name string, phone int, event_pointer binary, vip boolean")
    sinks.append(stream, declaration.to_write(rows), key="name")
    table = catalog.open({"scan.streams": "users", "scan.execution.type": "batch"}, declaration)
    assert table.columns == ["name", "phone", "event_pointer", "vip"]
    assert {(r.name, r.phone, r.vip) for r in table.collect()} == set(people)
    found = fetch(named(stream.read(), stream.name), table.filter("vip").select("event_pointer"))
    assert [r.name for r in found.collect()] == ["pony"]


def test_declarations_are_checked(spark, root):
    log = spark.createDataFrame([(1, "x")], "a int, b string")
    # A quoted text may hold the name of a column.
    full = Declaration([Computed("c", "d * 2"), Computed("d", "a + 1"), Physical("a", "bigint"),
                        Computed("t", "concat('c d', b)"), Physical("b", "string")])
    assert tuple(full.read(log).first()) == (4, 2, 1, "c dx", "x")
    with pytest.raises(ValueError, match="each other"):
        Declaration([Computed("c", "d + 1"), Computed("d", "c + 1")]).read(log)
    with pytest.raises(ValueError, match="twice"):
        Declaration([Physical("a", "int"), Computed("A", "1")])
    with pytest.raises(ValueError, match="metadata key"):
        Declaration([Metadata("m", "ghost")])
    with pytest.raises(ValueError, match="watermark"):
        Declaration([Physical("a", "int")], watermark="t")
    with pytest.raises(ValueError, match="not stored"):
        Declaration([Physical("ghost", "int")]).read(log)


def test_following_a_declared_table(spark, root):
    catalog = Catalog(spark, root, "s")
    stream, out = catalog.create_table("a", "value int"), StreamTable(spark, root, "s/out").create("value int, twice int")
    sinks.append(stream, integers(spark, 10))
    declaration = Declaration([Physical("value", "int"), Computed("twice", "value * 2")])
    end = stream.tail_cut()
    options = {"scan.streams": "a", "scan.uid": "reader", "scan.end-streamcuts": end.text(), "scan.max-rows-per-trigger": "4"}
    query = sinks.start(catalog.follow(options, declaration), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    assert run_until_end(query, stream, end, uid="reader", timeout=90)
    assert {(r.value, r.twice) for r in out.read().collect()} == {(v, 2 * v) for v in range(1, 11)}
    with pytest.raises(ValueError, match="one stream"):
        catalog.follow({"scan.streams": "a;b"})
