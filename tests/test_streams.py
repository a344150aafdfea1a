"""Structured Streaming: tailing, resuming, recovery, ordering, metrics."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_event_time import arrivals, replayed
from tidemark.operators import audit
from tidemark.operators.changelog import retracting
from tidemark.sources import cuts, scan
from tidemark.sources.layout import StreamTable
from tidemark.streaming import sinks
from tidemark.streaming.metrics import MetricsListener
from tidemark.streaming.ordering import EventTimeOrdering, hold_until_watermark
from tidemark.streaming.reader import EndOfStream, tail_streams, trigger_for
from tidemark.streaming.sinks import EXACTLY_ONCE, StreamSink
from tidemark.streaming.upserts import UpsertView


@pytest.fixture
def open_table(spark, root):
    return lambda name: StreamTable(spark, root, name)


def integers(spark, count, start=1):
    return spark.range(start, start + count).select(
        F.col("id").cast("int").alias("value"), F.col("id").cast("string").alias("key")
    )


def run(stream, sink, checkpoint, **options):
    sinks.start(stream, sink, checkpoint, available_now=True, **options).awaitTermination()


def values(table):
    return sorted(r.value for r in table.read().collect())


def test_many_streams_are_tailed_as_one_from_their_cuts(spark, open_table, root):
    a, b = open_table("s/a").create("value int"), open_table("t/b").create("value int")
    sinks.append(a, integers(spark, 10), key="key")
    start = cuts.load_cut(a.read(), cuts.tail())
    sinks.append(a, integers(spark, 10, 11), key="key")
    sinks.append(b, integers(spark, 5, 100))
    ranges = scan.stream_ranges(["s/a", "t/b"], [start, ""])
    out = open_table("s/out").create("value int, scope string, stream string")
    stream = tail_streams(ranges, open_table)
    run(stream, StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    rows = {(r.scope, r.stream, r.value) for r in out.read().collect()}
    assert rows == {("s", "a", v) for v in range(11, 21)} | {("t", "b", v) for v in range(100, 105)}
    assert trigger_for(ranges) == {"processingTime": "0 seconds"}
    assert trigger_for(scan.stream_ranges(["s/a"], None, [start])) == {"availableNow": True}


def test_bounded_tail_stops_at_its_cut(spark, open_table, root):
    a, out = open_table("s/a").create("value int"), open_table("s/out").create("value int")
    sinks.append(a, integers(spark, 10), key="key")
    end = cuts.load_cut(a.read(), cuts.tail())
    sinks.append(a, integers(spark, 10, 11), key="key")
    run(scan.scan(a.tail(), end=end), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    assert values(out) == list(range(1, 11))


def test_truncated_files_are_skipped(spark, open_table, root):
    a, out = open_table("s/a").create("value int"), open_table("s/out").create("value int")
    for start in (1, 11, 21):
        sinks.append(a, integers(spark, 10, start))
    run(a.tail(), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    a.truncate_before(3)
    sinks.append(a, integers(spark, 10, 31))
    run(a.tail(), StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp")
    assert values(out) == list(range(1, 41))


def test_without_a_checkpoint_a_restart_begins_at_the_cut(spark, open_table, root):
    a, out = open_table("s/a").create("value int"), open_table("s/out").create("value int")
    sinks.append(a, integers(spark, 10), key="key")
    start = cuts.load_cut(a.read(), cuts.tail())
    sinks.append(a, integers(spark, 10, 11), key="key")
    for attempt in ("first", "second"):
        run(scan.scan(a.tail(), start), StreamSink(out, attempt, EXACTLY_ONCE), f"{root}/cp-{attempt}")
    assert values(out) == sorted(2 * list(range(11, 21)))


def test_end_of_a_live_stream(spark, open_table, root):
    a, out = open_table("s/a").create("value int", 2), open_table("s/out").create("value int", 2)
    checkpoint, state = f"{root}/cp", f"{root}/_eos"
    live = a.tail().withColumnRenamed("segment", "shard").withColumnRenamed("offset", "position")
    live = live.select("value", F.col("shard").alias("segment"), F.col("position").alias("offset"))
    for batch, numbers in enumerate([[1, 2], [3, -1, 4], [5]]):
        rows = spark.createDataFrame([(n, "k") for n in numbers], "value int, key string").coalesce(1)
        sinks.append(a, rows, key="key", keep_arrival=True)
        # A new object each time, as after a restart.
        end = EndOfStream(F.col("value") < 0, state, a.files)
        sink = StreamSink(out, "job", EXACTLY_ONCE)
        run(live, sink, checkpoint, prepare=lambda rows, end=end: end(rows).select("value"))
        assert bool(end.ended) == (batch > 0)
    assert values(out) == [1, 2, 3]


def test_current_table_of_a_live_changelog(spark, root):
    view = UpsertView(f"{root}/view", ["id"], ["id", "name"], snapshot_every=2)
    schema = "offset bigint, sub_order int, row_kind string, id int, name string"
    history = [
        [(0, 0, "+I", 1, "a"), (1, 0, "+I", 2, "b")],
        [(2, 0, "-U", 1, "a"), (2, 1, "+U", 1, "c")],
        [(3, 0, "-D", 2, "b"), (4, 0, "+I", 3, "d")],
        [(5, 0, "+I", 2, "e"), (6, 0, "-D", 3, "d")],
    ]
    states = [{(1, "a"), (2, "b")}, {(1, "c"), (2, "b")}, {(1, "c"), (3, "d")}, {(1, "c"), (2, "e")}]
    for batch, (rows, expected) in enumerate(zip(history, states)):
        for _ in range(2):
            view.write(spark.createDataFrame(rows, schema), batch)
        assert {tuple(r) for r in view.read(spark).collect()} == expected
    again = UpsertView(f"{root}/view", ["id"], ["id", "name"])
    assert {tuple(r) for r in again.read(spark).collect()} == states[-1]


def test_retracting_aggregate_of_a_live_changelog(spark, open_table, root):
    source = open_table("s/in").create("n bigint, sub_order int, row_kind string, name string, weight int")
    schema = source.row_type
    sinks.append(source, spark.createDataFrame([(0, 0, "+I", "a", 5), (1, 0, "+I", "b", 7)], schema))
    totals = retracting(source.tail(), ["name"], sums={"weight": F.col("weight")}, order=("n", "sub_order"))
    query = totals.writeStream.format("memory").queryName("live_totals").outputMode("complete").start()
    try:
        query.processAllAvailable()
        sinks.append(source, spark.createDataFrame([(2, 0, "-U", "a", 5), (2, 1, "+U", "a", 6), (3, 0, "-D", "b", 7)], schema))
        query.processAllAvailable()
        assert {tuple(r) for r in spark.table("live_totals").collect()} == {("a", 6)}
    finally:
        query.stop()


def test_every_value_once_after_a_failure(spark, open_table, root):
    """The job fails after two thirds of the values and is started again."""
    count = 3_000
    source, out = open_table("s/in").create("value int"), open_table("s/out").create("value int")
    for start in range(1, count, 300):
        sinks.append(source, integers(spark, 300, start), key="key", tasks=2)
    armed = {"on": True}

    def fail_once(rows):
        if not armed["on"]:
            return rows
        broken = F.raise_error(F.lit("failed on purpose")).cast("int")
        return rows.withColumn("value", F.when(F.col("value") > count * 2 // 3, broken).otherwise(F.col("value")))

    sink = lambda: StreamSink(out, "job", EXACTLY_ONCE, key="routing_key")
    with pytest.raises(Exception, match="failed on purpose"):
        run(source.tail(2), sink(), f"{root}/cp", prepare=fail_once)
    assert 0 < len(values(out)) < count
    armed["on"] = False
    run(source.tail(2), sink(), f"{root}/cp", prepare=fail_once)
    assert audit.audit_range(out.read(), "value", count).count() == 0


def test_replayed_micro_batch_after_a_lost_checkpoint_entry(spark, open_table, root, monkeypatch):
    """The batch was published but the query stopped before its checkpoint knew."""
    source, out = open_table("s/in").create("value int"), open_table("s/out").create("value int")
    sinks.append(source, integers(spark, 100))
    sink = StreamSink(out, "job", EXACTLY_ONCE)
    written = sink.write

    def write_then_stop(rows, batch_id):
        written(rows, batch_id)
        raise RuntimeError("stopped")

    sink.write = write_then_stop
    with pytest.raises(Exception, match="stopped"):
        run(source.tail(), sink, f"{root}/cp")
    again = StreamSink(out, "job", EXACTLY_ONCE)
    run(source.tail(), again, f"{root}/cp")
    assert again.metrics.replays_skipped == 1
    assert values(out) == list(range(1, 101))


@pytest.mark.parametrize("seed", [0, 3])
def test_ordering_of_a_stream_matches_brute_force(spark, open_table, root, seed):
    rows = arrivals(seed, count=400, epochs=8)
    o, _ = replayed(rows)
    row = "offset_in bigint, key string, t bigint, shard int"
    out = open_table("s/out").create(row, 2)
    sink = StreamSink(out, "job", EXACTLY_ONCE, key="key", order=["t", "offset_in"])
    ordered = EventTimeOrdering(sink, f"{root}/_state", "key", "t", segment="shard", snapshot_every=3)
    df = spark.createDataFrame(rows, "shard int, offset_in bigint, key string, epoch bigint, t bigint")
    for batch, epoch in enumerate(sorted({r[3] for r in rows})):
        part = df.filter(F.col("epoch") == epoch).drop("epoch")
        ordered.write(part, batch)
        if batch % 3 == 1:
            # A replay, and a restart with nothing kept in memory.
            ordered.write(part, batch)
            ordered = EventTimeOrdering(sink, f"{root}/_state", "key", "t", segment="shard", snapshot_every=3)
    ordered.finish()
    kept = out.read().collect()
    assert {r.offset_in for r in kept} == {r[1] for r in rows} - o.dropped
    seen = {}
    for r in sorted(kept, key=lambda r: r.offset):
        # Events without a key are spread over the segments and have no order of their own.
        if r.t is not None and r.key is not None:
            seen.setdefault(r.key, []).append(r.offset_in)
    timed = {r[1] for r in rows if r[4] is not None}
    expected = {}
    for key, tag in o.out:
        if tag in timed and key is not None:
            expected.setdefault(key, []).append(tag)
    assert seen == expected


def test_a_silent_segment_loses_no_rows(spark, open_table, root):
    """Segment 1 pauses for a batch; what it brings afterwards is not late."""
    out = open_table("s/out").create("n bigint, key string, t bigint, shard int", 1)
    sink = StreamSink(out, "job", EXACTLY_ONCE, key="key", order=["t", "n"])
    batches = [[(0, 1, 10), (1, 2, 5)], [(0, 3, 100), (0, 4, 7)], [(1, 5, 6), (1, 6, 8), (0, 7, 101)], [(1, 8, 200)]]
    for batch, rows in enumerate(batches):
        # A new object each time, as after a restart.
        ordered = EventTimeOrdering(sink, f"{root}/_state", "key", "t", segment="shard")
        ordered.write(spark.createDataFrame([(s, n, "k", t) for s, n, t in rows], "shard int, n bigint, key string, t bigint"), batch)
    ordered.finish()
    assert [r.t for r in out.read().orderBy("offset").collect()] == [5, 6, 7, 8, 10, 100, 101, 200]


def test_ordering_survives_a_stop_between_sink_and_state(spark, open_table, root, monkeypatch):
    out = open_table("s/out").create("n bigint, key string, t bigint, shard int", 1)
    sink = StreamSink(out, "job", EXACTLY_ONCE, key="key", order=["t", "n"])
    ordered = EventTimeOrdering(sink, f"{root}/_state", "key", "t", segment="shard")
    first = spark.createDataFrame([(0, 1, "k", 5), (0, 2, "k", 3)], "shard int, n bigint, key string, t bigint")
    with monkeypatch.context() as broken:
        broken.setattr(ordered.files, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            ordered.write(first, 0)
    ordered.write(first, 0)
    ordered.write(first.limit(0), 1)
    ordered.finish()
    assert [r.n for r in out.read().orderBy("offset").collect()] == [2, 1]


def test_ordering_needs_an_ordered_exactly_once_sink(spark, open_table, root):
    out = open_table("s/out").create("t bigint")
    with pytest.raises(ValueError, match="exactly-once"):
        EventTimeOrdering(StreamSink(out, "q", order=["t"]), f"{root}/_state", "key", "t")
    with pytest.raises(ValueError, match="order by"):
        EventTimeOrdering(StreamSink(out, "q", EXACTLY_ONCE), f"{root}/_state", "key", "t")


def test_held_rows_are_released_in_event_time_order(spark, open_table, root):
    """Native form: nothing is late here, so every row the watermark has passed comes out in order."""
    rng = random.Random(5)
    source = open_table("s/in").create("n bigint, k string, at timestamp_ntz", 2)
    out = open_table("s/out").create("n bigint, k string, at timestamp", 2)
    base = 1_700_000_000
    times = [base + 10 * (i // 40) + rng.randrange(10) for i in range(200)] + [base + 1_000]
    rows = [(i, "hot" if i % 3 else f"k{i % 4}", t) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "n bigint, k string, s bigint").select(
        "n", "k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("at")
    )
    for low in (0, 80, 160):
        sinks.append(source, df.filter((F.col("n") >= low) & (F.col("n") < low + 80)), key="k", tasks=1)
    held = hold_until_watermark(source.tail(4).select("n", "k", "at"), "k", "at", "n", "20 seconds")
    sink = StreamSink(out, "job", EXACTLY_ONCE, key="k", order=["at", "n"])
    run(held, sink, f"{root}/cp")
    got = {}
    for r in out.read().orderBy("offset").collect():
        got.setdefault(r.k, []).append(r.n)
    expected = {}
    for n, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if t < base + 1_000 - 20:
            expected.setdefault(k, []).append(n)
    assert got == expected


def test_metrics(spark, open_table, root):
    source, out = open_table("s/in").create("value int"), open_table("s/out").create("value int")
    sinks.append(source, integers(spark, 50))
    listener = MetricsListener()
    spark.streams.addListener(listener)
    try:
        sink = StreamSink(out, "counted", EXACTLY_ONCE)
        run(source.tail(), sink, f"{root}/cp")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert sink.metrics.records_out == 50 and sink.metrics.stream == "s/out"
    progress = listener.queries["counted"]
    assert progress.batches == 1 and progress.rows >= 50 and progress.positions
