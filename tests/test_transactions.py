"""Transactions of stream tables: recovery, folding, the index of positions, truncation, row-type versions."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import cuts
from tidemark.sources.catalog import Catalog
from tidemark.sources.commits import first_unsettled, joined
from tidemark.sources.layout import EPOCH_BITS, StreamTable
from tidemark.streaming import sinks
from tidemark.streaming.sinks import AT_LEAST_ONCE, EXACTLY_ONCE, StreamSink, WatermarkNotes


def integers(spark, count, start=1):
    return spark.range(start, start + count).select(
        F.col("id").cast("int").alias("value"), (F.col("id") % 7).cast("string").alias("key")
    )


@pytest.fixture
def stream(spark, root):
    return StreamTable(spark, root, "numbers", "s").create("value int, key string", segments=4)


def values(stream):
    return sorted(r.value for r in stream.read().collect())


def copies(spark):
    return glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/tidemark/batch-*")


def leftovers(stream):
    """Staged epochs, and claims that are neither an exactly-once query's nor needed for the next number."""
    staged = glob.glob(f"{stream.folder}/staging/ingest_epoch=*")
    return staged + stream.transactions.open_epochs()


def half_done(stream, rows, query, batch, published):
    """What a driver leaves behind that is lost in a transaction."""
    copy = stream.prepare(rows)
    claim = stream.claim(query, batch, 1)
    facts = stream.stage(copy, claim)
    stream.discard(copy)
    if published:
        stream.reveal(claim)
    return claim, facts


def test_no_copy_of_a_batch_stays(spark, stream):
    before = set(copies(spark))
    for batch in range(3):
        StreamSink(stream, "q", EXACTLY_ONCE).write(integers(spark, 10), batch)
        StreamSink(stream, "r", AT_LEAST_ONCE).write(integers(spark, 10), batch)
    broken = integers(spark, 3).withColumn("value", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        StreamSink(stream, "q", EXACTLY_ONCE).write(broken, 3)
    assert set(copies(spark)) == before
    assert leftovers(stream) == []
    # Attempts of at-least-once leave no claims.
    assert not glob.glob(f"{stream.folder}/claims/r-*")


def test_recovery_settles_what_a_lost_driver_left(spark, stream):
    half_done(stream, integers(spark, 5), "q", 0, published=True)
    lost, _ = half_done(stream, integers(spark, 5, 6), "q", 1, published=False)
    other, _ = half_done(stream, integers(spark, 5, 50), "other", 0, published=False)
    assert stream.transactions.open_epochs() == [1, 2, 3] and stream.transactions.frontier() == 1
    sink = StreamSink(stream, "q", EXACTLY_ONCE)
    for batch in range(3):
        sink.write(integers(spark, 5, 1 + 5 * batch), batch)
    assert sink.metrics.replays_skipped == 1
    assert values(stream) == list(range(1, 16))
    assert stream.transactions.state(lost) == "aborted"
    assert [(r.batch_id, r.n_rows) for r in stream.commits().orderBy("batch_id").collect()] == [(0, 5), (1, 5), (2, 5)]
    # Another query's transaction is its own business.
    assert stream.transactions.open_epochs() == [other.epoch]
    assert stream.recover("other") == {"committed": 0, "aborted": 1}
    assert leftovers(stream) == []


def test_an_aborted_epoch_cannot_be_published(spark, stream):
    claim, facts = half_done(stream, integers(spark, 5), "q", 0, published=False)
    assert stream.recover("q") == {"committed": 0, "aborted": 1}
    with pytest.raises(RuntimeError, match="aborted"):
        stream.publish(claim, facts)
    assert values(stream) == []


def test_attempts_of_at_least_once_are_recovered(spark, stream):
    name = "job-" + "a" * 32
    half_done(stream, integers(spark, 5), name, 0, published=True)
    half_done(stream, integers(spark, 5), name, 1, published=False)
    half_done(stream, integers(spark, 5), "job-two", 0, published=False)
    StreamSink(stream, "job", AT_LEAST_ONCE).write(integers(spark, 5, 6), 1)
    assert values(stream) == list(range(1, 11))
    assert [stream.transactions.owner(e).query_id for e in stream.transactions.open_epochs()] == ["job-two"]


def test_folded_log_still_knows_everything(spark, stream):
    sink = StreamSink(stream, "q", EXACTLY_ONCE)
    for batch in range(4):
        sink.write(integers(spark, 3, 1 + 3 * batch), batch)
    before = sorted(map(tuple, stream.commits().select("batch_id", "ingest_epoch", "n_rows").collect()))
    spans = sorted(map(tuple, stream.positions().collect()))
    assert stream.transactions.fold() == 5
    sink.write(integers(spark, 3, 13), 4)
    assert stream.transactions.fold() == 6
    assert stream.transactions.fold() == 6
    again = StreamSink(StreamTable(spark, os.path.dirname(os.path.dirname(stream.folder)), "s/numbers"), "q", EXACTLY_ONCE)
    for batch in range(5):
        again.write(integers(spark, 3, 1 + 3 * batch), batch)
    assert again.metrics.replays_skipped == 5 and values(stream) == list(range(1, 16))
    again.write(integers(spark, 1, 16), 5)
    after = sorted(map(tuple, stream.commits().select("batch_id", "ingest_epoch", "n_rows").collect()))
    assert after[:4] == before and [a[0] for a in after] == [0, 1, 2, 3, 4, 5]
    assert set(spans) < set(map(tuple, stream.positions().collect()))
    # Entries and claims of the first fold are gone.
    assert len(os.listdir(f"{stream.folder}/commits")) == 2
    assert [n for n in os.listdir(f"{stream.folder}/claims/q") if not n.startswith(("done-", "."))] == ["5.json"]
    assert stream.transactions.frontier() == 7


def test_ranges_and_frontiers():
    assert joined([[5, 5], [1, 1], [2, 2], [3, 3], [9, 12], [10, 10]]) == [[1, 3], [5, 5], [9, 12]]
    assert first_unsettled([], set(), 1) == 1
    assert first_unsettled([1, 2, 3], {1, 3}, 1) == 2
    assert first_unsettled([1, 2, 3], {1, 2, 3}, 1) == 4
    assert first_unsettled([7], set(range(5, 7)), 5) == 7
    assert first_unsettled([9], {9}, 10) == 10


@pytest.mark.parametrize("segments", [3, 70])
def test_positions_match_the_events(spark, root, segments):
    stream = StreamTable(spark, root, "s/many").create("value int, note string", segments)
    for batch in range(3):
        rows = integers(spark, 200, 1 + 200 * batch).withColumn("note", F.when(F.col("value") % 2 == 0, F.repeat(F.lit("é"), F.col("value") % 5)))
        sinks.append(stream, rows, key="key")
    events = stream.read()
    size = F.sum(F.coalesce(F.octet_length("note"), F.lit(0)))
    wanted = events.groupBy("ingest_epoch", "segment").agg(
        F.min("offset"), F.max("offset"), F.count(F.lit(1)), size).collect()
    assert sorted(map(tuple, stream.positions().collect())) == sorted(map(tuple, wanted))
    assert stream.tail_cut() == cuts.load_cut(events, cuts.tail())
    assert stream.head_cut() == cuts.load_cut(events, cuts.head())
    plan = stream.positions()._jdf.queryExecution().executedPlan().toString()
    assert "ingest_epoch=" not in plan and "/data" not in plan
    rng = random.Random(segments)
    offsets = sorted(r.offset for r in events.select("offset").collect())
    for _ in range(3):
        cut = cuts.Cut({s: rng.choice(offsets) + rng.randrange(2) for s in range(segments - 1)})
        unread = cuts.after(events, cut).groupBy("segment").agg(F.count(F.lit(1)), size).collect()
        assert sorted(map(tuple, stream.backlog(cut).collect())) == sorted(map(tuple, unread))
        between = cuts.after(events, cut).select("ingest_epoch", "segment").distinct().collect()
        found = stream.epochs_between(cut).select("ingest_epoch", "segment").collect()
        assert set(map(tuple, between)) <= set(map(tuple, found))


def test_the_tail_waits_for_open_epochs(spark, stream):
    sinks.append(stream, integers(spark, 5), key="key")
    claim, facts = half_done(stream, integers(spark, 5, 6), "slow", 0, published=False)
    sinks.append(stream, integers(spark, 5, 11), key="key")
    tail = stream.tail_cut()
    assert max(tail.values()) < claim.epoch << EPOCH_BITS
    stream.publish(claim, facts)
    # Nothing was committed before the cut in the meantime.
    assert sorted(r.value for r in cuts.before(stream.read(), tail, open_segments=False).collect()) == [1, 2, 3, 4, 5]
    assert max(stream.tail_cut().values()) > 3 << EPOCH_BITS


def test_truncation_in_the_middle_of_an_append(spark, root):
    stream = StreamTable(spark, root, "s/x").create("value int, key string", 2)
    for batch in range(3):
        sinks.append(stream, integers(spark, 40, 1 + 40 * batch), key="key", order=["value"])
    cut = cuts.load_cut(stream.read(), F.min(F.when(F.col("value") >= 61, F.col("offset"))))
    stream.truncate(cut)
    assert values(stream) == list(range(61, 121))
    assert stream.head_cut() == cut
    # The first append is gone from the disk, the second only filtered.
    assert {os.path.basename(p) for p in glob.glob(f"{stream.data}/*")} == {"ingest_epoch=2", "ingest_epoch=3"}
    assert sum(r.unread_events for r in stream.backlog(None).collect()) == 60
    # A truncation never goes back.
    stream.truncate(cuts.Cut({0: 0}))
    assert values(stream) == list(range(61, 121))
    out = StreamTable(spark, root, "s/out").create("value int")
    sink = StreamSink(out, "q", EXACTLY_ONCE)
    sinks.start(stream.tail().select("value"), sink, f"{root}/cp", available_now=True).awaitTermination()
    assert values(out) == list(range(61, 121))


def test_changed_types_are_cast(spark, root):
    catalog = Catalog(spark, root, "s")
    stream = catalog.create_table("t", "a int, b struct<x:int,y:string>, c array<int>, d map<string,int>, gone string")
    old = T.StructType.fromDDL("a int, b struct<x:int,y:string>, c array<int>, d map<string,int>, gone string")
    sinks.append(stream, spark.createDataFrame([(1, (2, "y"), [3], {"k": 4}, "g"), (None, None, None, None, None)], old))
    new = T.StructType.fromDDL("a string, b struct<y:string,x:bigint,z:date>, c array<string>, d map<string,double>, e int")
    assert catalog.register_schema("t", new) == 1
    sinks.append(catalog.stream("t"), spark.createDataFrame([("w", ("q", 5, None), ["r"], {"m": 1.5}, 7)], new))
    rows = catalog.open({"scan.streams": "t", "scan.execution.type": "batch"}).orderBy("a").collect()
    assert rows[0].a is None and rows[0].b is None and rows[0].c is None
    assert (rows[1].a, tuple(rows[1].b), rows[1].c, rows[1].d, rows[1].e) == ("1", ("y", 2, None), ["3"], {"k": 4.0}, None)
    assert (rows[2].a, tuple(rows[2].b), rows[2].e) == ("w", ("q", 5, None), 7)
    live = catalog.open({"scan.streams": "t"}).select("a", "e")
    out = StreamTable(spark, root, "s/out").create("a string, e int")
    sinks.start(live, StreamSink(out, "q", EXACTLY_ONCE), f"{root}/cp", available_now=True).awaitTermination()
    assert {(r.a, r.e) for r in out.read().collect()} == {(None, None), ("1", None), ("w", 7)}
    # The same row type again is no new version of the files.
    assert catalog.stream("t").evolve(new) == 1


def test_a_value_the_new_type_cannot_hold_fails(spark, root):
    catalog = Catalog(spark, root, "s")
    stream = catalog.create_table("t", "a string")
    sinks.insert_into(stream, "VALUES ('12'), ('word')")
    catalog.register_schema("t", T.StructType.fromDDL("a int"))
    read = catalog.stream("t").read()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read.collect()


def test_watermark_in_force_is_noted_by_its_rule(spark, root):
    """Against the rule in plain Python, with silent segments, restarts and a row far ahead."""
    rng = random.Random(2)
    stream = StreamTable(spark, root, "s/x").create("at bigint, shard int")
    newest, in_force, noted, expected = {}, None, None, []
    for batch in range(12):
        shards = rng.sample(range(3), rng.randrange(1, 4))
        rows = [(batch * 10 + rng.randrange(30) + (500 if batch == 4 and i == 0 else 0), rng.choice(shards)) for i in range(5)]
        sink = StreamSink(stream, "q", EXACTLY_ONCE, event_time="at", marks=WatermarkNotes("shard", delay_micros=3))
        if batch % 2:
            sink.write(spark.createDataFrame(rows, "at bigint, shard int"), batch)
            sink.write(spark.createDataFrame(rows, "at bigint, shard int"), batch)
        else:
            sink.write(spark.createDataFrame(rows, "at bigint, shard int"), batch)
        mark = None
        if in_force is not None and max(r[0] for r in rows) >= in_force and (noted is None or in_force > noted):
            mark = noted = in_force
        expected.append((batch, mark))
        for at, shard in rows:
            newest[shard] = max(at, newest.get(shard, at))
        bound = min(newest.values()) - 3
        in_force = bound if in_force is None else max(in_force, bound)
    assert sorted(map(tuple, stream.commits().select("batch_id", "watermark").collect())) == expected
    assert sum(m is not None for _, m in expected) >= 4


def test_log_entries_are_plain_json(spark, stream):
    sinks.append(stream, integers(spark, 5), key="key")
    entry = json.loads(open(glob.glob(f"{stream.folder}/commits/*.json")[0]).read())
    assert entry["state"] == "committed" and entry["n_rows"] == 5
    assert sum(s["n_rows"] for s in entry["segments"]) == 5
