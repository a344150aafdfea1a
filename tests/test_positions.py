"""Names, cuts, scans and pointers."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import cuts, scan
from tidemark.sources.cuts import Cut
from tidemark.sources.names import StreamName, resolve, split_name
from tidemark.sources.options import scan_options, sink_options


def log_of(spark, rows):
    return spark.createDataFrame(
        rows, "segment int, offset bigint, payload string, routing_key string"
    )


def grid(spark, segments, count):
    return spark.range(segments * count).select(
        (F.col("id") % segments).cast("int").alias("segment"),
        F.floor(F.col("id") / segments).alias("offset"),
        F.concat(F.lit("e"), "id").alias("payload"),
        F.col("id").cast("string").alias("routing_key"),
    )


def test_names():
    assert resolve("a/b") == StreamName("a", "b")
    assert resolve("a/b/c") == StreamName("a", "b/c")
    assert resolve("b", "a") == StreamName("a", "b")
    assert resolve("x/b", "a") == StreamName("x", "b")
    for bad in ("b", "/b", "a/"):
        with pytest.raises(ValueError):
            resolve(bad)


def test_split_name_column(spark):
    rows = spark.createDataFrame([("a/b/c",), ("b",)], "n string")
    got = [tuple(r.s) for r in rows.select(split_name(F.col("n"), "d").alias("s")).collect()]
    assert got == [("a", "b/c"), ("d", "b")]


def test_cut_text():
    cut = Cut({3: 7, 1: 2**60})
    assert Cut.parse(cut.text()) == cut
    assert Cut.parse(cuts.UNBOUNDED_TEXT) is cuts.UNBOUNDED
    for bad in ("%%%", "bm90IGpzb24="):
        with pytest.raises(ValueError):
            Cut.parse(bad)


def test_cut_text_agrees_between_column_and_python(spark):
    cut = Cut({s: s * 1_000_003 for s in range(40)})
    text = cuts.cut_text(cut.table(spark)).first()["cut_text"]
    assert text == cut.text()
    parsed = spark.createDataFrame([(text,)], "t string").select(cuts.parse_cut_text(F.col("t"))).first()[0]
    assert Cut(parsed) == cut


@pytest.mark.parametrize("segments", [3, 100])
def test_scan_between_cuts_as_filter_and_as_join(spark, segments):
    log = grid(spark, segments, 20)
    low, high = Cut({s: s % 7 for s in range(segments)}), Cut({s: 10 + s % 5 for s in range(segments)})
    got = {(r.segment, r.offset) for r in scan.scan(log, low, high).collect()}
    assert got == {(s, o) for s in range(segments) for o in range(s % 7, 10 + s % 5)}
    assert scan.scan(log).count() == segments * 20
    # A second pass gives the same events.
    assert {(r.segment, r.offset) for r in scan.scan(log, low, high).collect()} == got


@pytest.mark.parametrize("extra", [0, 80])
def test_segments_the_cut_does_not_name(spark, extra):
    log = grid(spark, 3, 4)
    named = {1: 2} | {100 + i: 0 for i in range(extra)}
    assert {(r.segment, r.offset) for r in cuts.after(log, Cut(named)).collect()} == {
        (s, o) for s in range(3) for o in range(4) if s != 1 or o >= 2
    }
    assert {(r.segment, r.offset) for r in cuts.before(log, Cut(named)).collect()} == {(1, 0), (1, 1)}
    assert cuts.before(log, Cut(named), open_segments=True).count() == 10
    assert cuts.after(log, Cut(named), strict_segments=True).count() == 2


def test_empty_cut(spark):
    log = grid(spark, 2, 3)
    assert cuts.before(log, Cut()).count() == 0
    assert cuts.after(log, Cut()).count() == 6


def test_head_tail_and_backlog(spark):
    log = log_of(spark, [(0, 5, "abc", "k"), (0, 9, "é", "k"), (1, 2, "x", "k")])
    assert cuts.load_cut(log, cuts.head()) == {0: 5, 1: 2}
    assert cuts.load_cut(log, cuts.tail()) == {0: 10, 1: 3}
    left = cuts.backlog(log, Cut({0: 6, 1: 3})).first()
    assert (left.unread_events, left.unread_bytes) == (1, 2)


def test_truncated_start_moves_forward(spark):
    log = grid(spark, 2, 10).filter("offset >= 4")
    got = {(r.segment, r.offset) for r in scan.scan_untruncated(log, Cut({0: 1, 1: 6})).collect()}
    assert got == {(0, o) for o in range(4, 10)} | {(1, o) for o in range(6, 10)}


def test_end_of_stream_marker(spark):
    rows = [(0, 1, "a", "k"), (0, 2, "EOS", "k"), (0, 3, "b", "k"), (0, 4, "EOS", "k"), (1, 1, "c", "k"), (1, 9, "d", "k")]
    got = scan.until_marker(log_of(spark, rows), F.col("payload") == "EOS")
    assert {r.payload for r in got.collect()} == {"a", "c", "d"}


def test_many_streams_as_one(spark):
    logs = {"a/x": grid(spark, 3, 100), "b/y": grid(spark, 5, 60)}
    ranges = scan.stream_ranges(["a/x", "y"], [cuts.UNBOUNDED_TEXT, Cut({s: 50 for s in range(5)}).text()], None, "b")
    got = scan.read_streams(ranges, scan.local_streams(logs)).groupBy("scope", "stream").count().collect()
    assert {tuple(r) for r in got} == {("a", "x", 300), ("b", "y", 50)}
    with pytest.raises(ValueError, match="no stream"):
        scan.read_streams(scan.stream_ranges(["c/z"]), scan.local_streams(logs))


def test_cut_lists_match_streams():
    with pytest.raises(ValueError, match="1 start cuts for 2 streams"):
        scan.stream_ranges(["a/x", "a/y"], [""])
    with pytest.raises(ValueError, match="3 end cuts for 2 streams"):
        scan.stream_ranges(["a/x", "a/y"], None, ["", "", ""])
    with pytest.raises(ValueError):
        scan.stream_ranges([])


def test_bounded_only_when_every_stream_ends():
    end = Cut({0: 3})
    assert scan.is_bounded(scan.stream_ranges(["a/x", "a/y"], None, [end, end]))
    assert not scan.is_bounded(scan.stream_ranges(["a/x", "a/y"], None, [end, ""]))
    assert not scan.is_bounded(scan.stream_ranges(["a/x"]))


def test_pointer_roundtrip_and_declared_order(spark):
    people = [("jack", 888888, False), ("pony", 10000, True), ("yiming", 12345678, False)]
    rows = [(i % 2, i, *p) for i, p in enumerate(people)]
    log = scan.named(
        spark.createDataFrame(rows, "segment int, offset bigint, name string, phone int, vip boolean"),
        StreamName("s", "users"),
    )
    seen = scan.with_metadata(
        log, ["name", "phone", "vip"], {"event_pointer": scan.event_pointer()},
        order=["name", "phone", "event_pointer", "vip"],
    )
    assert seen.columns == ["name", "phone", "event_pointer", "vip"]
    assert seen.schema["event_pointer"].dataType.simpleString() == "binary"
    for name, phone, vip in people:
        back = scan.fetch(log, seen.filter(F.col("name") == name)).collect()
        assert [(r.name, r.phone, r.vip) for r in back] == [(name, phone, vip)]
    with pytest.raises(ValueError, match="unknown columns"):
        scan.with_metadata(log, ["name"], {}, order=["name", "ghost"])


def test_scan_options():
    options = {"scope": "s", "scan.streams": "a;t/b", "scan.end-streamcuts": f"{Cut({0: 1}).text()};"}
    declared = scan_options(options)
    assert [str(r.name) for r in declared.ranges] == ["s/a", "t/b"]
    assert declared.streaming and not declared.bounded and declared.uid == "s/a+t/b"
    assert scan_options(options | {"scan.execution.type": "batch"}).bounded
    for change in (
        {"scan.execution.type": "sometimes"},
        {"scan.streams": ""},
        {"scan.start-streamcuts": "x"},
        {"scan.max-files-per-trigger": "0"},
        {"scan.typo": "1"},
    ):
        with pytest.raises(ValueError):
            scan_options(options | change)


def test_sink_options():
    declared = sink_options({"scope": "s", "sink.stream": "a", "sink.routing-key.field.name": "k"})
    assert (str(declared.stream), declared.semantic, declared.routing_key) == ("s/a", "at-least-once", "k")
    for bad in ({}, {"sink.stream": "a"}, {"sink.stream": "s/a", "sink.semantic": "maybe"}):
        with pytest.raises(ValueError):
            sink_options(bad)
