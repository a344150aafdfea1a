"""Stream tables: appends, delivery guarantees, order, the catalog."""

import glob
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, routing
from tidemark.sources import cuts
from tidemark.sources.catalog import Catalog
from tidemark.sources.layout import ROWS_PER_TASK, TASKS_PER_EPOCH, StreamTable
from tidemark.streaming import sinks
from tidemark.streaming.sinks import AT_LEAST_ONCE, BEST_EFFORT, EXACTLY_ONCE, StreamSink


def integers(spark, count, start=1):
    return spark.range(start, start + count).select(
        F.col("id").cast("int").alias("value"), (F.col("id") % 7).cast("string").alias("key")
    )


@pytest.fixture
def stream(spark, root):
    return StreamTable(spark, root, "numbers", "s").create("value int, key string", segments=4)


def values(stream):
    return sorted(r.value for r in stream.read().collect())


def test_append_and_read_back(spark, stream):
    metrics = sinks.append(stream, integers(spark, 300), key="key", tasks=3)
    assert metrics.records_out == 300
    sinks.append(stream, integers(spark, 100, 301))
    assert values(stream) == list(range(1, 401))
    rows = stream.read()
    assert rows.columns == ["offset", "routing_key", "value", "key", "ingest_epoch", "segment"]
    assert rows.select("segment", "offset").distinct().count() == 400
    keyed = rows.filter("routing_key IS NOT NULL").groupBy("routing_key").agg(F.count_distinct("segment").alias("n"))
    assert {r.n for r in keyed.collect()} == {1}
    assert rows.filter("routing_key IS NULL").select("segment").distinct().count() == 4
    assert {r.n_rows for r in stream.commits().collect()} == {100, 300}


def test_offsets_of_later_appends_lie_beyond_the_tail(spark, stream):
    sinks.append(stream, integers(spark, 50), key="key")
    cut = cuts.load_cut(stream.read(), cuts.tail())
    sinks.append(stream, integers(spark, 50, 51), key="key")
    assert sorted(r.value for r in cuts.after(stream.read(), cut).collect()) == list(range(51, 101))
    assert sorted(r.value for r in cuts.before(stream.read(), cut).collect()) == list(range(1, 51))


def test_arrival_order_is_kept_inside_a_task(spark, stream):
    sinks.append(stream, integers(spark, 1_000).coalesce(1), key="key", keep_arrival=True, tasks=5)
    for key in range(7):
        rows = stream.read().filter(F.col("routing_key") == str(key)).orderBy("offset").collect()
        assert [r.value for r in rows] == sorted(r.value for r in rows)


def test_hot_key_spans_write_tasks(spark, stream):
    rows = spark.range(4_000).select(
        (F.col("id") * 7919 % 4_000).cast("int").alias("value"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
    )
    sinks.append(stream, rows, key="key", order=["value"], tasks=8)
    hot = stream.read().filter("key = 'hot'").withColumn("file", F.input_file_name())
    assert hot.select("file").distinct().count() > 3
    ordered = [r.value for r in hot.orderBy("offset").collect()]
    assert ordered == sorted(ordered)


def test_hot_segment_spans_write_tasks_without_any_order(spark, root):
    stream = StreamTable(spark, root, "s/many").create("value bigint", 50)
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(20_000).select(F.col("id").alias("value"), key.alias("key"))
    sinks.append(stream, rows, key="key", tasks=8)
    files = stream.read().withColumn("file", F.input_file_name())
    assert files.count() == files.select("segment", "offset").distinct().count() == 20_000
    hot = files.filter("routing_key = 'hot'").groupBy("file").count()
    assert hot.count() >= 6 and hot.agg(F.max("count")).first()[0] < 5_000
    assert files.select("file").distinct().count() < 8 * 50 / 2


def test_write_in_event_time_order(spark, root):
    stream = StreamTable(spark, root, "s/timed").create("at bigint, n bigint", 3)
    rows = spark.range(2_000).select(
        (F.col("id") * 37 % 101).alias("at"), F.col("id").alias("n"), (F.col("id") % 5).cast("string").alias("key")
    )
    metrics = sinks.append_in_event_time_order(stream, rows, "key", "at", "n", tasks=6)
    assert metrics.watermark == 100
    for key in range(5):
        got = [(r.at, r.n) for r in stream.read().filter(F.col("routing_key") == str(key)).orderBy("offset").collect()]
        assert len(got) == 400 and got == sorted(got)


@pytest.mark.parametrize("order", [None, ["value"]])
@pytest.mark.parametrize("keep_arrival", [True, False])
def test_files_hold_one_segment_in_offset_order(spark, stream, order, keep_arrival):
    sinks.append(stream, integers(spark, 3_000), key="key", order=order, keep_arrival=keep_arrival, tasks=5)
    spans = {}
    for name in glob.glob(f"{stream.data}/**/*.parquet", recursive=True):
        offsets = pq.ParquetFile(name).read(["offset"])["offset"].to_pylist()
        assert offsets == sorted(offsets)
        spans.setdefault(name.split("segment=")[1][0], []).append((offsets[0], offsets[-1]))
    # Ranges of offsets of one segment's files do not overlap, so a cut skips whole files.
    for files in spans.values():
        files.sort()
        assert all(a[1] < b[0] for a, b in zip(files, files[1:]))


def test_replay_is_written_once(spark, stream):
    sink = StreamSink(stream, "q", EXACTLY_ONCE, key="key")
    for batch in (0, 1, 1, 0, 2):
        sink.write(integers(spark, 10, 1 + 10 * batch), batch)
    assert values(stream) == list(range(1, 31))
    assert (sink.metrics.records_out, sink.metrics.replays_skipped) == (30, 2)
    again = StreamSink(stream, "q", EXACTLY_ONCE, key="key")
    again.write(integers(spark, 10, 21), 2)
    assert again.metrics.replays_skipped == 1
    assert values(stream) == list(range(1, 31))
    # Another query has batches of its own.
    StreamSink(stream, "other", EXACTLY_ONCE).write(integers(spark, 5, 31), 0)
    assert values(stream) == list(range(1, 36))


def test_failure_between_staging_and_publishing(spark, stream, monkeypatch):
    sink = StreamSink(stream, "q", EXACTLY_ONCE)
    with monkeypatch.context() as broken:
        broken.setattr(stream, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sink.write(integers(spark, 10), 0)
    assert sink.metrics.batches_failed == 1
    assert values(stream) == []
    sink.write(integers(spark, 10), 0)
    assert values(stream) == list(range(1, 11))
    assert stream.commits().count() == 1


def test_failure_between_publishing_and_logging(spark, root, monkeypatch):
    stream = StreamTable(spark, root, "s/x").create("value int, at bigint")
    rows = integers(spark, 10).select("value", F.col("value").cast("bigint").alias("at"))
    sink = StreamSink(stream, "q", EXACTLY_ONCE, event_time="at", delay_micros=2)
    with monkeypatch.context() as broken:
        broken.setattr(stream, "log", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sink.write(rows, 0)
    sink.write(rows, 0)
    assert values(stream) == list(range(1, 11))
    assert [(r.n_rows, r.watermark) for r in stream.commits().collect()] == [(10, 8)]


def test_at_least_once_may_repeat_and_best_effort_may_lose(spark, stream):
    sink = StreamSink(stream, "a", AT_LEAST_ONCE)
    sink.write(integers(spark, 3), 0)
    sink.write(integers(spark, 3), 0)
    assert values(stream) == [1, 1, 2, 2, 3, 3]
    broken = integers(spark, 3).withColumn("value", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        sink.write(broken, 1)
    lossy = StreamSink(stream, "b", BEST_EFFORT)
    lossy.write(broken, 0)
    assert lossy.metrics.batches_failed == 1
    assert len(values(stream)) == 6
    with pytest.raises(ValueError):
        StreamSink(stream, "c", "twice")


def test_watermarks_of_commits_never_fall(spark, root):
    stream = StreamTable(spark, root, "s/x").create("at bigint")
    for batch, newest in enumerate([10, 5, 20]):
        # A new sink each time, as after a restart.
        sink = StreamSink(stream, "q", EXACTLY_ONCE, event_time="at", delay_micros=1)
        sink.write(spark.createDataFrame([(newest,), (1,)], "at bigint"), batch)
    assert [r.watermark for r in stream.commits().orderBy("batch_id").collect()] == [9, 9, 19]


def test_claims_are_never_shared(spark, stream):
    tables = [StreamTable(spark, stream.folder.removesuffix("/s/numbers"), "s/numbers") for _ in range(4)]
    claims, lock = [], threading.Lock()

    def work(number):
        for batch in range(10):
            claim = tables[number].claim(f"q{number}", batch, 8)
            with lock:
                claims.append(claim)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len({c.epoch for c in claims}) == 40
    again = StreamTable(spark, stream.folder.removesuffix("/s/numbers"), "s/numbers")
    assert again.claim("q1", 3, 8) in claims


def test_a_wide_append_takes_several_epochs(stream):
    wide = stream.claim("big", 0, 3 * TASKS_PER_EPOCH - 5)
    after = stream.claim("next", 0, 8)
    assert (wide.width, after.epoch) == (3, wide.epoch + 3)
    assert TASKS_PER_EPOCH * ROWS_PER_TASK == 1 << 36


def test_empty_batch(spark, stream):
    StreamSink(stream, "q", EXACTLY_ONCE).write(integers(spark, 0), 0)
    assert values(stream) == []
    assert stream.commits().first().n_rows == 0


def test_truncation(spark, stream):
    for batch in range(3):
        sinks.append(stream, integers(spark, 10, 1 + 10 * batch))
    stream.truncate_before(2)
    assert values(stream) == list(range(11, 31))


def test_routing_key_column_is_checked(spark, stream):
    with pytest.raises(ValueError, match="not a string"):
        routing.route(integers(spark, 1), 4, "value")
    with pytest.raises(ValueError, match="missing"):
        routing.route(integers(spark, 1), 4, "ghost")
    with pytest.raises(ValueError):
        routing.route(integers(spark, 1), 0)


def test_events_without_a_key_are_spread(spark):
    rows = integers(spark, 1_000).withColumn("key", F.when(F.col("value") > 900, "k"))
    counts = routing.route(rows, 4, "key").groupBy("segment").count().collect()
    assert len(counts) == 4 and min(r["count"] for r in counts) >= 200


def test_insert_into(spark, stream):
    integers(spark, 4).createOrReplaceTempView("some_numbers")
    sinks.insert_into(stream, "SELECT value, key FROM some_numbers")
    sinks.insert_into(stream, "VALUES (9, 'x'), (10, 'y')", key="key")
    assert values(stream) == [1, 2, 3, 4, 9, 10]
    with pytest.raises(ValueError, match="1 columns"):
        sinks.insert_into(stream, "VALUES (9)")


def test_reserved_columns(spark, root):
    with pytest.raises(ValueError, match="offset"):
        StreamTable(spark, root, "s/x").create("offset bigint")


def test_audit(spark):
    delivered = spark.createDataFrame([(v,) for v in [1, 2, 2, 4, 9, 9]], "v int")
    issues = audit.audit_range(delivered, "v", 5)
    assert {tuple(r) for r in issues.collect()} == {(2, 2, "duplicate"), (3, 0, "missing"), (5, 0, "missing"), (9, 2, "extra")}
    assert {tuple(r) for r in audit.audit_summary(issues).collect()} == {
        ("duplicate", 1, 2), ("missing", 2, 0), ("extra", 1, 2)
    }


def test_scans_of_stored_streams_prune(spark, stream):
    sinks.append(stream, integers(spark, 100), key="key")
    rows = cuts.before(stream.read(), cuts.Cut({1: 1 << 40, 2: 1 << 40})).select("value")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((segment" in plan and "LessThan(offset" in plan
    assert "ReadSchema: struct<offset:bigint,value:int>" in plan


def test_catalog(spark, root):
    catalog = Catalog(spark, root, "s")
    assert catalog.list_databases() == ["s"]
    catalog.create_database("t")
    with pytest.raises(ValueError, match="exists"):
        catalog.create_database("t")
    catalog.create_database("t", if_not_exists=True)
    with pytest.raises(ValueError, match="no database"):
        catalog.get_database("ghost")
    with pytest.raises(ValueError, match="no database"):
        catalog.list_tables("ghost")

    catalog.create_table("a", "a string")
    catalog.create_table("t/b", "a string")
    catalog.create_table("_hidden", "a string")
    catalog.stream("schemaless").create("a string")
    assert catalog.list_tables("s") == ["a"]
    assert catalog.table_exists("schemaless") and not catalog.table_exists("c")
    with pytest.raises(ValueError, match="exists"):
        catalog.create_table("a", "a string")
    with pytest.raises(ValueError, match="no table"):
        catalog.get_table("c")
    with pytest.raises(ValueError, match="no table"):
        catalog.drop_table("c")
    catalog.drop_table("c", if_exists=True)

    sinks.insert_into(catalog.stream("a"), "VALUES ('x'), ('y'), ('x')")
    catalog.create_view("a", "view_of_a")
    assert spark.sql("SELECT count(DISTINCT a) FROM view_of_a").first()[0] == 2
    declared = catalog.open({"scan.streams": "a;t/b", "scan.execution.type": "batch"})
    assert declared.groupBy("scope", "stream").count().collect()[0]["count"] == 3
    assert catalog.open({"scan.streams": "a"}).isStreaming
    catalog.create_view("a", "view_of_a", {"twice": "concat(a, a)"})
    assert {r.twice for r in spark.sql("SELECT twice FROM view_of_a").collect()} == {"xx", "yy"}

    sink = catalog.sink(
        {"sink.stream": "a", "sink.semantic": "exactly-once", "sink.routing-key.field.name": "a"}, "declared"
    )
    sink.write(spark.createDataFrame([("z",)], "a string"), 0)
    assert (sink.guarantee, sink.key, catalog.stream("a").read().count()) == ("exactly-once", "a", 4)
    with pytest.raises(ValueError, match="missing"):
        catalog.sink({"sink.stream": "a", "sink.routing-key.field.name": "ghost"}, "declared")

    with pytest.raises(ValueError, match="not empty"):
        catalog.drop_database("t")
    catalog.drop_database("t", cascade=True)
    catalog.drop_database("t", if_exists=True)
    with pytest.raises(ValueError):
        catalog.drop_database("t")
    catalog.drop_table("a")
    assert catalog.list_tables("s") == []


def test_schema_versions(spark, root):
    catalog = Catalog(spark, root, "s")
    catalog.create_table("a", "k int")
    wider = spark.createDataFrame([], "k bigint, more array<int>").schema
    assert catalog.register_schema("a", wider) == 1
    assert catalog.latest_schema("a") == wider
    info = catalog.get_table("a")
    assert info["row_type"] == wider and info["options"]["scan.streams"] == "a"
    assert {(r.group_id, r.version, r.format) for r in catalog.schemas().collect()} == {("a", 0, "json"), ("a", 1, "json")}
    log = spark.createDataFrame([('{"k": 5000000000, "more": [1]}',)], "payload string")
    assert tuple(catalog.decode(log, "a").first()) == (5000000000, [1])
    with pytest.raises(ValueError, match="no registered schema"):
        catalog.latest_schema("ghost")
    with pytest.raises(ValueError):
        Catalog(spark, root, format="xml")
