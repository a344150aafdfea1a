"""The registered queries, one per operator, over the given tables.

Each takes a session and the folder of the tables. Times and amounts that the checking SQL must
reproduce exactly are kept zone-less and decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cdc, events
from tidemark.functions.schematext import json_schema_text
from tidemark.functions.times import micros, tag_window, tumbling, watermarked
from tidemark.operators import audit, changelog, ordering, routing, watermarks
from tidemark.plans.logs import (
    ORDER_ROW,
    events_log,
    jittered_log,
    orders_canal,
    orders_debezium,
    spread_table,
    table,
    ten_days,
)
from tidemark.settings import shared_folder
from tidemark.sources import cuts, scan
from tidemark.sources.catalog import Catalog, latest_versions, visible_tables
from tidemark.sources.declared import Computed, Declaration, Metadata, Physical
from tidemark.sources.layout import EPOCH_BITS, StreamTable
from tidemark.sources.names import StreamName, split_name
from tidemark.streaming import sinks
from tidemark.streaming.follow import follow, run_until_end
from tidemark.streaming.ordering import EventTimeOrdering

# The moments at which cuts are taken.
TRUNCATED_AT = "2024-01-05 00:00:00"
START_AT = "2024-01-08 00:00:00"
END_AT = "2024-01-22 00:00:00"

EVENT = ("segment", "offset", "event_type", "value", "payload")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _cuts(log: DataFrame, *moments: str) -> list[cuts.Cut]:
    """The cuts of a log at some moments, in one pass."""
    named = {f"cut{i}": cuts.at_time(_moment(m)) for i, m in enumerate(moments)}
    return list(cuts.load_cuts(log, **named).values())


# -- scans ----------------------------------------------------------------------------------


def stream_scan_full(spark: SparkSession, folder: str) -> DataFrame:
    return scan.scan(events_log(spark, folder)).select(*EVENT)


def scan_from_cut(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    return scan.scan(log, *_cuts(log, START_AT)).select(*EVENT)


def scan_cut_range(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    return scan.scan(log, *_cuts(log, START_AT, END_AT)).select(*EVENT)


def truncated_scan(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    truncated, end = _cuts(log, TRUNCATED_AT, END_AT)
    left = cuts.after(log, truncated)
    requested = cuts.Cut({segment: 0 for segment in truncated})
    return scan.scan_untruncated(left, requested, end).select(*EVENT)


def _two_streams(spark: SparkSession, folder: str):
    log = events_log(spark, folder)
    browsing = F.col("event_type").isin("click", "view")
    return scan.local_streams({"web/browsing": log.filter(browsing), "shop/deeds": log.filter(~browsing)})


def multi_stream_union(spark: SparkSession, folder: str) -> DataFrame:
    ranges = scan.stream_ranges(["web/browsing", "shop/deeds"])
    streams = scan.read_streams(ranges, _two_streams(spark, folder))
    return streams.select("scope", "stream", *EVENT)


def multi_stream_cuts(spark: SparkSession, folder: str) -> DataFrame:
    open_log = _two_streams(spark, folder)
    names = [StreamName("web", "browsing"), StreamName("shop", "deeds")]
    first, second = _cuts(open_log(names[0]), START_AT, END_AT), _cuts(open_log(names[1]), START_AT)
    starts = [first[0].text(), cuts.UNBOUNDED_TEXT]
    ends = [first[1].text(), second[0].text()]
    ranges = scan.stream_ranges([str(n) for n in names], starts, ends)
    return scan.read_streams(ranges, open_log).select("scope", "stream", *EVENT)


def cut_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    tails = cuts.positions(events_log(spark, folder), cuts.tail(), "event_type")
    texts = cuts.cut_text(tails, "event_type")
    return texts.select(
        "event_type", "cut_text", F.explode(cuts.parse_cut_text(F.col("cut_text"))).alias("segment", "offset")
    )


def tail_cut(spark: SparkSession, folder: str) -> DataFrame:
    return cuts.positions(events_log(spark, folder), cuts.tail())


def unread_backlog(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    return cuts.backlog(log, *_cuts(log, START_AT), "segment")


def eos_marker_cut(spark: SparkSession, folder: str) -> DataFrame:
    marker = (F.col("event_type") == "error") & (F.col("value") > 250)
    return scan.until_marker(events_log(spark, folder), marker).select(*EVENT)


# -- positions ------------------------------------------------------------------------------


def _named_events(spark: SparkSession, folder: str) -> DataFrame:
    return scan.named(events_log(spark, folder), StreamName("s", "events"))


def event_pointer_projection(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan.with_metadata(
        _named_events(spark, folder),
        ["routing_key", "value", "event_type"],
        {"event_pointer": scan.event_pointer()},
        order=["routing_key", "value", "event_pointer", "event_type"],
    )
    return rows.withColumn("event_pointer", events.decode_text(F.col("event_pointer")))


def pointer_fetch(spark: SparkSession, folder: str) -> DataFrame:
    """The event of highest value of each user, fetched back by its pointer."""
    log = _named_events(spark, folder)
    best = F.max_by(F.struct(*scan.POINTER_FIELDS), F.struct("value", "offset"))
    pointers = log.groupBy("routing_key").agg(best.alias("at")).select("at.*")
    pointers = pointers.select(scan.event_pointer().alias("event_pointer"))
    return scan.fetch(log, pointers).select("routing_key", *EVENT)


# -- decoding and encoding ------------------------------------------------------------------


def decode_json(spark: SparkSession, folder: str) -> DataFrame:
    return events.decode_json(events_log(spark, folder, spread=True), "k int", keep=["segment", "offset"])


def decode_json_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Error events arrive with their last character cut off and are skipped."""
    text = F.col("payload")
    torn = F.substring(text, F.lit(1), F.length(text) - 1)
    log = events_log(spark, folder, spread=True).withColumn(
        "payload", F.when(F.col("event_type") == "error", torn).otherwise(text)
    )
    return events.decode_json(log, "k int", keep=["segment", "offset"], ignore_parse_errors=True)


def decode_registered(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded by the latest of two registered schema versions."""
    catalog = Catalog(spark, shared_folder(spark, "registry"), "s")
    log = events_log(spark, folder)
    for ddl in ("k string", "k bigint"):
        catalog.register_schema("events", spark.createDataFrame([], ddl).schema)
    return catalog.decode(log, "events", keep=["segment", "offset"])


def decode_text_int(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as UTF-8 text; values in cents, negative for errors, as four bytes."""
    cents = F.round(F.col("value") * 100).cast("int")
    amount = F.when(F.col("event_type") == "error", -cents).otherwise(cents)
    encoded = events_log(spark, folder).select(
        "offset",
        events.encode_text(F.col("event_type")).alias("text_payload"),
        events.encode_int(amount).alias("int_payload"),
    )
    return encoded.select(
        "offset",
        events.decode_text(F.col("text_payload")).alias("text_value"),
        events.decode_int(F.col("int_payload")).alias("int_value"),
    )


def _batched_events(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a JSON array of none to three readings, depending on its user."""
    log = events_log(spark, folder, spread=True)
    user = F.col("routing_key").cast("bigint")
    k = F.get_json_object("payload", "$.k").cast("bigint")

    def reading(i):
        # Only the first reading has a time of its own.
        at = F.when(F.lit(i == 0), F.col("offset") * 1000)
        return F.struct(user.alias("u"), (k + i).alias("k"), at.alias("at"))

    readings = F.slice(F.array(*[reading(i) for i in range(3)]), F.lit(1), F.pmod(user, F.lit(4)).cast("int"))
    return log.select("offset", F.to_json(readings).alias("payload"))


def decode_explode(spark: SparkSession, folder: str) -> DataFrame:
    rows = events.decode_json_rows(_batched_events(spark, folder), "u bigint, k bigint", keep=["offset"])
    return rows.select("offset", "element_index", "u", "k")


def assign_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """A reading without a time comes one millisecond after the one before it."""
    batches = _batched_events(spark, folder)
    readings = F.from_json("payload", "array<struct<u: bigint, k: bigint, at: bigint>>")
    stamped = events.assign_timestamps(readings, lambda e, previous: F.coalesce(e["at"], previous + 1))
    rows = batches.select("offset", F.explode(stamped).alias("r"))
    return rows.select("offset", F.col("r.element.k").alias("k"), F.col("r.ts").alias("ts_ms"))


def encode_json(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    rows = log.select("offset", "routing_key", "event_time", F.col("value").cast("decimal(10,2)").alias("value"))
    body = events.encode_json(
        rows, ["routing_key", "event_time", "value"], timestamp_format="ISO-8601", plain_decimals=True
    )
    return rows.select("offset", body.alias("payload"))


# -- projections and windows ----------------------------------------------------------------


def computed_columns(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("value").cast("decimal(10,2)")
    return events_log(spark, folder).select(
        "offset",
        amount.alias("price"),
        (amount + F.lit(1).cast("decimal(3,1)")).cast("decimal(12,2)").alias("computed_price"),
        F.col("event_time").cast("date").alias("log_date"),
        (F.col("event_time") + F.expr("INTERVAL 1 SECOND")).alias("log_ts"),
        (F.col("event_time") - F.expr("INTERVAL 5 SECONDS")).alias("bound"),
    )


def tumbling_window_agg(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder)
    shifted = log.withColumn("ts", F.col("event_time") + F.expr("INTERVAL 1 SECOND"))
    return tumbling(
        shifted,
        "ts",
        "1 hour",
        max_date=F.max(F.col("event_time").cast("date")),
        max_ts=F.max("ts"),
        n=F.count(F.lit(1)),
        max_value=F.max("value"),
    ).drop("window_start")


def window_tag(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder).select("segment", "offset", "event_time")
    return tag_window(log, "event_time", "1 day").drop("event_time")


def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return (
        events_log(spark, folder)
        .groupBy("event_type")
        .agg(F.count_distinct("routing_key").alias("n_keys"))
    )


def word_count_window(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents per 10 s window; one document arrives per second."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    documents = spread_table(spark, folder, "documents", "doc_id").select(
        (epoch + F.make_dt_interval(secs=F.col("doc_id"))).alias("ts"),
        F.explode(F.split("text", "[ \\t\\r\\n]+")).alias("word"),
    )
    return tumbling(
        documents.filter(F.col("word") != ""), "ts", "10 seconds", "word", n=F.count(F.lit(1))
    ).drop("window_end")


# -- change events --------------------------------------------------------------------------


def _order_changes(spark: SparkSession, folder: str, *metadata: str) -> DataFrame:
    return cdc.debezium_changes(
        orders_debezium(spark, folder), ORDER_ROW, keep=["offset"], metadata=metadata
    )


def cdc_expand(spark: SparkSession, folder: str) -> DataFrame:
    return _order_changes(spark, folder)


def cdc_metadata(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder, "ingestion-timestamp", "source.table")
    return changes.select(
        "offset",
        "row_kind",
        "o_orderkey",
        F.unix_millis(F.col("`ingestion-timestamp`")).alias("ingestion_ms"),
        F.col("`source.table`").alias("origin_table"),
    )


def changelog_sum(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder, "source.table")
    return changelog.retracting(
        changes,
        ["o_custkey"],
        rows="n_orders",
        sums={"total_price": F.col("o_totalprice")},
        first={"origin_table": F.col("`source.table`")},
    ).withColumn("total_price", F.col("total_price").cast("decimal(22,2)"))


def changelog_latest(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder)
    columns = [part.split(" ")[0] for part in ORDER_ROW.split(", ")]
    return changelog.current_table(changes, ["o_orderkey"], columns)


def cdc_canal(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.canal_changes(orders_canal(spark, folder), ORDER_ROW, keep=["offset"], database="inv.*")


def append_only_split(spark: SparkSession, folder: str) -> DataFrame:
    judged = changelog.split_append_only(_order_changes(spark, folder))
    return judged.groupBy("row_kind", "accepted").agg(F.count(F.lit(1)).alias("n"))


# -- routing --------------------------------------------------------------------------------


def _segments_per_key(routed: DataFrame) -> DataFrame:
    """Events and segments per routing key, counted per (key, segment) first, and whether the keys spread."""
    parts = routed.groupBy("routing_key", "segment").agg(F.count(F.lit(1)).alias("n"))
    spread = routed.select("segment").distinct().limit(2).count() > 1
    return parts.groupBy("routing_key").agg(
        F.count(F.lit(1)).alias("n_segments"), F.sum("n").alias("n_events")
    ).withColumn("spread", F.lit(spread))


def route_by_key(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder).drop("segment")
    return _segments_per_key(routing.route(log, 16, "routing_key"))


def route_by_expr(spark: SparkSession, folder: str) -> DataFrame:
    log = events_log(spark, folder).drop("segment")
    key = F.concat_ws("-", "event_type", F.get_json_object("payload", "$.k"))
    return _segments_per_key(routing.route(log, 16, key))


def route_without_key(spark: SparkSession, folder: str) -> DataFrame:
    """Events without a routing key: per segment, whether it gets its share of them, within a factor of two."""
    log = events_log(spark, folder).drop("segment")
    share = log.count() / 16
    parts = routing.route(log, 16).groupBy("segment").count()
    return parts.select("segment", F.col("count").between(share / 2, share * 2).alias("fair"))


def stream_names(spark: SparkSession, folder: str) -> DataFrame:
    """Sources as names: those with a slash are qualified, split on the first one only; the others get the default scope."""
    documents = table(spark, folder, "documents")
    wordy = F.col("doc_id") % 3
    qualified = F.concat_ws("/", "lang", "source")
    spec = F.when(wordy == 0, F.col("source")).when(wordy == 1, qualified).otherwise(F.concat(qualified, F.lit("/part")))
    named = documents.select("doc_id", split_name(spec, "main").alias("name"))
    return named.select("doc_id", "name.scope", "name.stream")


# -- event time -----------------------------------------------------------------------------


def event_time_order(spark: SparkSession, folder: str) -> DataFrame:
    log = jittered_log(spark, folder)
    ordered = ordering.with_position(log, "routing_key", "event_time", "offset")
    return ordered.select("routing_key", "offset", "event_time", "position")


def lower_bound_watermark(spark: SparkSession, folder: str) -> DataFrame:
    log = jittered_log(spark, folder)
    return watermarks.advances(watermarks.lower_bounds(log, "epoch", "event_time"), "epoch")


def watermark_marks(spark: SparkSession, folder: str) -> DataFrame:
    return watermarks.noted_marks(jittered_log(spark, folder), "epoch", "event_time")


def late_drop_replay(spark: SparkSession, folder: str) -> DataFrame:
    """What event-time ordering emits per key, and in which order, when events come late."""
    log = jittered_log(spark, folder, spread=True)
    emitted = watermarks.drop_late(log, "routing_key", "epoch", "event_time")
    ordered = ordering.with_position(emitted, "routing_key", "event_time", "offset", measure=log)
    return ordered.select("routing_key", "offset", "event_time", "position")


# -- sinks ----------------------------------------------------------------------------------

STORED_EVENT = "event_id bigint, event_time timestamp_ntz, event_type string, payload string"


def _stored_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_log(spark, folder).select(
        F.col("offset").alias("event_id"), "event_time", "event_type", "payload", "routing_key"
    )


def _new_stream(spark: SparkSession, name: str, row: str = STORED_EVENT, segments: int = 4) -> StreamTable:
    root = shared_folder(spark, "streams")
    return StreamTable(spark, root, name, "s").create(row, segments)


def append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """One batch append and one from SQL, read back."""
    stream = _new_stream(spark, "appended")
    rows = _stored_events(spark, folder)
    is_error = F.col("event_type") == "error"
    sinks.append(stream, rows.filter(~is_error), key="routing_key")
    rows.filter(is_error).drop("routing_key").createOrReplaceTempView("tidemark_error_events")
    sinks.insert_into(stream, "SELECT * FROM tidemark_error_events")
    return stream.read().select("event_id", "event_time", "event_type", "payload")


def ordered_write(spark: SparkSession, folder: str) -> DataFrame:
    """Written in event-time order; the positions are those of the stored offsets."""
    stream = _new_stream(spark, "ordered")
    rows = jittered_log(spark, folder).withColumn("event_id", F.col("offset"))
    sinks.append_in_event_time_order(stream, rows, "routing_key", "event_time", "event_id")
    # The offsets alone give the order here; event time is not looked at again.
    kept = stream.read()
    ranked = ordering.with_position(kept, "routing_key", "offset", "offset")
    return ranked.select("routing_key", "event_id", "event_time", "position")


def _table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of part files: a pattern matches either."""
    pattern = f"{folder}/{name[:-1]}[{name[-1]}].parquet"
    return spark.readStream.schema(table(spark, folder, name).schema).option("maxFilesPerTrigger", "64").parquet(pattern)


def _replayed(spark: SparkSession, folder: str, guarantee: str) -> StreamTable:
    """A streaming copy of the events whose first micro-batch is delivered to the sink twice."""
    stream = _new_stream(spark, "copied")
    source = _table_stream(spark, folder, "events")
    copied = source.select(
        "event_id", F.col("ts").alias("event_time"), "event_type", F.col("props").alias("payload"),
        F.col("user_id").cast("string").alias("routing_key"),
    )
    sink = sinks.StreamSink(stream, "copy", guarantee, key="routing_key", event_time="event_time")

    def twice(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)
        if batch_id == 0:
            sink.write(batch, batch_id)

    query = (
        copied.writeStream.foreachBatch(twice)
        .option("checkpointLocation", shared_folder(spark, "query"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream


def sink_at_least_once(spark: SparkSession, folder: str) -> DataFrame:
    stream = _replayed(spark, folder, sinks.AT_LEAST_ONCE)
    return stream.read().groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


def sink_exactly_once(spark: SparkSession, folder: str) -> DataFrame:
    stream = _replayed(spark, folder, sinks.EXACTLY_ONCE)
    return stream.read().select("event_id", "event_type", "payload")


def sink_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """What the commits of a streaming copy say: rows written, the newest watermark, and how often it fell."""
    commits = _replayed(spark, folder, sinks.EXACTLY_ONCE).commits()
    last = F.lag("watermark").over(W.orderBy("ingest_epoch"))  # one row per micro-batch
    noted = commits.withColumn("fell", F.coalesce(F.col("watermark") < last, F.lit(False)))
    return noted.agg(
        F.sum("n_rows").alias("n_rows"), F.max("watermark").alias("watermark"), F.count_if("fell").alias("falls")
    )


def sink_best_effort(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of ten days, one of which has a row that cannot be written: it is lost and counted, the others stay."""
    stream = _new_stream(spark, "lossy")
    rows = _stored_events(spark, folder).withColumn("batch", _ten_days_of("event_time"))
    batches = [r["batch"] for r in rows.select("batch").distinct().orderBy("batch").collect()]
    sink = sinks.StreamSink(stream, "lossy", sinks.BEST_EFFORT, key="routing_key")
    for batch in batches:
        part = rows.filter(F.col("batch") == batch).drop("batch")
        if batch == batches[1]:
            part = part.withColumn("event_type", F.raise_error(F.lit("a row that cannot be written")))
        sink.write(part, batch)
    kept = stream.read().select("event_id", "event_type")
    return kept.withColumn("lost_batches", F.lit(sink.metrics.batches_failed).cast("bigint"))


def commit_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A job that stopped after staging one batch and after publishing another offers everything again.

    A batch holds the events of ten days. The rows are those of the commit log after recovery.
    """
    stream = _new_stream(spark, "replayed")
    rows = _stored_events(spark, folder).withColumn("batch", _ten_days_of("event_time"))
    batches = [r["batch"] for r in rows.select("batch").distinct().orderBy("batch").collect()]

    def part(batch: int) -> DataFrame:
        return rows.filter(F.col("batch") == batch).drop("batch")

    first = sinks.StreamSink(stream, "daily", sinks.EXACTLY_ONCE, key="routing_key")
    first.write(part(batches[0]), batches[0])
    for batch, published in zip(batches[1:3], (True, False)):
        # What a driver leaves behind that is lost in the middle of a transaction.
        copy = stream.prepare(part(batch))
        claim = stream.claim("daily", batch, 1)
        stream.stage(copy, claim, key="routing_key")
        stream.discard(copy)
        if published:
            stream.reveal(claim)
    again = sinks.StreamSink(stream, "daily", sinks.EXACTLY_ONCE, key="routing_key")
    for batch in batches:
        again.write(part(batch), batch)
    return stream.commits().select("query_id", "batch_id", "n_rows")


def watermark_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """The watermarks that a live sink notes over many micro-batches, each of ten days of late arrivals."""
    row = "event_id bigint, event_time timestamp_ntz, shard int"
    source, target = _new_stream(spark, "late", row), _new_stream(spark, "noted", row)
    log = _arrivals(spark, folder)
    for epoch in [r["epoch"] for r in log.select("epoch").distinct().orderBy("epoch").collect()]:
        sinks.append(source, log.filter(F.col("epoch") == epoch), key="routing_key")
    notes = sinks.WatermarkNotes(segment="shard")
    sink = sinks.StreamSink(target, "noting", sinks.EXACTLY_ONCE, event_time="event_time", marks=notes)
    end = cuts.Cut(source.tail_cut())
    live = follow(source, end=end, rows_per_trigger=1).select("event_id", "event_time", "shard")
    query = sinks.start(live, sink, shared_folder(spark, "query"), interval="0 seconds")
    run_until_end(query, source, end)
    noted = target.commits().filter(F.col("watermark").isNotNull())
    return noted.select("watermark", "n_rows")


def delivery_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases never arrive, errors arrive twice, and every user's number shows up negated."""
    log = events_log(spark, folder)
    kind = F.col("event_type")
    copies = F.when(kind == "purchase", 0).when(kind == "error", 2).otherwise(1)
    arrived = log.select("offset", F.explode(F.array_repeat(F.lit(1), copies)))
    strange = log.select((-F.col("routing_key").cast("bigint") - 1).alias("offset")).distinct()
    issues = audit.audit(arrived.select("offset").union(strange), log, "offset")
    return audit.audit_summary(issues)


# -- streams --------------------------------------------------------------------------------


def streaming_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Windows a stream has closed by the time it has read all events."""
    source = _table_stream(spark, folder, "events")
    times = watermarked(source.select(F.col("ts"), "event_type"), "ts")
    counted = times.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    flat = counted.select(F.unix_micros("window.end").alias("window_end_us"), "event_type", "n")
    stream = _new_stream(spark, "windows", "window_end_us bigint, event_type string, n bigint", 1)
    sink = sinks.StreamSink(stream, "windows", sinks.EXACTLY_ONCE)
    sinks.start(flat, sink, shared_folder(spark, "query"), available_now=True).awaitTermination()
    return stream.read().select("window_end_us", "event_type", "n")


def streaming_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A copy that stops, and resumes from its checkpoint after more events were appended."""
    source, target = _new_stream(spark, "source"), _new_stream(spark, "target")
    rows = _stored_events(spark, folder)
    early = F.col("event_time") < _moment(START_AT)
    checkpoint = shared_folder(spark, "query")
    for part in (rows.filter(early), rows.filter(~early)):
        sinks.append(source, part, key="routing_key")
        sink = sinks.StreamSink(target, "resumed", sinks.EXACTLY_ONCE, key="routing_key")
        sinks.start(source.tail(), sink, checkpoint, available_now=True).awaitTermination()
    return target.read().select("event_id", "event_time", "event_type", "payload")


def bounded_stream_read(spark: SparkSession, folder: str) -> DataFrame:
    """A stream read up to a cut that lay beyond its tail when the read began; events were appended meanwhile.

    Each append holds ten days; the last one lies beyond the cut.
    """
    source, target = _new_stream(spark, "growing"), _new_stream(spark, "read")
    rows = _stored_events(spark, folder).withColumn("batch", _ten_days_of("event_time"))
    batches = [r["batch"] for r in rows.select("batch").distinct().orderBy("batch").collect()]

    def add(batch: int) -> None:
        sinks.append(source, rows.filter(F.col("batch") == batch).drop("batch"), key="routing_key")

    add(batches[0])
    end = cuts.Cut({segment: len(batches) << EPOCH_BITS for segment in range(source.segments)})
    sink = sinks.StreamSink(target, "bounded", sinks.EXACTLY_ONCE, key="routing_key")
    live = follow(source, end=end, uid="bounded").drop("offset", "segment", "ingest_epoch")
    query = sinks.start(live, sink, shared_folder(spark, "query"))
    for batch in batches[1:]:
        add(batch)
    run_until_end(query, source, end, uid="bounded")
    return target.read().select("event_id", "event_time", "event_type", "payload")


def event_time_order_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Event-time ordering of a live stream to which ten days are appended at a time.

    Positions are those of the stored offsets. A batch of the stream is an epoch.
    """
    row = "event_id bigint, event_time timestamp_ntz, shard int"
    source, target = _new_stream(spark, "arrivals", row), _new_stream(spark, "in_order", row)
    log = _by_epoch(spark, _arrivals(spark, folder))
    sink = sinks.StreamSink(
        target, "ordering", sinks.EXACTLY_ONCE, key="routing_key", order=["event_time", "event_id"]
    )
    ordered = EventTimeOrdering(
        sink, shared_folder(spark, "ordering"), "routing_key", "event_time", segment="shard"
    )
    # The query goes on while the next ten days are appended; a trigger admits one append.
    live = follow(source, uid="ordering", rows_per_trigger=1)
    query = live.writeStream.foreachBatch(ordered.write)
    query = query.option("checkpointLocation", shared_folder(spark, "query")).start()
    try:
        for epoch in [r["epoch"] for r in log.select("epoch").distinct().orderBy("epoch").collect()]:
            sinks.append(source, log.filter(F.col("epoch") == epoch), key="routing_key")
        run_until_end(query, source, source.tail_cut(), uid="ordering")
    finally:
        query.stop()
    ordered.finish()
    ranked = ordering.with_position(target.read(), "routing_key", "offset", "offset")
    return ranked.select("routing_key", "event_id", "event_time", "position")


def _by_epoch(spark: SparkSession, log: DataFrame) -> DataFrame:
    """A log stored by epoch, so that an epoch is read without the others."""
    path = shared_folder(spark, "arrivals")
    log.repartitionByRange("epoch", "event_id").write.partitionBy("epoch").parquet(path)
    return spark.read.schema(log.schema).parquet(path)


def _ten_days_of(time: str):
    """Ten-day batches of a time, counted from 1970."""
    return F.floor(F.unix_date(F.col(time).cast("date")) / 10)


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Late events in epochs of ten days of arrival; ``shard`` is the segment they come from."""
    return jittered_log(spark, folder).select(
        F.col("offset").alias("event_id"), "event_time", F.col("segment").alias("shard"), "routing_key",
        ten_days(F.col("epoch")).alias("epoch"),
    )


# -- stored positions -----------------------------------------------------------------------


def _in_three_parts(spark: SparkSession, folder: str, name: str) -> StreamTable:
    """The events appended in three parts, cut at the fixed moments."""
    stream, rows = _new_stream(spark, name), _stored_events(spark, folder)
    early, late = F.col("event_time") < _moment(START_AT), F.col("event_time") >= _moment(END_AT)
    for part in (rows.filter(early), rows.filter(~early & ~late), rows.filter(late)):
        sinks.append(stream, part, key="routing_key", order=["event_id"])
    return stream


def stored_tail_cut(spark: SparkSession, folder: str) -> DataFrame:
    """What the commit log alone says: events and bytes of each append, and what lies beyond its tail."""
    stream = _in_three_parts(spark, folder, "indexed")
    spans = stream.positions()
    # The tail of each append and all that lies beyond it; no event file is read.
    tails = spans.select("segment", F.col("ingest_epoch").alias("epoch"), (F.col("last") + 1).alias("tail"))
    beyond = spans.join(tails, "segment").filter(F.col("first") >= F.col("tail"))
    beyond = beyond.groupBy("epoch").agg(F.sum("n_rows").alias("unread_events"), F.sum("n_bytes").alias("unread_bytes"))
    held = spans.groupBy(F.col("ingest_epoch").alias("epoch")).agg(
        F.sum("n_rows").alias("n_events"), F.sum("n_bytes").alias("n_bytes")
    )
    nothing = F.lit(0).cast("bigint")
    return held.join(beyond, "epoch", "left").select(
        "epoch", "n_events", "n_bytes",
        F.coalesce("unread_events", nothing).alias("unread_events"),
        F.coalesce("unread_bytes", nothing).alias("unread_bytes"),
    )


def stored_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Events and bytes beyond a position that cuts through an append; only that append is read."""
    stream = _in_three_parts(spark, folder, "waiting")
    read_to = cuts.load_cut(stream.read(), F.min(F.when(F.col("event_time") >= _moment(TRUNCATED_AT), F.col("offset"))))
    unread = stream.backlog(read_to)
    return unread.agg(F.sum("unread_events").alias("unread_events"), F.sum("unread_bytes").alias("unread_bytes"))


def truncated_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream truncated in the middle of an append, read as a batch and as a stream: what both find."""
    stream, target = _in_three_parts(spark, folder, "short"), _new_stream(spark, "copied")
    stream.truncate(
        cuts.load_cut(stream.read(), F.min(F.when(F.col("event_time") >= _moment(TRUNCATED_AT), F.col("offset"))))
    )
    end = stream.tail_cut()
    live = follow(stream, end=end).drop("offset", "segment", "ingest_epoch")
    sink = sinks.StreamSink(target, "copy", sinks.EXACTLY_ONCE, key="routing_key")
    run_until_end(sinks.start(live, sink, shared_folder(spark, "query")), stream, end)
    return target.read().select("event_id", "event_type").join(stream.read().select("event_id", "payload"), "event_id")


# -- catalog --------------------------------------------------------------------------------


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Languages as databases, sources as streams, each with an internal twin; a stream is a table
    when some document of it has a label of good quality."""
    documents = table(spark, folder, "documents")
    good = table(spark, folder, "labels").filter(F.col("quality") == 1)
    names = F.array(F.col("source"), F.concat(F.lit("_mark_"), "source"))
    streams = documents.select(
        F.col("lang").alias("database_name"), F.explode(names).alias("table_name")
    ).distinct()
    labelled = documents.join(good, "doc_id", "left_semi")
    groups = labelled.select(
        F.col("lang").alias("database_name"), F.explode(names).alias("table_name")
    ).distinct()
    return visible_tables(streams, groups, ["database_name", "table_name"], "table_name")


def schema_evolved_read(spark: SparkSession, folder: str) -> DataFrame:
    """Events written under two row types, read with the later one: a changed type, one field gone, one new."""
    catalog = Catalog(spark, shared_folder(spark, "catalog"), "s")
    stream = catalog.create_table("events", "event_id bigint, user bigint, kind string, note string")
    rows = table(spark, folder, "events").select(
        "event_id", F.col("user_id").alias("user"), F.col("event_type").alias("kind"), F.col("props").alias("note"),
        F.col("ts").cast("date").alias("day"),
    )
    early = F.col("day") < F.lit(START_AT).cast("date")
    sinks.append(stream, rows.filter(early))
    later = T.StructType.fromDDL("event_id bigint, user string, kind string, day date")
    catalog.register_schema("events", later)
    sinks.append(catalog.stream("events"), rows.filter(~early).withColumn("user", F.concat(F.lit("u"), "user")))
    read = catalog.open({"scan.streams": "events", "scan.execution.type": "batch"})
    return read.select("event_id", "user", "kind", "day")


def encode_registered(spark: SparkSession, folder: str) -> DataFrame:
    """Events encoded by the latest schema of their group, which another version has replaced."""
    catalog = Catalog(spark, shared_folder(spark, "catalog"), "s")
    catalog.create_table("readings", "user_id bigint, note string")
    catalog.register_schema("readings", T.StructType.fromDDL("user string, amount decimal(10,2), kind string"))
    rows = table(spark, folder, "events").select(
        "event_id", F.col("user_id").alias("user"), F.col("value").alias("amount"), F.col("event_type").alias("kind")
    )
    return catalog.encode(rows, "readings", keep=["event_id"])


def declared_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table with computed, metadata and physical columns, declared in an order of its own."""
    catalog = Catalog(spark, shared_folder(spark, "catalog"), "shop")
    stream = catalog.create_table("prices", "event_id bigint, price decimal(10,2), currency string, log_ts timestamp_ntz")
    rows = events_log(spark, folder).select(
        F.col("offset").alias("event_id"), F.col("value").cast("decimal(10,2)").alias("price"),
        F.col("event_type").alias("currency"), F.col("event_time").alias("log_ts"), "routing_key",
    )
    sinks.append(stream, rows, key="routing_key")
    declaration = Declaration(
        [
            # Refers to a computed column that is declared after it.
            Computed("bound", "ts - INTERVAL 5 SECONDS"),
            Computed("computed-price", "CAST(price + CAST(1 AS DECIMAL(3,1)) AS DECIMAL(12,2))"),
            Physical("price", "decimal(10,2)"),
            Metadata("owner", "routing_key"),
            Physical("currency", "string"),
            Metadata("stream_name", "stream"),
            Computed("log_date", "CAST(log_ts AS DATE)"),
            Physical("log_ts", "timestamp_ntz"),
            Computed("ts", "log_ts + INTERVAL 1 SECOND"),
            Physical("event_id", "bigint"),
        ],
        watermark="ts",
    )
    return catalog.open({"scan.streams": "prices", "scan.execution.type": "batch"}, declaration)


def schema_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Each event type registers a schema per day, titled with the largest event id of the day."""
    log = events_log(spark, folder)
    day = F.unix_date(F.col("event_time").cast("date"))
    versions = log.groupBy(F.col("event_type").alias("group_id"), day.alias("version")).agg(
        F.max("offset").alias("last")
    )
    text = F.concat(F.lit('{"title": "v'), F.col("last").cast("string"), F.lit('", "type": "object"}'))
    return latest_versions(versions.select("group_id", "version", text.alias("schema")), ["group_id"])


def schema_to_json(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON schema of every given table, with its row count."""
    parts = []
    for name in TABLES:
        rows = table(spark, folder, name)
        counted = rows.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(
            counted.select(
                F.lit(name).alias("table_name"), F.lit(json_schema_text(rows.schema)).alias("json_schema"), "n_rows"
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


QUERIES = {
    f.__name__: f
    for f in (
        stream_scan_full,
        scan_from_cut,
        scan_cut_range,
        truncated_scan,
        multi_stream_union,
        multi_stream_cuts,
        cut_text_roundtrip,
        tail_cut,
        unread_backlog,
        eos_marker_cut,
        event_pointer_projection,
        pointer_fetch,
        decode_json,
        decode_json_lenient,
        decode_registered,
        decode_text_int,
        decode_explode,
        assign_timestamps,
        encode_json,
        computed_columns,
        tumbling_window_agg,
        window_tag,
        count_distinct,
        word_count_window,
        cdc_expand,
        cdc_metadata,
        changelog_sum,
        changelog_latest,
        cdc_canal,
        append_only_split,
        route_by_key,
        route_by_expr,
        route_without_key,
        stream_names,
        event_time_order,
        lower_bound_watermark,
        watermark_marks,
        late_drop_replay,
        append_roundtrip,
        ordered_write,
        sink_at_least_once,
        sink_exactly_once,
        sink_best_effort,
        sink_watermark,
        commit_replay,
        delivery_audit,
        watermark_in_force,
        streaming_parity,
        streaming_resume,
        bounded_stream_read,
        event_time_order_stream,
        stored_tail_cut,
        stored_backlog,
        truncated_stream,
        catalog_tables,
        schema_evolved_read,
        encode_registered,
        declared_table,
        schema_latest,
        schema_to_json,
    )
}
