"""Properties every registered query's plan has to keep."""

import re

import pytest

import __spark_entry__ as entry_point
from tidemark.operators import audit
from tidemark.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PURE = [
    n for n in sorted(QUERIES)
    if not n.startswith(("sink_", "streaming_", "append_", "ordered_", "event_time_order_stream"))
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(entry_point.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "InArrow"):
        assert bad not in plan, bad
    # Only tables of one row per epoch, counted beforehand, of one row per segment, and plain row counts meet in one task.
    if name not in ("lower_bound_watermark", "watermark_marks", "schema_to_json", "stored_backlog"):
        assert "SinglePartition" not in plan


def scans(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_column_pruning(spark):
    queries = entry_point.queries()
    assert scans(plan_of(queries["tail_cut"](spark, FOLDER))) == ["event_id:bigint,user_id:bigint"]
    assert scans(plan_of(queries["count_distinct"](spark, FOLDER))) == ["user_id:bigint,event_type:string"]
    assert scans(plan_of(queries["word_count_window"](spark, FOLDER))) == ["doc_id:bigint,text:string"]


def test_filters_reach_the_scan(spark):
    plan = plan_of(entry_point.queries()["multi_stream_union"](spark, FOLDER))
    assert "PushedFilters: [In(event_type, [click,view])" in plan
    batches = spark.createDataFrame([("q", 1), ("q", 2)], "query_id string, batch_id bigint")
    due = audit.uncommitted(batches, batches.filter("batch_id < 2"))
    assert "LeftAnti" in plan_of(due) and [r.batch_id for r in due.collect()] == [2]


def test_positions_read_no_events(spark):
    plan = plan_of(entry_point.queries()["stored_tail_cut"](spark, FOLDER))
    assert "event_id" not in plan and "ingest_epoch=" not in plan


def test_scans_do_not_shuffle(spark):
    queries = entry_point.queries()
    for name in ("stream_scan_full", "scan_cut_range", "eos_marker_cut", "event_pointer_projection", "window_tag",
                 "computed_columns", "multi_stream_cuts", "truncated_scan"):
        assert "Exchange" not in plan_of(queries[name](spark, FOLDER)), name
