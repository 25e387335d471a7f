"""Shapes of physical plans: what would not hold on a large table must not appear."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from wireglass.operators import exchange, ingest, messages, view
from wireglass.operators.view import ViewSpec
from wireglass.plans.buckets import measure
from wireglass.plans.intervals import nearby
from wireglass.plans.ordered import sequence
from wireglass.queries import QUERIES, derive
from wireglass.queries.registry import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops(spark, name):
    if name.startswith("stream_"):
        pytest.skip("reads back a written table")
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_no_window_over_all_rows(spark):
    # the only window without keys sees bucket totals
    text = plan(sequence(table(spark, SMALL, "events").select("ts", "event_id"), ["ts", "event_id"]))
    singles = [line for line in text.splitlines() if re.search(r"Exchange SinglePartition", line)]
    assert len(singles) == 1
    below = text.split("Exchange SinglePartition", 1)[1].splitlines()[1]
    assert "HashAggregate" in below


def test_rows_are_shuffled_once_per_running_measure(spark):
    events = table(spark, SMALL, "events").select("ts", "event_id", "user_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sequence(events, ["ts", "event_id"], keys=["user_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the join reads the window over the rows as it is: no exchange or sort in between
    assert re.search(r"SortMergeJoin \[__key#\d+, __bucket#\d+L\][^\n]*\n\s*:- Window", text)


def test_frames_are_numbered_once(spark):
    # one pass over the rows and one for the totals of their buckets
    frames = derive.frames(spark, SMALL)
    text = plan(messages.assemble(frames, layout=measure(frames, "ts")))
    assert len(re.findall(r"FileScan parquet|Scan parquet", text)) == 2
    assert "LeftSemi" not in text


def test_top_rows_without_a_full_sort(spark):
    events = table(spark, SMALL, "events")
    assert "TakeOrderedAndProject" in plan(view.last_n(events, 16, derive.ORDER))
    text = plan(view.last_n(events, 16, derive.ORDER, ["user_id"]))
    assert text.count("WindowGroupLimit") == 2


def test_one_partition_reaches_the_scan(spark):
    spec = ViewSpec(derive.ORDER, 16, ["user_id", "event_type"], named=True)
    text = plan(view.read_view(table(spark, SMALL, "events"), spec, "event_type=view&attribute=event_id"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,view\)", text)
    assert "props" not in text and "value" not in text.split("ReadSchema")[1]


def test_ingest_is_one_narrow_stage(spark):
    routed = ingest.route_requests(derive.requests(spark, SMALL))
    from wireglass.queries.ingest import FORM_SCHEMA

    text = plan(ingest.accepted(ingest.inject_tuple(routed, FORM_SCHEMA), FORM_SCHEMA))
    assert "Exchange" not in text and "Python" not in text


def test_correlation_joins_on_key_and_time(spark):
    asked, told = derive.asked(spark, SMALL).select("key", "req_ts"), derive.told(spark, SMALL)
    text = plan(exchange.correlate(asked, told))
    assert re.search(r"Join \[key#\d+L?, __bucket#\d+L\]", text)
    assert "Python" not in text


def test_repeated_rows_do_not_pass_through_the_driver(spark):
    # both sides look small to Spark, which does not see that each row is repeated per level
    events = table(spark, SMALL, "events").select("ts", "event_id")
    spans = events.select(F.col("ts").alias("low"), (F.col("ts") + F.expr("interval 2 days")).alias("high"))
    text = plan(nearby(events, spans, "ts", F.col("low"), F.col("high"), measure(events, "ts", 16)))
    assert "SortMergeJoin" in text
    assert "Broadcast" not in text


def test_sliding_answers_are_not_shuffled(spark):
    # they may be many times the rows and requests: neither repeated in a tree nor brought together for their position
    text = plan(QUERIES["answer_sliding_requests"](spark, SMALL))
    assert "__node_i" not in text
    assert not re.search(r"Window \[[^\n]*__request_id", text)
