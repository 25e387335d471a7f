"""Rows at the edges: every one ends somewhere."""

import pytest
from pyspark.sql import functions as F

from wireglass.operators import exchange, ingest
from wireglass.operators.positions import live_table
from wireglass.session import shared_dir
from wireglass.sources.landed import RAW_REQUESTS, read_blobs, stream_landed


def test_every_request_gets_a_port_or_a_reject(spark):
    urls = ["/Op/ports/output/0/inject", "/Op/ports/output/7/inject", "/Op/ports/output/99999999999/inject", "/nothing", None]
    requests = spark.createDataFrame(list(enumerate(urls)), "request_id int, url string")
    routed = ingest.route_requests(requests)
    ports = ingest.split_ports(routed, 2)
    rejected = {r["request_id"]: r["error"] for r in ingest.no_port(routed, 2).collect()}
    assert [r["request_id"] for r in ports[0].collect()] == [0] and ports[1].count() == 0
    assert rejected == {1: "no route", 2: "no route", 3: "no route", 4: "no route"}
    assert routed.where("request_id = 2").first()["error"] == "no route"


def test_empty_payload_files_are_kept(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"")
    got = {r["url"].rsplit("/", 1)[1]: bytes(r["body"]) for r in read_blobs(spark, str(tmp_path), "*.bin").collect()}
    assert got == {"a.bin": b"abc", "b.bin": b""}


def test_a_watermark_needs_its_delay(spark, tmp_path):
    with pytest.raises(ValueError, match="delay"):
        stream_landed(spark, str(tmp_path), RAW_REQUESTS, "ts")


def test_shared_folder_is_demanded_on_a_cluster(spark):
    class Context:
        master = "yarn"

    class Session:
        conf = spark.conf
        sparkContext = Context()

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(), "x")


def test_status_beyond_int_is_no_status(spark):
    texts = ['{"key": 1, "status": 3000000000}', '{"key": 2, "status": 201}', '{"key": 3, "status": null}', '{"key": 4, "status": "x"}']
    frame = spark.createDataFrame([(t,) for t in texts], "jsonString string")
    got = {r["key"]: r["status"] for r in exchange.response_from_json(frame).collect()}
    assert got == {1: exchange.NO_STATUS, 2: 201, 3: 200, 4: 400}


def test_times_outside_the_calendar_are_shown_as_numbers(spark):
    frame = spark.createDataFrame([(1_700_000_000_000,), (1_700_000_000_000_000_000,), (None,)], "event_time long")
    assert [r[0] for r in live_table(frame).collect()] == ["11/14/2023, 10:13:20 PM", "1700000000000000000", None]


def test_large_answers_are_fetched_after_the_minimum(spark):
    asked = spark.range(3).select(F.col("id").alias("key"), F.lit("2024-01-01").cast("timestamp").alias("req_ts"))
    told = spark.range(9).select(
        (F.col("id") % 3).alias("key"),
        F.lit("2024-01-01 00:00:01").cast("timestamp").alias("rsp_ts"),
        F.col("id").alias("rsp_id"),
        F.lit(200).alias("status"),
        F.repeat(F.lit("x"), 1000).alias("response"),
    )
    answers = exchange.correlate(asked, told)
    assert {(r["key"], r["rsp_id"]) for r in answers.collect()} == {(0, 0), (1, 1), (2, 2)}
    # nothing wide is aggregated
    assert "SortAggregate" not in answers._jdf.queryExecution().executedPlan().toString()
