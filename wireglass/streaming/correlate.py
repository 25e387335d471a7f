"""Streaming request and response correlation.

Stream-stream left join on key and time interval, then the earliest response
per request. Watermarks on both sides bound the state to the timeout; requests
nobody answered come out once both watermarks have passed it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglass.operators.exchange import TIMEOUT, TIMEOUT_STATUS, correlate


def correlate_streams(requests: DataFrame, responses: DataFrame, timeout: timedelta = TIMEOUT) -> DataFrame:
    """Answered and timed-out requests of two watermarked streams.

    `requests` has `key`, `req_ts`; `responses` has `key`, `rsp_ts`, `rsp_id`,
    `status`, `response`. Times are in the result as instants. A response that is
    delivered again within the delay of its watermark is dropped before the join
    keeps it; a later copy changes nothing, for the first response wins.
    """
    right = responses.dropDuplicatesWithinWatermark(["key", "rsp_id"]).select(
        F.col("key").alias("__key"),
        "rsp_ts",
        # the event time itself must not pass through a second aggregation
        F.struct(F.unix_micros("rsp_ts").alias("rsp_us"), "rsp_id", "status", "response").alias("answer"),
    )
    window = f"{round(timeout.total_seconds() * 1e6)} microseconds"
    inside = (
        (F.col("key") == F.col("__key"))
        & (F.col("rsp_ts") >= F.col("req_ts"))
        & (F.col("rsp_ts") < F.col("req_ts") + F.lit(timeout))
    )
    joined = requests.join(right, inside, "left")
    first = joined.groupBy(F.window("req_ts", window), "key").agg(
        F.min(F.unix_micros("req_ts")).alias("req_us"), F.min("answer").alias("answer")
    )
    answered = F.col("answer").isNotNull()
    given = F.col("answer.status")
    valid = F.coalesce(given.between(100, 599), F.lit(False))
    done = F.when(answered, F.col("answer.rsp_us")).otherwise(F.col("req_us") + round(timeout.total_seconds() * 1e6))
    return first.select(
        "key",
        F.timestamp_micros("req_us").alias("req_ts"),
        F.when(~answered, TIMEOUT_STATUS).when(valid, given).otherwise(500).cast("int").alias("status"),
        F.when(~answered, "timeout").when(valid, "responded").otherwise("error").alias("outcome"),
        F.when(~answered, "").when(valid, F.col("answer.response")).otherwise("invalid status").alias("response"),
        F.timestamp_micros(done).alias("done_ts"),
        F.col("answer.rsp_id").alias("rsp_id"),
    )


def late_requests(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Landed requests that no outcome names: they came behind the watermark.

    Together with the outcomes every request ends as responded, error, timeout
    or late. Both are tables here: what the stream read and what it wrote.
    """
    return requests.join(outcomes.select("key"), "key", "left_anti")


def settle_late(requests: DataFrame, responses: DataFrame, outcomes: DataFrame, timeout: timedelta = TIMEOUT) -> DataFrame:
    """Outcomes of the late requests, by the batch join over the landed tables."""
    return correlate(late_requests(requests, outcomes), responses, timeout)
