"""Streaming queries: they run over everything available and are read back as tables.

Each must give the rows of its batch form.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.operators import ingest
from wireglass.operators.view import SlidingTime, ViewSpec
from wireglass.queries import derive
from wireglass.queries.exchange import CORRELATE_SQL
from wireglass.queries.ingest import _FORM_SQL, FORM_SCHEMA
from wireglass.queries.messages import ACK_SQL, GAUGE_SQL, SESSIONS_SQL, WHOLE_SQL
from wireglass.queries.registry import query, table
from wireglass.queries.views import _BY_USER
from wireglass.session import landed, shared_dir
from wireglass.sources.landed import stream_landed, write_frame
from wireglass.streaming.correlate import correlate_streams, settle_late
from wireglass.streaming.live_view import LiveView
from wireglass.streaming.messages import MessageAssembly, MessageCounter, SessionRegistry, SessionStore


@query(f"SELECT event_id, user_id, event_type FROM ({_BY_USER}) WHERE r <= c // 4 * 4 AND r > c // 4 * 4 - 16")
def stream_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live view of the event stream: last 16 per user, snapshot every 4 rows."""
    schema = table(spark, sf_dir, "events").schema
    stream = stream_landed(spark, sf_dir, schema, glob="events.parquet")
    live = LiveView(spark, shared_dir(spark, "view"), ViewSpec(derive.ORDER, 16, ["user_id"], trigger=4))
    live.start(stream.select("event_id", "ts", "user_id", "event_type")).awaitTermination()
    return live.contents().select("event_id", "user_id", "event_type")


_LANDING = "least(CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, 2)"


@query(
    f"WITH e AS (SELECT *, {_LANDING} AS part, max(ts) OVER (PARTITION BY user_id) AS m FROM events), "
    "k AS (SELECT user_id, part, max(ts) AS newest FROM e GROUP BY ALL) "
    "SELECT event_id, user_id, 'shown' AS fate FROM e WHERE ts > m - INTERVAL 2 DAY UNION ALL "
    "SELECT event_id, user_id, 'late' FROM e WHERE ts <= "
    "(SELECT max(newest) FROM k WHERE k.user_id = e.user_id AND k.part < e.part) - INTERVAL 2 DAY"
)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live view of the last two days per user over three landings, with a restart each; every 50th row lands late."""
    root = shared_dir(spark, "sliding")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    live = LiveView(spark, root, ViewSpec(derive.ORDER, keys=["user_id"], window=SlidingTime(timedelta(days=2))), buckets=16)
    for part in range(3):
        events.where(F.expr(_LANDING) == part).write.mode("append").parquet(f"{root}/in")
        live.start(stream_landed(spark, f"{root}/in", events.schema)).awaitTermination()
    shown = live.contents().select("event_id", "user_id", F.lit("shown").alias("fate"))
    return shown.unionByName(live.late().select("event_id", "user_id", F.lit("late").alias("fate")))


# How far behind its newest row a landed part may still bring rows, and the parts that land one after the other.
DISORDER = timedelta(minutes=10)
PARTS = 4


@query(CORRELATE_SQL)
def stream_correlate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed requests and responses, correlated by a stream-stream join over several micro-batches.

    Both sides land in PARTS by time, each written by as many tasks as Spark likes;
    the stream is started again for every part and goes on from its checkpoint.
    The watermark allows DISORDER, whatever the span of the data, so the state holds
    the rows of that time and of the timeout. Every 50th request lands a part too
    late: it is behind the watermark, and settled from the landed tables. A closing
    row on both sides moves the watermarks past the last timeout; it has the key 0,
    which no request has, and is left out.
    """
    root = shared_dir(spark, "correlate")
    sides = {"req": ("req_ts", derive.asked(spark, sf_dir).select("key", "req_ts")), "rsp": ("rsp_ts", derive.told(spark, sf_dir))}
    instants = {
        name: df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"})
        for name, (_, df) in sides.items()
    }
    # derived once from all their kinds: the span and every part read what is landed
    instants["rsp"] = landed(instants["rsp"], "responses")
    span = instants["rsp"].agg(F.min("rsp_ts").alias("low"), F.max("rsp_ts").alias("high")).first()
    step = max((span["high"] - span["low"]) / PARTS, timedelta(seconds=1))
    closing = F.lit(span["high"]) + F.expr("interval 30 days")

    def part(name: str, k: int) -> DataFrame:
        """What lands with part k; the last is the closing row alone."""
        df, ts = instants[name], sides[name][0]
        if k == PARTS:
            row = {"key": F.lit(0), ts: closing}
            return spark.range(1).select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema])
        cuts = [F.lit(span["low"] + step * i) for i in range(1, PARTS)]
        home = sum((F.when(F.col(ts) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        late = F.when(F.col("key") % 50 == 0, 1).otherwise(0) if name == "req" else F.lit(0)
        return df.where(F.least(home + late, F.lit(PARTS - 1)) == k)

    for k in range(PARTS + 1):
        for name in sides:
            part(name, k).write.mode("append").parquet(f"{root}/{name}")
        streams = [
            stream_landed(spark, f"{root}/{name}", instants[name].schema, ts, f"{DISORDER.total_seconds():.0f} seconds")
            for name, (ts, _) in sides.items()
        ]
        write_frame(correlate_streams(*streams), f"{root}/out", checkpoint=f"{root}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    rows = [spark.read.schema(instants[name].schema).parquet(f"{root}/{name}").where("key <> 0") for name in sides]
    settled = settle_late(*rows, out).select(*out.columns)
    local = {name: F.col(name).cast("timestamp_ntz") for name in ("req_ts", "done_ts")}
    return out.where("key <> 0").unionByName(settled).withColumns(local)


@query(
    f"WITH {_FORM_SQL} SELECT request_id, CASE WHEN error = '' THEN request_id ELSE 0 END AS event_id, "
    "CASE WHEN error = '' AND posted THEN et ELSE '' END AS event_type, error FROM checked"
)
def stream_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form posts as a stream: tuples and rejects in one pass, nothing is lost."""
    root = shared_dir(spark, "inject")
    raw = derive.requests(spark, sf_dir)
    raw.write.parquet(f"{root}/raw")
    stream = stream_landed(spark, f"{root}/raw", raw.schema)
    injected = ingest.inject_tuple(ingest.route_requests(stream), FORM_SCHEMA)
    write_frame(
        injected.select("request_id", "error", *FORM_SCHEMA.fieldNames()), f"{root}/out", checkpoint=f"{root}/checkpoint"
    ).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    good = F.col("error").isNull()
    return out.select(
        "request_id",
        F.when(good, F.col("event_id")).otherwise(0).alias("event_id"),
        F.when(good, F.col("event_type")).otherwise("").alias("event_type"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def _in_thirds(store: SessionStore, rows: DataFrame) -> None:
    """Land the rows in three parts by time and run the store over each; the query starts again for every part."""
    span = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    if span["low"] is None:
        span = {"low": datetime(1970, 1, 1), "high": datetime(1970, 1, 1)}
    third = (span["high"] - span["low"]) / 3
    second, last = F.col("ts") > F.lit(span["low"] + third), F.col("ts") > F.lit(span["high"] - third)
    for some in (~second, second & ~last, second & last):
        rows.where(some).write.mode("append").parquet(f"{store.root}/in")
        store.start(stream_landed(store.spark, f"{store.root}/in", rows.schema)).awaitTermination()


@query(WHOLE_SQL)
def stream_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to whole messages over three micro-batches; many messages lie across two."""
    store = MessageAssembly(spark, shared_dir(spark, "assemble"), buckets=16)
    _in_thirds(store, derive.frames(spark, sf_dir))
    return store.messages().withColumn("data", F.decode("payload", "UTF-8")).drop("payload")


@query(SESSIONS_SQL)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session events over three micro-batches, with the intervals that open events start."""
    store = SessionRegistry(spark, shared_dir(spark, "sessions"), derive.ORDER, buckets=16)
    _in_thirds(store, derive.session_events(spark, sf_dir))
    return store.sessions()


@query(GAUGE_SQL)
def stream_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected clients after every event, the number carried from batch to batch."""
    store = SessionRegistry(spark, shared_dir(spark, "clients"), derive.ORDER, buckets=16)
    _in_thirds(store, derive.session_events(spark, sf_dir))
    return store.gauge()


@query(ACK_SQL)
def stream_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After every tenth message of all clients a COUNT message, the count carried from batch to batch."""
    store = MessageCounter(spark, shared_dir(spark, "acks"), derive.ORDER, ack_count=10)
    _in_thirds(store, derive.messages(spark, sf_dir))
    return store.acks()
