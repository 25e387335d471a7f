"""View queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.operators import as_of, view
from wireglass.operators.view import ViewSpec
from wireglass.queries.derive import ORDER
from wireglass.queries.registry import query, table

_EVENT = "event_id, ts, user_id, event_type, value"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_EVENT.split(", "))


def _ranked(source: str, keys: str, order: str, columns: str = "*") -> str:
    """SQL: rows with their number r and the count c of their partition."""
    by = f"PARTITION BY {keys} " if keys else ""
    return (
        f"SELECT {columns}, row_number() OVER ({by}ORDER BY {order}) AS r, count(*) OVER ({by.strip()}) AS c "
        f"FROM {source}"
    )


_BY_USER = _ranked("events", "user_id", "ts, event_id")
_BY_BOTH = _ranked("events", "user_id, event_type", "ts, event_id")
_ALL = _ranked("events", "", "ts, event_id")


@query(f"SELECT {_EVENT} FROM events ORDER BY ts DESC, event_id DESC LIMIT 16")
def view_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_n(_events(spark, sf_dir), 16, ORDER)


@query(f"SELECT {_EVENT} FROM ({_BY_USER}) WHERE (r - 1) // 16 = c // 16 - 1")
def view_last_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_batch(_events(spark, sf_dir), 16, ORDER, ["user_id"])


@query(f"SELECT {_EVENT} FROM ({_ALL}) WHERE (r - 1) // 16 = c // 16 - 1")
def view_last_batch_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_batch(_events(spark, sf_dir), 16, ORDER)


@query(f"SELECT {_EVENT} FROM ({_BY_USER}) WHERE r > c - 16")
def view_part1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_n(_events(spark, sf_dir), 16, ORDER, ["user_id"])


@query(f"SELECT {_EVENT} FROM ({_BY_BOTH}) WHERE r > c - 4")
def view_part2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_n(_events(spark, sf_dir), 4, ORDER, ["user_id", "event_type"])


@query(f"SELECT {_EVENT} FROM ({_BY_USER}) WHERE r <= c // 5 * 5 AND r > c // 5 * 5 - 16")
def view_trigger_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.last_n(_events(spark, sf_dir), 16, ORDER, ["user_id"], trigger=5)


@query(
    f"SELECT {_EVENT} FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS m FROM events) "
    "WHERE ts > m - INTERVAL 2 DAY"
)
def view_sliding_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.sliding_time(_events(spark, sf_dir), timedelta(days=2), "ts", ["user_id"])


@query(
    f"WITH e AS (SELECT time_bucket(INTERVAL 6 HOUR, max(ts), TIMESTAMP '1970-01-01') AS x FROM events) "
    f"SELECT {_EVENT} FROM events, e WHERE ts >= x - INTERVAL 6 HOUR AND ts < x"
)
def view_tumbling_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.tumbling_time(_events(spark, sf_dir), timedelta(hours=6), "ts")


@query(
    f"SELECT {_EVENT} FROM (SELECT *, last_value(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS m FROM events) WHERE abs(m - event_id) <= 500"
)
def view_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.delta_window(_events(spark, sf_dir), "event_id", 500, ORDER, ["event_type"])


@query(
    "WITH e AS (SELECT *, event_type = 'signup' AND value > 100 AS p FROM events), "
    "s AS (SELECT *, sum(p::int) OVER (ORDER BY ts, event_id) AS g, sum(p::int) OVER () AS t FROM e) "
    f"SELECT {_EVENT} FROM s WHERE NOT p AND g = t - 1"
)
def view_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _events(spark, sf_dir).withColumn("p", F.expr("event_type = 'signup' AND value > 100"))
    return view.punct_window(marked, "p", ORDER).drop("p")


@query(
    "SELECT 'unpartitioned' AS port, event_id FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 16)"
)
def view_force_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    parted = ViewSpec(ORDER, 16, ["user_id"], force_empty=True)
    plain = ViewSpec(ORDER, 16, force_empty=True)
    none = view.read_view(events, parted, "attribute=event_id").select(F.lit("partitioned").alias("port"), "event_id")
    rows = view.read_view(events, plain, "attribute=event_id").select(F.lit("unpartitioned").alias("port"), "event_id")
    return none.unionByName(rows)


# ---- many requests: customers ask for orders by status and priority ---------------

_ORDER_KEYS = ["o_orderstatus", "o_orderpriority"]
_ORDERS = ViewSpec(["o_orderdate", "o_orderkey"], 16, _ORDER_KEYS)
_STATUS = "CASE c_custkey % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE 'P' END"
_PRIORITY = (
    "CASE c_custkey % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM' "
    "WHEN 3 THEN '4-NOT+SPECIFIED' ELSE '5-LOW' END"
)
_POSITIONAL = (
    f"CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN 'partition=' || {_STATUS} "
    f"ELSE 'partition=' || {_STATUS} || '&partition=' || {_PRIORITY} || '&partition=extra' END"
)
_NAMED = (
    f"CASE c_custkey % 4 WHEN 0 THEN 'o_orderpriority=' || {_PRIORITY} || '&o_orderstatus=' || {_STATUS} "
    f"WHEN 1 THEN 'o_orderstatus=' || {_STATUS} WHEN 2 THEN 'x=1&o_orderpriority=' || {_PRIORITY} "
    "ELSE 'nosuch=1' END"
)
_ORDER_VIEW = (
    "v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) AS d FROM orders) WHERE d <= 16)"
)


def _ask(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS request_id", f"{text} AS query")


def _order_answers(spark: SparkSession, sf_dir: str, spec: ViewSpec, text: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", *_ORDER_KEYS)
    asked = view.read_requests(orders, spec, _ask(spark, sf_dir, text))
    return view.answer_requests(view.snapshot(orders, spec), asked, spec).select("request_id", "o_orderkey")


@query(
    f"WITH {_ORDER_VIEW}, q AS (SELECT c_custkey, {_STATUS} AS s, replace({_PRIORITY}, '+', ' ') AS p FROM customer) "
    "SELECT c_custkey AS request_id, o_orderkey FROM q JOIN v ON c_custkey % 11 = 0 OR "
    "(c_custkey % 7 <> 0 AND s = o_orderstatus AND p = o_orderpriority)"
)
def view_query_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_answers(spark, sf_dir, _ORDERS, _POSITIONAL)


@query(
    f"WITH {_ORDER_VIEW}, q AS (SELECT c_custkey, {_STATUS} AS s, replace({_PRIORITY}, '+', ' ') AS p FROM customer) "
    "SELECT c_custkey AS request_id, o_orderkey FROM q JOIN v ON c_custkey % 4 <> 3 AND "
    "(c_custkey % 4 = 2 OR s = o_orderstatus) AND (c_custkey % 4 = 1 OR p = o_orderpriority)"
)
def view_query_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(_ORDERS.order, 16, _ORDER_KEYS, named=True, force_empty=True)
    return _order_answers(spark, sf_dir, spec, _NAMED)


_KEY_TEXT = (
    "CASE c_custkey % 8 WHEN 0 THEN ' 12' WHEN 1 THEN 'abc' WHEN 2 THEN '+5' WHEN 3 THEN '99999999999999999999' "
    "WHEN 4 THEN '' WHEN 5 THEN '-3' ELSE cast(c_custkey AS string) END"
)


@query(
    f"WITH q AS (SELECT c_custkey AS request_id, {_KEY_TEXT} AS t FROM customer), "
    "k AS (SELECT request_id, CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') THEN TRY_CAST(t AS bigint) END AS v FROM q) "
    "SELECT request_id, v AS user_id, CASE WHEN v IS NULL THEN 'bad partition value for user_id' ELSE '' END AS error "
    "FROM k"
)
def view_query_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, 16, ["user_id"])
    text = f"'partition=' || replace(replace({_KEY_TEXT}, '+', '%2B'), ' ', '+')"
    asked = view.read_requests(_events(spark, sf_dir), spec, _ask(spark, sf_dir, text))
    return asked.select(
        "request_id", F.col("q_user_id").alias("user_id"), F.coalesce("error", F.lit("")).alias("error")
    )


# ---- projection --------------------------------------------------------------------


@query("SELECT user_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 16")
def view_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "attribute=user_id&attribute=value&attribute=nosuch&attribute=user_id"
    return view.read_view(_events(spark, sf_dir), ViewSpec(ORDER, 16), text)


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 16")
def view_suppress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.read_view(_events(spark, sf_dir), ViewSpec(ORDER, 16), "suppress=value&suppress=ts&suppress=nosuch")


@query(f"SELECT event_type, event_id FROM ({_BY_BOTH}) WHERE r > c - 16 AND event_type = 'view'")
def view_named_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, 16, ["user_id", "event_type"], named=True)
    return view.read_view(_events(spark, sf_dir), spec, "event_type=view&attribute=event_type&attribute=event_id")


# ---- rendering ----------------------------------------------------------------------


@query(
    "SELECT user_id, count(*) AS n, cast(to_json(list({event_id: event_id, event_type: event_type} "
    f"ORDER BY ts, event_id)) AS varchar) AS json FROM ({_BY_USER}) WHERE r > c - 8 GROUP BY user_id"
)
def view_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, 8, ["user_id"], attributes=["event_id", "event_type"])
    return view.render_view(_events(spark, sf_dir), spec)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.col("props").alias("jsonString"))


@query(
    "SELECT user_id, count(*) AS n, cast(to_json(list({event_id: event_id, jsonString: json(props)} "
    f"ORDER BY ts, event_id)) AS varchar) AS json FROM ({_BY_USER}) WHERE r > c - 8 GROUP BY user_id"
)
def view_embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, 8, ["user_id"], attributes=["event_id", "jsonString"])
    return view.render_view(_documents(spark, sf_dir), spec)


@query(
    "SELECT user_id, count(*) AS n, cast(to_json(list(json(props) ORDER BY ts, event_id)) AS varchar) AS json "
    f"FROM ({_BY_USER}) WHERE r > c - 8 GROUP BY user_id"
)
def view_pure_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, 8, ["user_id"], attributes=["jsonString"])
    return view.render_view(_documents(spark, sf_dir), spec, "suppress=jsonString")


@query(
    "SELECT cast(0 AS int) AS port, cast(user_id AS varchar) AS partition, event_id AS row_id "
    f"FROM ({_BY_USER}) WHERE r > c - 4 UNION ALL "
    "SELECT cast(1 AS int), o_orderstatus, o_orderkey FROM "
    f"({_ranked('orders', 'o_orderstatus', 'o_orderdate, o_orderkey')}) WHERE (r - 1) // 8 = c // 8 - 1"
)
def view_two_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = {
        0: (table(spark, sf_dir, "events"), ViewSpec(ORDER, 4, ["user_id"]), "event_id"),
        1: (
            table(spark, sf_dir, "orders"),
            ViewSpec(["o_orderdate", "o_orderkey"], 8, ["o_orderstatus"], tumbling=True),
            "o_orderkey",
        ),
    }
    shown = []
    for number, (frame, spec, row_id) in ports.items():
        columns = frame.select(*spec.order, *spec.keys)
        shown.append(
            view.snapshot(columns, spec).select(
                F.lit(number).alias("port"),
                F.col(spec.keys[0]).cast("string").alias("partition"),
                F.col(row_id).alias("row_id"),
            )
        )
    return shown[0].unionByName(shown[1])


_XML = "CASE WHEN event_id % 4 = 0 THEN '' ELSE '<v>' || event_type || '</v>' END"


@query(
    f"SELECT user_id, {_XML} AS xml, ts AS arrived, {_XML} <> '' AS has_content FROM ({_BY_USER}) WHERE r = c"
)
def view_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).withColumn("xml", F.expr(_XML))
    return view.latest(rows, "xml", ORDER, "ts", ["user_id"])


ANSWER_SQL = (
    "WITH t AS (SELECT user_id, event_id, event_type, row_number() OVER "
    "(PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events), "
    "q AS (SELECT user_id, event_id AS request_id, r // 4 * 4 AS hi FROM t WHERE event_type = 'view') "
    "SELECT request_id, r - greatest(hi - 16, 0) AS position, event_id FROM q JOIN t USING (user_id) "
    "WHERE r <= hi AND r > hi - 16"
)


@query(ANSWER_SQL)
def answer_view_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    requests = events.where("event_type = 'view'").withColumn("request_id", F.col("event_id"))
    tuples = events.select(*ORDER, "user_id")
    spec = ViewSpec(ORDER, 16, ["user_id"], trigger=4)
    return view.answer_as_of(tuples, requests, spec).select("request_id", "position", "event_id")


# ---- any window behind a view -------------------------------------------------------


@query(
    "SELECT event_id, user_id FROM (SELECT *, max(ts) OVER (PARTITION BY user_id, event_type) AS m FROM events) "
    "WHERE ts > m - INTERVAL 2 DAY AND event_type = 'view'"
)
def view_query_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, keys=["user_id", "event_type"], named=True, window=view.SlidingTime(timedelta(days=2)))
    return view.read_view(_events(spark, sf_dir), spec, "event_type=view&attribute=event_id&attribute=user_id")


@query(
    "SELECT event_type, count(*) AS n, cast(to_json(list({event_id: event_id} ORDER BY ts, event_id)) AS varchar) AS json "
    "FROM (SELECT *, last_value(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS m FROM events) WHERE abs(m - event_id) <= 500 GROUP BY event_type"
)
def view_json_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ViewSpec(ORDER, keys=["event_type"], attributes=["event_id"], window=view.Delta("event_id", 500))
    return view.render_view(_events(spark, sf_dir), spec)


# ---- requests as of their own time ----------------------------------------------------


@query(
    "SELECT q.event_id AS request_id, row_number() OVER (PARTITION BY q.event_id ORDER BY t.ts, t.event_id) AS position, "
    "t.event_id FROM events q JOIN events t ON q.user_id = t.user_id AND t.ts > q.ts - INTERVAL 2 DAY "
    "AND (t.ts < q.ts OR (t.ts = q.ts AND t.event_id <= q.event_id)) WHERE q.event_type = 'view'"
)
def answer_sliding_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view event asks for the last two days of its user, as they were then."""
    events = _events(spark, sf_dir)
    requests = events.where("event_type = 'view'").withColumn("request_id", F.col("event_id"))
    spec = ViewSpec(ORDER, keys=["user_id"], window=view.SlidingTime(timedelta(days=2)))
    answers = view.answer_as_of(events.select(*ORDER, "user_id"), requests, spec)
    return answers.select("request_id", "position", "event_id")


@query(
    "WITH w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events) "
    "SELECT q.event_id AS request_id, row_number() OVER (PARTITION BY q.event_id ORDER BY t.ts, t.event_id) AS position, "
    "t.event_id FROM w q JOIN w t ON q.user_id = t.user_id AND t.w = q.w - INTERVAL 6 HOUR WHERE q.event_type = 'view'"
)
def answer_tumbling_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view event asks for its user's rows of the window that ended last."""
    events = _events(spark, sf_dir)
    requests = events.where("event_type = 'view'").withColumn("request_id", F.col("event_id"))
    spec = ViewSpec(ORDER, keys=["user_id"], window=view.TumblingTime(timedelta(hours=6)))
    answers = view.answer_as_of(events.select(*ORDER, "user_id"), requests, spec)
    return answers.select("request_id", "position", "event_id")


# customers send request texts to two ports: events by user and type, orders by status and priority
_TURN = "c_custkey % 40"
_ASKED_USER = "cast(c_custkey % 150 AS string)"
_ASKED_TYPE = "CASE c_custkey % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'error' END"
_EVENT_TEXT = (
    f"CASE WHEN {_TURN} = 0 THEN 'event_type=' || {_ASKED_TYPE} WHEN {_TURN} = 2 THEN 'attribute=event_id' "
    f"WHEN {_TURN} = 4 THEN 'user_id=x' WHEN {_TURN} < 14 THEN 'user_id=' || {_ASKED_USER} "
    f"WHEN {_TURN} < 24 THEN 'user_id=' || {_ASKED_USER} || '&suppress=event_type&callback=show' "
    f"ELSE 'event_type=' || {_ASKED_TYPE} || '&user_id=' || {_ASKED_USER} || '&attribute=event_type&attribute=event_id' END"
)
_ORDER_TEXT = (
    f"CASE WHEN {_TURN} = 1 THEN 'attribute=o_orderkey' WHEN {_TURN} = 3 THEN 'partition=O' "
    f"ELSE 'partition=' || {_STATUS} || '&partition=' || {_PRIORITY} END"
)
_ASKED_AT = (
    "CASE WHEN c_custkey % 2 = 0 THEN timestamp '2024-01-01 00:00:00' + {seconds} "
    "ELSE timestamp '1995-01-01 00:00:00' + {days} END"
)
_ASKED_AT_SQL = _ASKED_AT.format(
    seconds="to_seconds(c_custkey * 7919 % 2592000)", days="to_days(cast(c_custkey * 31 % 2400 AS integer))"
)
_TEXTS_SQL = (
    f"q AS (SELECT c_custkey AS request_id, cast(c_custkey % 2 AS integer) AS port, {_TURN} AS turn, {_ASKED_AT_SQL} AS asked_at, "
    f"{_ASKED_USER} AS u, {_ASKED_TYPE} AS t, {_STATUS} AS s, replace({_PRIORITY}, '+', ' ') AS p FROM customer)"
)


@query(
    f"WITH {_TEXTS_SQL}, "
    "e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events), "
    "m AS (SELECT request_id, turn, event_id, e.ts, event_type, r, max(r) OVER (PARTITION BY request_id, user_id, event_type) AS c "
    "FROM q JOIN e ON port = 0 AND e.ts <= asked_at AND turn NOT IN (2, 4) AND (turn = 0 OR cast(user_id AS varchar) = u) "
    "AND (turn BETWEEN 5 AND 23 OR event_type = t)), "
    "ea AS (SELECT request_id, count(*) AS n, string_agg(CASE WHEN turn = 0 OR turn < 14 THEN "
    "'{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' WHEN turn < 24 THEN '{\"event_id\":' || event_id || '}' "
    "ELSE '{\"event_type\":\"' || event_type || '\",\"event_id\":' || event_id || '}' END, ',' ORDER BY ts, event_id) AS rows "
    "FROM m WHERE r <= c // 2 * 2 AND r > c // 2 * 2 - 8 GROUP BY request_id), "
    "o AS (SELECT request_id, o_orderkey, o_orderdate, max(o_orderdate) OVER (PARTITION BY request_id, o_orderstatus, o_orderpriority) AS newest "
    "FROM q JOIN orders ON port = 1 AND o_orderdate <= asked_at AND turn <> 3 AND (turn = 1 OR (o_orderstatus = s AND o_orderpriority = p))), "
    "oa AS (SELECT request_id, count(*) AS n, string_agg('{\"o_orderkey\":' || o_orderkey || '}', ',' ORDER BY o_orderdate, o_orderkey) AS rows "
    "FROM o WHERE o_orderdate > newest - INTERVAL 30 DAY GROUP BY request_id), "
    "a AS (SELECT * FROM ea UNION ALL SELECT * FROM oa) "
    "SELECT request_id, port, coalesce(n, 0) AS n, CASE WHEN turn = 4 OR turn = 3 THEN '' WHEN turn BETWEEN 14 AND 23 AND port = 0 "
    "THEN 'show([' || coalesce(rows, '') || ']);' || chr(10) ELSE '[' || coalesce(rows, '') || ']' END AS json, "
    "CASE turn WHEN 4 THEN 'bad partition value for user_id' WHEN 3 THEN 'too few partition values' ELSE '' END AS error "
    "FROM q LEFT JOIN a USING (request_id)"
)
def answer_requests_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of two ports: a count window behind named keys, a sliding time window behind positional ones."""
    at = _ASKED_AT.format(
        seconds="make_dt_interval(0, 0, 0, c_custkey * 7919 % 2592000)", days="make_dt_interval(cast(c_custkey * 31 % 2400 AS int))"
    )
    requests = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS request_id",
        "cast(c_custkey % 2 AS int) AS port",
        f"{at} AS ts",
        f"CASE WHEN c_custkey % 2 = 0 THEN {_EVENT_TEXT} ELSE {_ORDER_TEXT} END AS query",
    )
    by_user = ViewSpec(
        ORDER, 8, ["user_id", "event_type"], trigger=2, named=True, force_empty=True, attributes=["event_id", "event_type"]
    )
    by_status = ViewSpec(_ORDERS.order, keys=_ORDER_KEYS, window=view.SlidingTime(timedelta(days=30)), attributes=["o_orderkey"])
    ports = {0: (_events(spark, sf_dir), by_user), 1: (table(spark, sf_dir, "orders"), by_status)}
    answers = as_of.answer_texts(ports, requests)
    return answers.withColumns({"json": F.coalesce("json", F.lit("")), "error": F.coalesce("error", F.lit(""))})
