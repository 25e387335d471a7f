"""Request and response queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.functions import http
from wireglass.functions.types import schema
from wireglass.operators import exchange, ingest
from wireglass.plans.buckets import measure
from wireglass.queries import derive
from wireglass.queries.registry import query, table
from wireglass.session import landed

# ---- request side --------------------------------------------------------------------


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS key FROM events")
def tracking_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(*derive.ORDER)
    return exchange.assign_tracking_key(events, derive.ORDER).select("event_id", "key")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS key FROM orders")
def tracking_key_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in the order of a day that many orders share."""
    order = ["o_orderdate", "o_orderkey"]
    return exchange.assign_tracking_key(table(spark, sf_dir, "orders").select(*order), order).select("o_orderkey", "key")


@query(
    "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'q=' || conv_id || '+x%20' ELSE "
    "replace(replace(text, chr(10), ''), chr(13), '') END AS payload FROM conversations"
)
def request_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = "'http://h/op/ports/analyze/0/p' || CASE WHEN turn % 3 = 0 THEN '?q=' || conv_id || '+x%20' ELSE '' END"
    posts = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.expr(url).alias("url"), F.encode("text", "UTF-8").alias("body")
    )
    return posts.select("conv_id", "turn", exchange.request_payload(F.col("url"), F.col("body")).alias("payload"))


_ANALYZED_SQL = (
    f"hit AS ({derive.HITS_SQL}), "
    "a AS (SELECT h.*, request_id % 8 = 4 AS get, e.event_type AS et FROM hit h JOIN events e ON e.event_id = h.request_id "
    "WHERE request_id % 8 IN (4, 5)), "
    "f AS (SELECT request_id + 1 AS key, method, "
    "CASE WHEN get THEN 'q=' || user_id || '+a%20b' ELSE body END AS request, content_type, "
    "CASE WHEN get THEN '/RequestStream/ports' ELSE '/base/Exchange/ports' END AS context_path, "
    "CASE WHEN get THEN '/get/' || et ELSE NULL END AS path_info, "
    "regexp_replace(url, '[?].*', '') AS url, user_id FROM a)"
)


def _analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ingest.route_requests(derive.hits(spark, sf_dir)).where("action = 'analyze'")
    return routed.withColumn("key", F.col("request_id") + 1)


@query(
    f"WITH {_ANALYZED_SQL} SELECT key, method, request, coalesce(content_type, '') AS \"contentType\", "
    "context_path AS \"contextPath\", coalesce(path_info, '') AS \"pathInfo\", url, 'X-User=' || user_id AS header, "
    "cast(0 AS int) AS status FROM f"
)
def request_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    port = schema(
        [
            ("key", "int64"),
            ("method", "rstring"),
            ("request", "rstring"),
            ("contentType", "rstring"),
            ("contextPath", "rstring"),
            ("pathInfo", "rstring"),
            ("url", "rstring"),
            ("header", "map<rstring,rstring>"),
            ("status", "int32"),
        ]
    )
    tuples = exchange.request_tuples(_analyzed(spark, sf_dir), port)
    return tuples.withColumn("header", http.map_text(F.col("header")))


@query(
    f"WITH {_ANALYZED_SQL} SELECT key, cast(to_json({{key: key, request: request, method: method, "
    "contentType: content_type, contextPath: context_path, pathInfo: path_info, url: url, "
    "header: {'X-User': cast(user_id AS varchar)}}) AS varchar) AS json FROM f"
)
def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.request_json(_analyzed(spark, sf_dir))


# ---- response side ---------------------------------------------------------------------

_DOCUMENT = (
    "CASE event_id % 10 "
    "WHEN 0 THEN '{\"key\": ' || cast(event_id AS string) || ', \"response\": \"' || event_type || '\"}' "
    "WHEN 1 THEN '{\"key\": \"' || cast(event_id AS string) || '\", \"response\": \"text key\"}' "
    "WHEN 2 THEN '{\"response\": \"no key\"}' "
    "WHEN 3 THEN 'not json' "
    "WHEN 4 THEN '{\"key\": ' || cast(event_id AS string) || ', \"status\": \"404\"}' "
    "WHEN 5 THEN '{\"key\": ' || cast(event_id AS string) || ', \"status\": 404, \"contentType\": \"text/plain\"}' "
    "WHEN 6 THEN '{\"key\": ' || cast(event_id AS string) || ', \"header\": {\"A\": \"' || event_type || '\"}}' "
    "WHEN 7 THEN '{\"key\": ' || cast(event_id AS string) || ', \"response\": null, \"status\": null}' "
    "WHEN 8 THEN '{\"key\": ' || cast(event_id AS string) || ', \"response\": 5}' "
    "ELSE '{\"key\": ' || cast(event_id AS string) || ', \"header\": [1], \"contentType\": \"x\"}' END"
)


@query(
    "WITH d AS (SELECT event_id, event_type, event_id % 10 AS c FROM events) "
    "SELECT event_id, CASE WHEN c IN (1, 2, 3) THEN NULL ELSE event_id END AS key, "
    "CASE c WHEN 0 THEN event_type WHEN 1 THEN 'text key' WHEN 2 THEN 'no key' ELSE '' END AS response, "
    "cast(CASE WHEN c IN (4, 8, 9) THEN 400 WHEN c = 5 THEN 404 ELSE 200 END AS int) AS status, "
    "CASE WHEN c = 5 THEN 'text/plain' ELSE 'text/html; charset=utf-8' END AS \"contentType\", "
    "CASE WHEN c = 6 THEN 'A=' || event_type ELSE '' END AS header, "
    "CASE WHEN c IN (1, 2, 3) THEN 'missing tracking key' ELSE '' END AS error FROM d"
)
def response_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "events").selectExpr("event_id", f"{_DOCUMENT} AS jsonString")
    decoded = exchange.response_from_json(documents)
    return decoded.select(
        "event_id",
        "key",
        "response",
        "status",
        "contentType",
        http.map_text(F.col("header")).alias("header"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


@query(
    "SELECT event_id AS key, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS response, "
    "cast(CASE WHEN event_id % 3 = 0 THEN 200 ELSE 201 END AS int) AS status, "
    "CASE WHEN event_id % 5 < 2 THEN 'text/html; charset=utf-8' ELSE 'text/plain' END AS \"contentType\", "
    "'' AS header FROM events"
)
def response_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id AS key",
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS response",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 201 END AS status",
        "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'text/plain' END AS contentType",
    )
    filled = exchange.response_defaults(rows)
    return filled.withColumn("header", http.map_text(F.col("header")))


# ---- correlation -------------------------------------------------------------------------

_MATCH_SQL = (
    f"req AS ({derive.ASKED_SQL}), rsp AS ({derive.TOLD_SQL}), "
    "pairs AS (SELECT r.key, s.rsp_id, s.rsp_ts, s.response, s.status, "
    "row_number() OVER (PARTITION BY r.key ORDER BY s.rsp_ts, s.rsp_id) AS n FROM req r JOIN rsp s ON r.key = s.key "
    "AND s.rsp_ts >= r.req_ts AND s.rsp_ts < r.req_ts + INTERVAL 15 SECOND), "
    "cor AS (SELECT r.key, r.req_ts, CASE WHEN p.key IS NULL THEN 408 WHEN p.status > 599 THEN 500 ELSE p.status END AS status, "
    "CASE WHEN p.key IS NULL THEN 'timeout' WHEN p.status > 599 THEN 'error' ELSE 'responded' END AS outcome, "
    "CASE WHEN p.key IS NULL THEN '' WHEN p.status > 599 THEN 'invalid status' ELSE p.response END AS response, "
    "coalesce(p.rsp_ts, r.req_ts + INTERVAL 15 SECOND) AS done_ts, p.rsp_id "
    "FROM req r LEFT JOIN pairs p ON p.key = r.key AND p.n = 1)"
)
_COR = "key, req_ts, cast(status AS int) AS status, outcome, response, done_ts, rsp_id"
CORRELATE_SQL = f"WITH {_MATCH_SQL} SELECT {_COR} FROM cor"


def _frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return derive.asked(spark, sf_dir).select("key", "req_ts"), derive.told(spark, sf_dir)


def _correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.correlate(*_frames(spark, sf_dir))


@query(CORRELATE_SQL)
def correlate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _correlated(spark, sf_dir)


@query(f"WITH {_MATCH_SQL} SELECT key, req_ts, done_ts FROM cor WHERE outcome = 'timeout'")
def timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.timeouts(*_frames(spark, sf_dir)).select("key", "req_ts", "done_ts")


@query(
    f"WITH {_MATCH_SQL}, copies AS (SELECT *, row_number() OVER (PARTITION BY key, rsp_ts, rsp_id) AS copy FROM rsp) "
    "SELECT key, rsp_ts, rsp_id, response FROM copies WHERE copy > 1 OR rsp_id NOT IN (SELECT rsp_id FROM cor WHERE rsp_id IS NOT NULL)"
)
def unmatched_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.unmatched_responses(*_frames(spark, sf_dir)).select("key", "rsp_ts", "rsp_id", "response")


@query(
    f"WITH {_MATCH_SQL} SELECT count(*) AS received, count(*) FILTER (outcome = 'responded') AS responded, "
    "count(*) FILTER (outcome = 'error') AS errors, count(*) FILTER (outcome = 'timeout') AS timeouts, "
    "cast(0 AS bigint) AS missing_key, (SELECT count(*) FROM rsp) - count(rsp_id) AS key_not_found FROM cor"
)
def request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.metrics(*_frames(spark, sf_dir))


@query(
    f"WITH {_MATCH_SQL}, ev AS (SELECT key, req_ts AS ts, 1 AS delta FROM cor UNION ALL SELECT key, done_ts, -1 FROM cor) "
    "SELECT key, ts, cast(delta AS int) AS delta, cast(sum(delta) OVER (ORDER BY ts, delta, key) AS bigint) AS active FROM ev"
)
def active_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = landed(_correlated(spark, sf_dir).select("key", "req_ts", "done_ts"), "answers")
    return exchange.active_gauge(answers, measure(answers, "req_ts"))


@query(
    f"WITH {_MATCH_SQL} SELECT key, row_number() OVER (ORDER BY req_ts, key) AS arrival_no, "
    "row_number() OVER (ORDER BY done_ts, key) AS completion_no, coalesce(done_ts < max(done_ts) OVER "
    "(ORDER BY req_ts, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS overtook "
    "FROM cor WHERE outcome <> 'timeout'"
)
def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = landed(_correlated(spark, sf_dir).select("key", "req_ts", "done_ts", "outcome"), "answers")
    ordered = exchange.completion_order(answers, measure(answers, "req_ts"))
    return ordered.select("key", "arrival_no", "completion_no", "overtook")


# ---- routing and forms ---------------------------------------------------------------------

_PATH_INFO = (
    "CASE event_type WHEN 'view' THEN '/text/loud' WHEN 'click' THEN '/text/small' WHEN 'error' THEN '/text/quiet' "
    "WHEN 'signup' THEN '/echo/padded' ELSE '/else' END"
)
_PAYLOAD = "'Kind+of+event:+' || event_type || '+Seen'"


@query(
    "SELECT event_id, CASE event_type WHEN 'view' THEN upper(p) WHEN 'signup' THEN p || repeat('X', 100) ELSE lower(p) "
    f"END AS response FROM (SELECT *, {_PAYLOAD} AS p FROM events) WHERE event_type <> 'purchase'"
)
def route_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_PATH_INFO} AS pathInfo", f"{_PAYLOAD} AS request")
    request = F.col("request")
    routes = {
        "/text/loud": F.upper(request),
        "/text/small": F.lower(request),
        "/text/quiet": F.lower(request),
        "/echo/padded": exchange.reflect(request, 100),
    }
    return exchange.route_by_path(rows, routes).select("event_id", "response")


_FORM = (
    "CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN 'a=1&&b=2' ELSE "
    "'name=first&name=' || CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_name END || "
    "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '&password=' || CASE WHEN c_nationkey = 3 THEN '' ELSE 's=' || c_nationkey END END || "
    "'&profession=' || c_mktsegment || '&flag' END"
)
_FORM_PARTS = (
    "p AS (SELECT c_custkey AS key, c_custkey % 23 = 0 AS none, c_custkey % 23 <> 0 AND c_custkey % 19 = 0 AS broken, "
    "c_custkey % 7 <> 0 AS has_pw, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_name END AS name, "
    "CASE WHEN c_nationkey = 3 THEN '' ELSE 's' END AS pw, c_mktsegment AS job FROM customer), "
    "s AS (SELECT *, CASE WHEN none OR broken OR NOT has_pw OR name = '' THEN 400 WHEN pw = '' THEN 401 ELSE 200 END AS st FROM p)"
)


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", f"{_FORM} AS request")
    return exchange.form_to_map(posts)


@query(
    f"WITH {_FORM_PARTS} SELECT key, CASE WHEN none THEN '' WHEN broken THEN 'a=1|b=2' ELSE 'flag=|name=' || name || "
    "CASE WHEN has_pw THEN '|password=' || pw ELSE '' END || '|profession=' || job END AS formdata, "
    "CASE WHEN none THEN 'ERROR-noFormData' WHEN broken THEN 'ERROR-nameValueParse' ELSE '' END AS error FROM s"
)
def form_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms(spark, sf_dir).select("key", http.map_text(F.col("formdata")).alias("formdata"), "error")


@query(
    f"WITH {_FORM_PARTS} SELECT key, cast(st AS int) AS status, CASE WHEN none THEN 'ERROR-noFormData' "
    "WHEN broken THEN 'ERROR-nameValueParse' WHEN NOT has_pw THEN 'ERROR-notRequiredParams' "
    "WHEN name = '' THEN 'ERROR-nameRequired' ELSE '' END AS response FROM s"
)
def form_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.form_status(_forms(spark, sf_dir)).select("key", "status", "response")


_TEMPLATE = "<p>%name% is a %profession%, says %name%.</p>"


@query(
    f"WITH {_FORM_PARTS} SELECT key, '<p>' || name || ' is a ' || job || ', says ' || name || '.</p>' AS page "
    "FROM s WHERE st = 200"
)
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = exchange.form_status(_forms(spark, sf_dir)).where("status = 200")
    form = F.col("formdata")
    page = exchange.render_template(F.lit(_TEMPLATE), {"name": form["name"], "profession": form["profession"]})
    return good.select("key", page.alias("page"))


@query(
    "SELECT a.conv_id, a.turn, a.text AS request, b.text AS response FROM conversations a LEFT JOIN conversations b "
    "ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' WHERE a.role = 'user'"
)
def pair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.pair_turns(table(spark, sf_dir, "conversations"))


# ---- JSON text ---------------------------------------------------------------------------------

_JSON_TEXT = "CASE WHEN event_id % 9 = 0 THEN 'broken ' || props WHEN event_id % 9 = 1 THEN '{}' ELSE props END"


@query(
    "SELECT event_id, cast(CASE WHEN event_id % 9 < 2 THEN 0 ELSE cast(json_extract(props, '$.k') AS int) END AS int) AS k, "
    "'' AS note, CASE WHEN event_id % 9 = 0 THEN 'not a tuple' ELSE '' END AS error FROM events"
)
def json_to_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"{_JSON_TEXT} AS jsonString")
    tuples = exchange.json_to_tuple(texts, schema([("k", "int32"), ("note", "rstring")]))
    return tuples.select("event_id", "k", "note", F.coalesce("error", F.lit("")).alias("error"))


@query(
    "SELECT event_id, cast(to_json({event_id: event_id, event_type: event_type, user_id: user_id}) AS varchar) "
    "AS \"jsonString\" FROM events"
)
def tuple_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return exchange.tuple_to_json(events, ["event_id", "event_type", "user_id"]).select("event_id", "jsonString")
