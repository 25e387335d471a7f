"""Traffic derived from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, so both sides
of a comparison start from the same rows. Whole tables are used throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.queries.registry import table

ORDER = ["ts", "event_id"]


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def _derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


_ID = "cast(event_id AS string)"
_USER = "cast(user_id AS string)"

# ---- inject requests: every event is posted to one of two ports ------------------

_FORM_BODY = (
    "'event_type=' || event_type || '&value=' || "
    "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'x1.5' ELSE cast(value AS string) END || "
    "CASE WHEN event_id % 13 = 0 THEN '&event_type=again&flag=TRUE' ELSE '' END"
)
_XML_BODY = (
    "CASE WHEN event_id % 9 = 0 THEN '<e>' || event_type WHEN event_id % 10 = 6 THEN '' "
    "ELSE '<e id=\"' || " + _ID + " || '\">' || event_type || '</e>' END"
)
REQ = {
    "request_id": "event_id",
    "ts": "ts",
    "method": "CASE event_id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' ELSE 'POST' END",
    "url": (
        "'http://h.example.com/ctx/op' || cast(event_id % 3 AS string) || '/ports/output/' || "
        f"cast(event_id % 2 AS string) || '/inject?event_id=' || {_ID} || '&user_id=' || {_USER}"
    ),
    "content_type": (
        "CASE event_id % 5 WHEN 0 THEN 'application/json' WHEN 1 THEN 'application/xml; charset=utf-8' "
        "WHEN 2 THEN 'application/octet-stream' WHEN 3 THEN 'application/x-www-form-urlencoded' "
        "ELSE 'application/x-www-form-urlencoded; charset=UTF-8' END"
    ),
    "body": (
        f"CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN {_XML_BODY} "
        f"WHEN 2 THEN props || event_type ELSE {_FORM_BODY} END"
    ),
    "user_id": "user_id",
}
REQ_SQL = f"SELECT {_select(REQ)} FROM events"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw requests: one post per event."""
    rows = _derive(table(spark, sf_dir, "events"), REQ)
    return rows.withColumns(
        {
            "body": F.encode("body", "UTF-8"),
            "headers": F.create_map(
                F.lit("Content-Type"), "content_type", F.lit("X-User"), F.col("user_id").cast("string")
            ),
        }
    ).drop("user_id")


# ---- hits: URLs of all kinds ------------------------------------------------------

_HIT_URL = (
    "'http://h.example.com' || CASE event_id % 8 "
    f"WHEN 0 THEN '/ctx/op/ports/output/0/inject?a=' || {_ID} "
    f"WHEN 1 THEN '/my.flow.op/ports/output/12/form?a=' || {_ID} "
    "WHEN 2 THEN '/ctx/view/ports/input/0/tuples' "
    f"WHEN 3 THEN '/my.flow.view/ports/input/1/attribute?x#frag' || {_ID} "
    f"WHEN 4 THEN '/RequestStream/ports/analyze/0/get/' || event_type || '?q=' || {_USER} || '+a%20b' "
    "WHEN 5 THEN '/base/Exchange/ports/analyze/0' "
    "WHEN 6 THEN '/ctx/ws/ports/output/0/wsinject' "
    "ELSE '/ctx/op/ports/output/0/nothing' END"
)
HITS = {
    "request_id": "event_id",
    "ts": "ts",
    "method": "CASE event_id % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' ELSE 'PUT' END",
    "url": _HIT_URL,
    "content_type": "CASE event_id % 3 WHEN 0 THEN NULL ELSE 'application/x-www-form-urlencoded' END",
    "body": f"'data=' || {_ID} || '&t=' || event_type",
    "user_id": "user_id",
}
HITS_SQL = f"SELECT {_select(HITS)} FROM events"


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event, over all URL forms."""
    rows = _derive(table(spark, sf_dir, "events"), HITS)
    return rows.withColumns(
        {
            "body": F.encode("body", "UTF-8"),
            "headers": F.create_map(F.lit("X-User"), F.col("user_id").cast("string")),
        }
    ).drop("user_id")


# ---- request and response ----------------------------------------------------------

ASKED = {"key": "event_id + 1", "req_ts": "ts", "user_id": "user_id"}
ASKED_SQL = f"SELECT {_select(ASKED)} FROM events"

_RSP_STATUS = "CASE WHEN event_id % 19 = 0 THEN 700 WHEN event_id % 5 = 0 THEN 404 ELSE 200 END"


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "events"), ASKED)


def _responses(key: str, ts: str, rsp_id: str, text: str) -> dict[str, str]:
    return {
        "key": key,
        "rsp_ts": ts,
        "rsp_id": rsp_id,
        "response": f"'{text} ' || event_type",
        "status": _RSP_STATUS,
    }


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses: most after `value` seconds, some with a second one, some delivered again, some with an unknown key."""
    events = table(spark, sf_dir, "events")
    due = "ts + make_dt_interval(0, 0, 0, cast(value AS decimal(18, 6)))"
    known = events.where("event_id % 17 <> 0")
    first = _derive(known, _responses("event_id + 1", due, "event_id * 2", "first"))
    second = _derive(known.where("event_id % 10 = 0"), _responses("event_id + 1", f"{due} + interval 1 second", "event_id * 2 + 1", "second"))
    stray = _derive(events.where("event_id % 17 = 0"), _responses("-(event_id + 1)", "ts", "event_id * 2", "stray"))
    again = first.where("key % 13 = 0").unionByName(first.where("key % 26 = 0")).unionByName(stray.where("key % 13 = 0"))
    return first.unionByName(second).unionByName(stray).unionByName(again)


def _told_sql() -> str:
    due = "ts + to_microseconds(cast(round(value * 1000000) AS bigint))"
    first = _responses("event_id + 1", due, "event_id * 2", "first")
    second = _responses("event_id + 1", f"{due} + INTERVAL 1 SECOND", "event_id * 2 + 1", "second")
    stray = _responses("-(event_id + 1)", "ts", "event_id * 2", "stray")
    answered = f"SELECT {_select(first)} FROM events WHERE event_id % 17 <> 0"
    unknown = f"SELECT {_select(stray)} FROM events WHERE event_id % 17 = 0"
    return (
        f"{answered} UNION ALL {answered} AND (event_id + 1) % 13 = 0 UNION ALL {answered} AND (event_id + 1) % 26 = 0 UNION ALL "
        f"SELECT {_select(second)} FROM events WHERE event_id % 17 <> 0 AND event_id % 10 = 0 UNION ALL "
        f"{unknown} UNION ALL {unknown} AND (event_id + 1) % 13 = 0"
    )


TOLD_SQL = _told_sql()

# ---- WebSocket -------------------------------------------------------------------

_SESSION = "'10.0.0.' || cast(user_id % 250 AS string) || ':' || " + _USER

SESSION_EVENTS = {
    "session_key": _SESSION,
    "ts": "ts",
    "event_id": "event_id",
    "kind": "CASE event_type WHEN 'signup' THEN 'open' ELSE 'close' END",
}
SESSION_WHERE = "event_type IN ('signup', 'error')"
SESSION_SQL = f"SELECT {_select(SESSION_EVENTS)} FROM events WHERE {SESSION_WHERE}"

MESSAGES = {
    "session_key": _SESSION,
    "ts": "ts",
    "event_id": "event_id",
    "kind": "CASE WHEN event_id % 6 = 0 THEN 'binary' ELSE 'text' END",
    "payload": f"event_type || '#' || {_ID}",
}
MESSAGE_WHERE = "event_type IN ('view', 'click')"
MESSAGE_SQL = f"SELECT {_select(MESSAGES)} FROM events WHERE {MESSAGE_WHERE}"

FRAMES = {
    "session_key": _SESSION,
    "ts": "ts",
    "seq": "event_id",
    "kind": (
        "CASE WHEN event_type = 'signup' THEN 'open' WHEN event_type = 'error' THEN 'close' "
        "WHEN event_id % 6 = 0 THEN 'binary' ELSE 'text' END"
    ),
    "fin": "event_id % 3 <> 0",
    "payload": f"event_type || '#' || {_ID} || ';'",
}
FRAMES_SQL = f"SELECT {_select(FRAMES)} FROM events"


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "events").where(SESSION_WHERE), SESSION_EVENTS)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _derive(table(spark, sf_dir, "events").where(MESSAGE_WHERE), MESSAGES)
    return rows.withColumn("payload", F.encode("payload", "UTF-8"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _derive(table(spark, sf_dir, "events"), FRAMES)
    return rows.withColumn("payload", F.encode("payload", "UTF-8"))


# ---- positions --------------------------------------------------------------------

POSITIONS = {
    "id": "user_id",
    "layer": "CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'L' || cast(user_id % 3 AS string) END",
    "longitude": "cast(event_id % 360 - 180 AS double)",
    "latitude": "cast(user_id % 170 - 85 AS double)",
    "ts": "ts",
    "event_id": "event_id",
}
POSITION_WHERE = "event_type = 'purchase'"
POSITION_SQL = f"SELECT {_select(POSITIONS)} FROM events WHERE {POSITION_WHERE}"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "events").where(POSITION_WHERE), POSITIONS)
