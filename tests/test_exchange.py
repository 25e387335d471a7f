"""Requests, responses, forms."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wireglass.functions import http
from wireglass.functions.types import schema
from wireglass.operators import exchange, ingest
from wireglass.plans.buckets import measure
from wireglass.sources import RAW_REQUESTS

T0 = datetime(2024, 1, 1)
REQ8 = schema(
    [
        ("key", "int64"),
        ("method", "rstring"),
        ("request", "rstring"),
        ("contentType", "rstring"),
        ("contextPath", "rstring"),
        ("pathInfo", "rstring"),
        ("url", "rstring"),
        ("header", "map<rstring,rstring>"),
    ]
)


def analyzed(spark):
    base = "http://localhost:8080/RequestStream/ports/analyze/0"
    first, second = b"data=1234567890abcdefghijklmnopqrstuvwxyz11", b"data=1234567890abcdefghijklmnopqrstuvwxyz2"
    rows = [
        (7, T0, "GET", base + "/getpath", None, {"MyHeader": "MyValGet"}, b""),
        (8, T0 + timedelta(seconds=1), "POST", base + "/postpath1", http.FORM, {"Content-Length": "43", "MyHeader": "MyValPost1"}, first),
        (9, T0 + timedelta(seconds=1), "POST", base + "/postpath2", http.FORM, {"Content-Length": "42", "MyHeader": "MyValPost2"}, second),
    ]
    routed = ingest.route_requests(spark.createDataFrame(rows, RAW_REQUESTS))
    return exchange.assign_tracking_key(routed, ["ts", "request_id"])


def test_request_attributes(spark):
    rows = exchange.request_tuples(analyzed(spark), REQ8).orderBy("key").collect()
    assert [r["key"] for r in rows] == [1, 2, 3]
    assert [r["method"] for r in rows] == ["GET", "POST", "POST"]
    assert rows[0]["request"] == "" and rows[0]["contentType"] == ""
    assert rows[1]["request"] == "data=1234567890abcdefghijklmnopqrstuvwxyz11"
    assert rows[2]["contentType"] == "application/x-www-form-urlencoded"
    assert {r["contextPath"] for r in rows} == {"/RequestStream/ports"}
    assert [r["pathInfo"] for r in rows] == ["/getpath", "/postpath1", "/postpath2"]
    assert rows[1]["header"]["Content-Length"] == "43" and rows[2]["header"]["MyHeader"] == "MyValPost2"
    assert rows[0]["url"].endswith("/RequestStream/ports/analyze/0/getpath")


def test_request_names_and_projection(spark):
    port = schema([("k", "int64"), ("body", "ustring"), ("other", "int32")])
    named = exchange.request_tuples(analyzed(spark), port, keyAttributeName="k", requestAttributeName="body")
    assert named.columns == ["k", "body", "other"]
    assert sorted(r["k"] for r in named.collect()) == [1, 2, 3]
    assert {r["other"] for r in named.collect()} == {0}


def test_request_json_keeps_nulls(spark):
    rows = exchange.request_tuples(analyzed(spark), schema([("jsonString", "rstring")])).collect()
    documents = {d["key"]: d for d in (json.loads(r["jsonString"]) for r in rows)}
    assert documents[1]["contentType"] is None and documents[1]["request"] == ""
    assert documents[3]["header"]["MyHeader"] == "MyValPost2"
    assert set(documents[1]) == {"key", "request", "method", "contentType", "contextPath", "pathInfo", "url", "header"}


def test_payload(spark):
    cases = [("/p?one+two", "body", "one+two"), ("/p", "a\r\nb\nc", "abc"), ("/p?", "body", ""), ("/p#x?y", "b", "b")]
    df = spark.createDataFrame([(u, b.encode()) for u, b, _ in cases], "url string, body binary")
    found = df.select(exchange.request_payload(F.col("url"), F.col("body")).alias("p")).collect()
    assert [r["p"] for r in found] == [c[2] for c in cases]


def test_routing_by_path(spark):
    message = "Kind+of+event:+test+Seen"
    df = spark.createDataFrame([(p, message) for p in ("/text/loud", "/text/small", "/text/quiet", "/text/shout", "/x")], "pathInfo string, request string")
    request = F.col("request")
    lower = F.lower(request)
    routes = {"/text/loud": F.upper(request), "/text/small": lower, "/text/quiet": lower, "/text/shout": F.upper(request)}
    found = {r["pathInfo"]: r["response"] for r in exchange.route_by_path(df, routes).collect()}
    assert found == {
        "/text/loud": "KIND+OF+EVENT:+TEST+SEEN",
        "/text/small": "kind+of+event:+test+seen",
        "/text/quiet": "kind+of+event:+test+seen",
        "/text/shout": "KIND+OF+EVENT:+TEST+SEEN",
    }


@pytest.mark.parametrize("size", [100, 10_000, 100_000])
def test_large_answers(spark, size):
    row = spark.createDataFrame([("a",)], "r string").select(exchange.reflect(F.col("r"), size).alias("o")).first()
    assert len(row["o"]) == size + 1


JSON_RESPONSES = {
    '{"key":1,"response":"r","status":201,"contentType":"text/plain","header":{"A":"b","C":"d"}}': (1, 201, "r", "text/plain", {"A": "b", "C": "d"}),
    '{"key":2}': (2, 200, "", "text/html; charset=utf-8", {}),
    '{"key":3,"response":null,"status":null,"header":null,"contentType":""}': (3, 200, "", "", {}),
    '{"key":4,"status":"x"}': (4, 400, "", "text/html; charset=utf-8", {}),
    '{"key":5,"header":{"A":1}}': (5, 400, "", "text/html; charset=utf-8", {}),
    '{"key":6,"header":{}}': (6, 200, "", "text/html; charset=utf-8", {}),
    '{"key":"7"}': None,
    '{"key":7.5}': None,
    '{"response":"x"}': None,
    "[1]": None,
    "broken": None,
}


def test_json_responses(spark):
    df = spark.createDataFrame([(t,) for t in JSON_RESPONSES], "jsonString string")
    for row, wanted in zip(exchange.response_from_json(df).collect(), JSON_RESPONSES.values()):
        if wanted is None:
            assert row["error"] == "missing tracking key", row
        else:
            assert (row["key"], row["status"], row["response"], row["contentType"], row["header"]) == wanted
            assert row["error"] is None


def frames(spark, seed=1):
    """Requests and responses with a key that most responses carry."""
    rng = random.Random(seed)
    requests = [(k, T0 + timedelta(seconds=k * 7)) for k in range(1, 41)]
    responses = []
    for number in range(300):
        key = 3 if rng.random() < 0.4 else rng.randrange(-5, 45)
        at = T0 + timedelta(seconds=key * 7 + rng.choice([-2, 0, 0, 5, 14, 15, 16, 40, number]))
        responses.append((key, at, number, f"r{number}", rng.choice([200, 404, 99, 600, None])))
    return (
        requests,
        responses,
        spark.createDataFrame(requests, "key long, req_ts timestamp"),
        spark.createDataFrame(responses, "key long, rsp_ts timestamp, rsp_id long, response string, status int"),
    )


def replay(requests, responses, timeout=15):
    chosen = {}
    for key, at in requests:
        inside = [r for r in responses if r[0] == key and at <= r[1] < at + timedelta(seconds=timeout)]
        chosen[key] = min(inside, key=lambda r: (r[1], r[2])) if inside else None
    return chosen


def test_correlation_against_replay(spark):
    requests, responses, asked, told = frames(spark)
    chosen = replay(requests, responses)
    found = {r["key"]: r for r in exchange.correlate(asked, told).collect()}
    assert len(found) == len(requests)
    for key, at in requests:
        row, best = found[key], chosen[key]
        if best is None:
            assert (row["status"], row["outcome"], row["rsp_id"]) == (408, "timeout", None)
            assert row["done_ts"] == at + timedelta(seconds=15)
        else:
            valid = best[4] is not None and 100 <= best[4] <= 599
            assert row["rsp_id"] == best[2] and row["done_ts"] == best[1]
            assert row["status"] == (best[4] if valid else 500)
            assert row["outcome"] == ("responded" if valid else "error")
    used = {c[2] for c in chosen.values() if c}
    left = {r["rsp_id"] for r in exchange.unmatched_responses(asked, told).collect()}
    assert left == {r[2] for r in responses} - used
    late = exchange.timeouts(asked, told)
    assert {r["key"] for r in late.collect()} == {k for k, c in chosen.items() if c is None}
    counters = exchange.metrics(asked, told.withColumn("error", F.when(F.col("rsp_id") < 5, "missing tracking key"))).first()
    assert counters["received"] == 40 and counters["missing_key"] == 5
    assert counters["responded"] + counters["errors"] + counters["timeouts"] == 40
    assert counters["key_not_found"] == 295 - counters["responded"] - counters["errors"]


@pytest.mark.parametrize("per_bucket", [2, 1000])
def test_gauge_and_order(spark, per_bucket):
    _, _, asked, told = frames(spark, 2)
    answers = exchange.correlate(asked, told)
    rows = answers.collect()
    layout = measure(asked, "req_ts", per_bucket)
    events = sorted([(r["req_ts"], 1, r["key"]) for r in rows] + [(r["done_ts"], -1, r["key"]) for r in rows])
    gauge = {(r["ts"], r["delta"], r["key"]): r["active"] for r in exchange.active_gauge(answers, layout).collect()}
    level = 0
    for event in events:
        level += event[1]
        assert gauge[event] == level
    done = sorted((r["req_ts"], r["key"], r["done_ts"]) for r in rows if r["outcome"] != "timeout")
    order = {r["key"]: r for r in exchange.completion_order(answers, layout).collect()}
    latest = None
    for number, (_, key, finished) in enumerate(done, 1):
        assert order[key]["arrival_no"] == number
        assert order[key]["overtook"] == (latest is not None and finished < latest)
        latest = max(latest or finished, finished)
    assert sorted(r["completion_no"] for r in order.values()) == list(range(1, len(done) + 1))


def test_slow_requests_answer_in_completion_order(spark):
    # four requests that take 8, 4, 2 and 1 seconds
    asked = spark.createDataFrame([(i, T0 + timedelta(milliseconds=i)) for i in range(1, 5)], "key long, req_ts timestamp")
    told = spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s), i, "x", 200) for i, s in zip(range(1, 5), (8, 4, 2, 1))],
        "key long, rsp_ts timestamp, rsp_id long, response string, status int",
    )
    order = exchange.completion_order(exchange.correlate(asked, told)).orderBy("completion_no").collect()
    assert [r["key"] for r in order] == [4, 3, 2, 1]
    assert [r["overtook"] for r in order] == [True, True, True, False]


FORMS = {
    "name=Bo&password=x&profession=cook": ({"name": "Bo", "password": "x", "profession": "cook"}, "", 200, ""),
    "name=Bo&password=&profession=cook": ({"name": "Bo", "password": "", "profession": "cook"}, "", 401, ""),
    "name=&password=x&profession=cook": ({"name": "", "password": "x", "profession": "cook"}, "", 400, "ERROR-nameRequired"),
    "name=Bo": ({"name": "Bo"}, "", 400, "ERROR-notRequiredParams"),
    "name=a&name=b=c&flag": ({"name": "b", "flag": ""}, "", 400, "ERROR-notRequiredParams"),
    "=x": ({"": "x"}, "", 400, "ERROR-notRequiredParams"),
    "": ({}, "ERROR-noFormData", 400, "ERROR-noFormData"),
    "a=1&&b=2": ({"a": "1", "b": "2"}, "ERROR-nameValueParse", 400, "ERROR-nameValueParse"),
}


def test_forms(spark):
    df = spark.createDataFrame([(f,) for f in FORMS], "request string")
    for row, wanted in zip(exchange.form_status(exchange.form_to_map(df)).collect(), FORMS.values()):
        assert (row["formdata"], row["error"], row["status"], row["response"]) == wanted


def test_template_is_literal(spark):
    df = spark.createDataFrame([("$1 .*", "cook")], "n string, p string")
    page = exchange.render_template(F.lit("%name% %name% %profession% %other%"), {"name": F.col("n"), "profession": F.col("p")})
    assert df.select(page.alias("t")).first()["t"] == "$1 .* $1 .* cook %other%"


def test_markers_and_json_tuples(spark):
    marked = spark.createDataFrame([(1, False), (2, True), (3, None)], "key long, is_punct boolean")
    assert [r["key"] for r in exchange.drop_markers(marked).collect()] == [1, 3]
    assert exchange.drop_markers(marked.drop("is_punct")).count() == 3
    port = schema([("a", "int32"), ("b", "rstring")])
    texts = spark.createDataFrame([('{"a":1,"b":"x","c":2}',), ('{"a":"x"}',), ("{}",), ("no",)], "jsonString string")
    rows = exchange.json_to_tuple(texts, port).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (0, ""), (0, ""), (0, "")]
    assert [r["error"] is not None for r in rows] == [False, True, False, True]
    back = exchange.tuple_to_json(rows and exchange.json_to_tuple(texts, port), ["a", "b"]).first()
    assert json.loads(back["jsonString"]) == {"a": 1, "b": "x"}


def test_a_response_delivered_again_answers_once(spark):
    at = datetime(2024, 1, 1)
    asked = spark.createDataFrame([(1, at), (2, at)], "key long, req_ts timestamp_ntz")
    one = (1, at, 10, "a", 200, {"h": "1"})
    rows = [one] * 5 + [(1, at, 10, "b", 404, None), (1, at + timedelta(seconds=1), 11, "c", 200, None), (9, at, 12, "x", 200, None), (9, at, 12, "x", 200, None)]
    told = spark.createDataFrame(rows, "key long, rsp_ts timestamp_ntz, rsp_id long, response string, status int, header map<string,string>").repartition(3)
    answers = {r["key"]: (r["outcome"], r["response"]) for r in exchange.correlate(asked, told).collect()}
    assert answers == {1: ("responded", "a"), 2: ("timeout", "")}
    assert exchange.correlate(asked, told).count() == 2
    counters = exchange.metrics(asked, told).first()
    assert (counters["received"], counters["responded"], counters["timeouts"], counters["key_not_found"]) == (2, 1, 1, 8)
    left = sorted((r["rsp_id"], r["response"]) for r in exchange.unmatched_responses(asked, told).collect())
    assert left == [(10, "a")] * 4 + [(10, "b"), (11, "c"), (12, "x"), (12, "x")]
