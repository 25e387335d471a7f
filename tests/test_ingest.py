"""Requests to tuples."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wireglass.functions import http
from wireglass.functions.types import SPARK_TYPES, coerce, coerce_or_default, schema
from wireglass.operators import ingest
from wireglass.sources import RAW_REQUESTS, read_blobs, read_landed, write_frame

TS = datetime(2024, 1, 1)
FORM2 = schema([("a", "int32"), ("b", "rstring")])
SENTENCE = "It's a beautiful thing, the destruction of words."


def post(spark, *posts):
    rows = []
    for number, p in enumerate(posts):
        body = p.get("body", b"")
        rows.append(
            (
                number,
                TS,
                p.get("method", "POST"),
                p.get("url", "http://h/ctx/Op/ports/output/0/inject"),
                p.get("type", http.FORM),
                p.get("headers", {"Content-Type": "x"}),
                body if isinstance(body, bytes) else body.encode(),
            )
        )
    return spark.createDataFrame(rows, RAW_REQUESTS)


def test_form_posts(spark):
    sentence = "It%27s+a+beautiful+thing%2C+the+destruction+of+words."
    requests = post(
        spark,
        {},
        {"body": f"b={sentence}"},
        {"body": f"a=73&b={sentence}"},
        {"method": "GET", "url": "/Op/ports/output/0/inject?a=%2B5&b=&b=later"},
        {"url": "/Op/ports/output/0/inject?a=1", "body": "a=2&c=9"},
        {"body": "a= 12"},
        {"body": "b=%zz"},
        {"method": "PUT"},
    )
    injected = ingest.inject_tuple(requests, FORM2)
    rows = {r["request_id"]: (r["a"], r["b"]) for r in ingest.accepted(injected, FORM2, "request_id").collect()}
    assert rows == {0: (0, ""), 1: (0, SENTENCE), 2: (73, SENTENCE), 3: (5, ""), 4: (1, "")}
    rejected = {r["request_id"]: r["error"] for r in ingest.rejects(injected, "request_id").collect()}
    assert rejected == {5: "bad value for a", 6: "bad parameter encoding", 7: "method not allowed"}
    outcomes = {r["request_id"]: r["status"] for r in ingest.outcomes(injected, "request_id").collect()}
    assert outcomes == {**{i: 204 for i in range(5)}, 5: 500, 6: 500, 7: 405}


def test_form_size_limit_and_other_payloads(spark):
    large = "b=" + "x" * 300_000
    gated = ingest.inject_tuple(post(spark, {"body": large}), FORM2)
    assert gated.first()["error"] == "form too large"
    assert ingest.size_gate(post(spark, {"body": large}), 400).first()["error"] is None
    text = '{"a": "' + "y" * 800_000 + '"}'
    port = schema([("jsonString", "rstring")])
    row = ingest.accepted(ingest.inject_json(post(spark, {"body": text, "type": http.JSON}), port), port).first()
    assert row["jsonString"] == text


@pytest.mark.parametrize(
    ("content_type", "ok"),
    [("application/json", True), ("application/json; charset=utf-8", True), ("application/jsonx", False), ("Application/json", False), (None, False)],
)
def test_content_types(spark, content_type, ok):
    gated = ingest.content_type_gate(post(spark, {"type": content_type}), "json").first()
    assert (gated["error"] is None) == ok


def test_json_posts(spark):
    port = schema([("a", "int32"), ("jsonString", "rstring")])
    requests = post(
        spark,
        {"body": "{}", "type": http.JSON},
        {"body": '{"a":37,"b":"Hello!"}', "type": http.JSON + "; charset=utf-8"},
        {"body": "not json", "type": http.JSON},
        {"body": "{}", "type": http.JSON, "method": "GET"},
    )
    rows = ingest.accepted(ingest.inject_json(requests, port), port, "request_id").collect()
    assert [(r["a"], r["jsonString"]) for r in rows] == [(0, "{}"), (0, '{"a":37,"b":"Hello!"}'), (0, "not json")]
    checked = ingest.inject_json(requests, port, validate=True)
    assert {r["request_id"] for r in ingest.rejects(checked, "request_id").collect()} == {2, 3}
    first = schema([("a", "rstring"), ("b", "int32")])
    assert ingest.accepted(ingest.inject_json(requests, first), first).first()["a"] == "{}"


def test_xml_posts(spark):
    port = schema([("data", "xml"), ("jsonString", "rstring")])
    requests = post(spark, *[{"body": b, "type": http.XML} for b in ("", '<x a="b">55</x>', "<x>", "plain")])
    injected = ingest.inject_xml(requests, port)
    assert [r["data"] for r in ingest.accepted(injected, port).collect()] == ["", '<x a="b">55</x>']
    assert {r["request_id"] for r in ingest.rejects(injected, "request_id").collect()} == {2, 3}


def test_blob_posts(spark):
    headers = schema([("data", "blob"), ("headers", "map<rstring,rstring>")])
    requests = post(spark, {"type": http.OCTETS}, {"type": http.OCTETS, "body": bytes(31), "headers": {"A": "b"}})
    rows = ingest.accepted(ingest.inject_blob(requests, headers), headers).collect()
    assert bytes(rows[0]["data"]) == b"" and rows[0]["headers"]
    assert bytes(rows[1]["data"]) == bytes(31) and rows[1]["headers"] == {"A": "b"}
    other = schema([("data", "blob"), ("jsonString", "rstring")])
    assert ingest.accepted(ingest.inject_blob(requests, other), other).first()["jsonString"] == ""


def test_blob_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x00\x01")
    (tmp_path / "b.bin").write_bytes(bytes(31))
    (tmp_path / "c.txt").write_bytes(b"other")
    port = schema([("data", "blob")])
    rows = ingest.accepted(ingest.inject_blob(read_blobs(spark, str(tmp_path), "*.bin"), port), port).collect()
    assert sorted(bytes(r["data"]) for r in rows) == [bytes(31), b"\x00\x01"]


def test_landed_requests_round_trip(spark, tmp_path):
    requests = post(spark, {"body": "a=1"}, {"body": "a=2"})
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        write_frame(requests, path, fmt)
        rows = read_landed(spark, path, RAW_REQUESTS, fmt)
        assert rows.count() == 2 and rows.schema.fieldNames() == RAW_REQUESTS.fieldNames()


def test_routes(spark):
    urls = {
        "/ctx/Op/ports/output/0/inject": ("ctx", "Op", "output", 0, "inject", "/ctx/Op/ports", ""),
        "http://h:8080/my.flow.Op/ports/input/12/tuples?partition=1": ("", "my.flow.Op", "input", 12, "tuples", "/my.flow.Op/ports", ""),
        "/RequestStream/ports/analyze/0/getpath": ("", "RequestStream", "output", 0, "analyze", "/RequestStream/ports", "/getpath"),
        "/base/R/ports/analyze/1": ("base", "R", "output", 1, "analyze", "/base/R/ports", ""),
        "/Op/ports/input/0/inject": None,
        "/Op/ports/output/x/inject": None,
        "/Op/other": None,
        "": None,
        "http://h": None,
    }
    rows = ingest.route_requests(post(spark, *[{"url": u} for u in urls])).collect()
    for row, wanted in zip(rows, urls.values()):
        got = tuple(row[c] for c in ("context", "operator", "direction", "port", "action", "context_path", "path_info"))
        if wanted is None:
            assert row["error"] == "no route" and got == ("", "", "", None, "", "", "")
        else:
            assert row["error"] is None and got == wanted


def test_ports_are_apart(spark):
    requests = post(spark, {"url": "/Op/ports/output/0/inject"}, {"url": "/Op/ports/output/1/inject"}, {"url": "/Op/ports/output/1/inject"})
    ports = ingest.split_ports(ingest.route_requests(requests), 2)
    assert [ports[0].count(), ports[1].count()] == [1, 2]


COERCIONS = {
    "int8": {"127": 127, "128": None, "-128": -128, "+5": 5, " 5": None, "5 ": None, "1.0": None, "0x1": None, "-": None},
    "int64": {"9223372036854775807": 2**63 - 1, "9223372036854775808": None, "0007": 7},
    "uint8": {"255": 255, "256": None, "-1": None},
    "uint64": {"18446744073709551615": 2**64 - 1, "18446744073709551616": None, "-1": None},
    "float64": {"1.5": 1.5, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1.5d": 1.5, "0x1p3": 8.0, " 2 ": 2.0, "inf": None, "nan": None, "abc": None, "1e": None, "-Infinity": -math.inf},
    "boolean": {"true": True, "TRUE": True, "yes": False, "1": False},
    "rstring": {"x": "x"},
}


@pytest.mark.parametrize("kind", COERCIONS)
def test_coercion(spark, kind):
    cases = COERCIONS[kind]
    df = spark.createDataFrame([(t,) for t in cases], "t string").select(coerce(F.col("t"), kind).alias("v"))
    assert [None if r["v"] is None else r["v"] for r in df.collect()] == list(cases.values())


def test_defaults_of_all_types(spark):
    row = spark.range(1).select(*[coerce_or_default(F.lit(None).cast("string"), k).alias(k) for k in SPARK_TYPES]).first()
    assert all(row[k] is not None for k in SPARK_TYPES)
    assert row["int32"] == 0 and row["rstring"] == "" and row["boolean"] is False and row["map<rstring,rstring>"] == {}


def test_headers_keep_the_first_value(spark):
    pairs = F.from_json(F.lit('[{"name":"A","value":"1"},{"name":"b","value":"2"},{"name":"a","value":"3"}]'), http.PAIRS)
    assert ingest.header_map(spark.range(1), pairs).first()["headers"] == {"A": "1", "b": "2"}
    none = ingest.header_map(spark.range(1), F.array().cast(http.PAIRS)).first()
    assert none["headers"] == {}
