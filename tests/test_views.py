"""Window contents, view requests and rendering."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wireglass.functions.types import schema
from wireglass.operators import view
from wireglass.operators.view import QueryError, ViewSpec
from wireglass.plans.buckets import measure

NAMES = ["a_string", "b_string", "c_int32", "d_float", "e_boolean"]


def tuples(spark, count):
    return spark.range(count).select(
        "id",
        F.concat(F.lit("rstr_"), "id").alias("a_string"),
        F.concat(F.lit("ustr_"), "id").alias("b_string"),
        (F.col("id") % 4).cast("int").alias("c_int32"),
        F.col("id").cast("double").alias("d_float"),
        (F.col("id") % 3 != 0).alias("e_boolean"),
    )


def spec(keys=(), **rest):
    return ViewSpec(["id"], 16, list(keys), attributes=NAMES, **rest)


TWO = ["c_int32", "e_boolean"]


@pytest.mark.parametrize(
    ("count", "port", "query", "ids", "columns"),
    [
        (4, spec(), "", range(4), NAMES),
        (20, spec(), "", range(4, 20), NAMES),
        (4, spec(tumbling=True), "", [], NAMES),
        (20, spec(tumbling=True), "", range(16), NAMES),
        (20, spec(force_empty=True), "", range(4, 20), NAMES),
        (20, spec(), "attribute=c_int32&attribute=d_float", range(4, 20), ["c_int32", "d_float"]),
        (20, spec(), "suppress=a_string&suppress=b_string", range(4, 20), NAMES[2:]),
        (20, spec(["c_int32"]), "partition=1", [1, 5, 9, 13, 17], NAMES),
        (20, spec(TWO), "partition=1&partition=false", [9], NAMES),
        (20, spec(TWO, force_empty=True), "attribute=a_string", [], ["a_string"]),
        (20, spec(["c_int32"], named=True), "c_int32=1", [1, 5, 9, 13, 17], NAMES),
        (20, spec(TWO, named=True), "e_boolean=false&c_int32=1", [9], NAMES),
        (20, spec(TWO, named=True, force_empty=True), "attribute=a_string", [], ["a_string"]),
        (20, spec(TWO, named=True), "e_boolean=false", [0, 3, 6, 9, 12, 15, 18], NAMES),
        (
            20,
            spec(TWO, named=True),
            "e_boolean=false&attribute=e_boolean&attribute=d_float",
            [0, 3, 6, 9, 12, 15, 18],
            ["e_boolean", "d_float"],
        ),
    ],
)
def test_golden_views(spark, count, port, query, ids, columns):
    rows = view.read_view(tuples(spark, count), port, query)
    assert rows.columns == columns
    wanted = tuples(spark, count).where(F.col("id").isin(list(ids))).select(*columns)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, wanted.collect()))


def test_unknown_names_count_as_no_partition(spark):
    named = spec(TWO, named=True, force_empty=True)
    assert view.read_view(tuples(spark, 20), named, "nosuch=1").count() == 0
    assert view.read_view(tuples(spark, 20), spec(TWO, named=True), "nosuch=1").count() == 20


def test_bad_partition_queries(spark):
    with pytest.raises(QueryError, match="too few"):
        view.read_view(tuples(spark, 4), spec(TWO), "partition=1")
    with pytest.raises(QueryError, match="unsupported"):
        view.read_view(tuples(spark, 4), spec(["d_float"]), "partition=1.0")
    assert view.read_view(tuples(spark, 20), spec(["c_int32"]), "partition=1&partition=9").count() == 5


def test_reserved_names_are_keys_in_named_mode(spark):
    df = tuples(spark, 8).withColumn("attribute", F.col("c_int32").cast("string")).withColumn("suppress", F.lit("s"))
    port = ViewSpec(["id"], 16, ["attribute", "suppress"], named=True)
    query = view.read_query("attribute=1&suppress=s", port)
    assert query.values == {"attribute": "1", "suppress": "s"}
    assert query.attribute is None and query.suppress == ()
    assert view.read_view(df, port, "attribute=1").count() == 2
    # positional mode: the words keep their meaning
    query = view.read_query("attribute=id", ViewSpec(["id"], 16, ["attribute"]))
    assert query.values == {} and query.attribute == ["id"]


def test_json_text_of_a_view(spark):
    text = view.render_view(tuples(spark, 4), spec()).first()["json"]
    assert json.loads(text) == [
        {"a_string": f"rstr_{i}", "b_string": f"ustr_{i}", "c_int32": i % 4, "d_float": float(i), "e_boolean": i % 3 != 0}
        for i in range(4)
    ]
    assert list(json.loads(text)[0]) == NAMES
    assert view.render_view(tuples(spark, 4), spec(tumbling=True)).first()["json"] == "[]"


def test_json_attribute_is_embedded(spark):
    df = spark.createDataFrame([(1, 32, '{"b":37,"c":"HelloWorld!"}')], "id long, a int, jsonString string")
    port = ViewSpec(["id"], 4, attributes=["a", "jsonString"])
    text = view.render_view(df, port).first()["json"]
    assert json.loads(text) == [{"a": 32, "jsonString": {"b": 37, "c": "HelloWorld!"}}]
    pure = ViewSpec(["id"], 4, attributes=["jsonString"])
    two = df.union(spark.createDataFrame([(2, 0, '{"d":423}')], df.schema))
    text = view.render_view(two, pure, "attribute=nosuch&suppress=jsonString").first()["json"]
    assert json.loads(text) == [{"b": 37, "c": "HelloWorld!"}, {"d": 423}]


@pytest.mark.parametrize(("n", "trigger"), [(1, 1), (3, 1), (4, 4), (5, 3), (2, 7)])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_count_windows_against_replay(spark, n, trigger, keys):
    rng = random.Random(n * 10 + trigger)
    data = [(i, rng.choice("aaab")) for i in range(47)]
    shown: dict = {}
    seen: dict = {}
    for i, k in data:
        part = seen.setdefault(k if keys else 0, [])
        part.append(i)
        if len(part) % trigger == 0:
            shown[k if keys else 0] = part[-n:]
    rows = view.last_n(spark.createDataFrame(data, "id long, k string"), n, ["id"], keys, trigger)
    assert sorted(r["id"] for r in rows.collect()) == sorted(i for part in shown.values() for i in part)


T0 = datetime(2024, 1, 1)


def timed(spark, minutes, keys="a"):
    rows = [(i, T0 + timedelta(minutes=m), k, float(m)) for i, (m, k) in enumerate(zip(minutes, keys * len(minutes)))]
    return spark.createDataFrame(rows, "id long, ts timestamp, k string, v double")


def test_time_windows(spark):
    df = timed(spark, [0, 5, 10, 14, 20, 21, 29, 33])
    sliding = view.sliding_time(df, timedelta(minutes=10), "ts")
    assert sorted(r["id"] for r in sliding.collect()) == [6, 7]
    # per key the newest row of the key counts
    parted = view.sliding_time(timed(spark, [0, 5, 10, 14], "ab"), timedelta(minutes=10), "ts", ["k"])
    assert sorted(r["id"] for r in parted.collect()) == [1, 2, 3]
    tumbling = view.tumbling_time(df, timedelta(minutes=10), "ts")
    assert sorted(r["id"] for r in tumbling.collect()) == [4, 5, 6]
    shifted = view.tumbling_time(df, timedelta(minutes=10), "ts", timedelta(minutes=5))
    assert sorted(r["id"] for r in shifted.collect()) == [4, 5]


def test_delta_window(spark):
    rows = view.delta_window(timed(spark, [0, 5, 10, 14, 20]), "v", 6, ["ts", "id"])
    assert sorted(r["id"] for r in rows.collect()) == [3, 4]


@pytest.mark.parametrize(
    ("marks", "ids"), [([], []), ([3], [0, 1, 2]), ([3, 6], [4, 5]), ([3, 6, 7], []), ([0, 9], [1, 2, 3, 4, 5, 6, 7, 8])]
)
def test_punctuation_window(spark, marks, ids):
    df = spark.range(12).withColumn("p", F.col("id").isin(marks) if marks else F.lit(False))
    assert sorted(r["id"] for r in view.punct_window(df, "p", ["id"]).collect()) == ids


def test_latest(spark):
    empty = spark.createDataFrame([], "id long, ts timestamp, xml string")
    assert view.latest(empty, "xml", ["id"], "ts").first()["has_content"] is False
    rows = spark.createDataFrame([(1, T0, "<a/>", 0), (2, T0, "", 0), (3, T0, "<b/>", 1)], "id long, ts timestamp, xml string, k int")
    found = {r["k"]: (r["xml"], r["has_content"]) for r in view.latest(rows, "xml", ["id"], "ts", ["k"]).collect()}
    assert found == {0: ("", False), 1: ("<b/>", True)}


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 1000])
def test_answers_as_of_against_replay(spark, rows_per_bucket):
    rng = random.Random(5)
    n, trigger = 3, 2
    # key 0 holds most tuples, several rows share a time
    data = [(i, i // 3, rng.choice([0, 0, 0, 1, 2])) for i in range(120)]
    asks = [(1000 + j, t, 10_000, rng.choice([0, 1, 2, 3])) for j, t in enumerate(range(-1, 41))]
    frame = spark.createDataFrame(data, "id long, t long, k int")
    requests = spark.createDataFrame(asks, "request_id long, t long, id long, k int")
    port = ViewSpec(["t", "id"], n, ["k"], trigger=trigger)
    layout = measure(frame, "t", rows_per_bucket)
    found: dict = {}
    for r in view.answer_as_of(frame, requests, port, layout=layout).collect():
        found.setdefault(r["request_id"], []).append((r["position"], r["id"]))
    for request_id, t, _, k in asks:
        before = [i for i, s, key in data if key == k and s <= t]
        visible = before[: len(before) // trigger * trigger][-n:]
        assert sorted(found.get(request_id, [])) == list(enumerate(visible, 1))


def test_many_requests_meet_only_their_keys(spark):
    df = tuples(spark, 20)
    port = ViewSpec(["id"], 16, TWO, named=True)
    asks = [(1, "c_int32=1&e_boolean=false"), (2, "e_boolean=false"), (3, "c_int32=2"), (4, ""), (5, "c_int32=x")]
    decoded = view.read_requests(df, port, spark.createDataFrame(asks, "request_id long, query string"))
    errors = {r["request_id"]: r["error"] for r in decoded.collect() if r["error"]}
    assert list(errors) == [5]
    rows = view.answer_requests(view.snapshot(df, port), decoded, port).collect()
    found = {i: sorted(r["id"] for r in rows if r["request_id"] == i) for i in range(1, 6)}
    assert found[1] == [9] and found[2] == [0, 3, 6, 9, 12, 15, 18]
    assert found[3] == [2, 6, 10, 14, 18] and found[4] == list(range(20)) and found[5] == []
    closed = ViewSpec(["id"], 16, TWO, named=True, force_empty=True)
    rows = view.answer_requests(view.snapshot(df, closed), decoded, closed).where("request_id = 4")
    assert rows.count() == 0


def test_attribute_types_of_keys(spark):
    port_schema = schema([("u", "uint8"), ("f", "float32")])
    df = spark.createDataFrame([(200, 1.5)], port_schema)
    port = ViewSpec(["u"], 4, ["u"])
    asks = spark.createDataFrame([(1, "partition=200"), (2, "partition=-1"), (3, "partition=256")], "request_id long, query string")
    decoded = {r["request_id"]: (r["q_u"], r["error"]) for r in view.read_requests(df, port, asks).collect()}
    assert decoded[1] == (200, None)
    assert decoded[2][1] and decoded[3][1]
    floats = view.read_requests(df, ViewSpec(["u"], 4, ["f"]), asks).first()
    assert "unsupported" in floats["error"]
