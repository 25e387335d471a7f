"""Windows in a view port, undecodable keys, wide order ranges."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from wireglass.operators import view
from wireglass.operators.view import ViewSpec
from wireglass.plans.checks import CheckError
from wireglass.plans.ordered import sequence
from wireglass.streaming.live_view import LiveView

ROWS = [(k, k % 2, f"2024-01-01 00:00:0{k}", k == 6) for k in range(9)]


@pytest.fixture(scope="module")
def tuples(spark):
    frame = spark.createDataFrame(ROWS, "id long, user_id long, at string, p boolean")
    return frame.select("id", "user_id", F.col("at").cast("timestamp").alias("ts"), "p")


@pytest.mark.parametrize(
    ("window", "ids"),
    [
        (view.SlidingTime(timedelta(seconds=3)), [6, 7, 8]),
        (view.TumblingTime(timedelta(seconds=4)), [4, 5, 6, 7]),
        (view.Delta("id", 1), [7, 8]),
        (view.Punctuation("p"), [0, 1, 2, 3, 4, 5]),
    ],
)
def test_windows_of_a_port(tuples, window, ids):
    spec = ViewSpec(["ts", "id"], window=window)
    assert sorted(r["id"] for r in view.read_view(tuples, spec).collect()) == ids


@pytest.mark.parametrize("text", ["user_id=%zz", "user_id=%ff", "user_id=1%2"])
def test_undecodable_keys_are_rejected_on_both_paths(spark, tuples, text):
    spec = ViewSpec(["ts", "id"], 4, ["user_id"], named=True)
    with pytest.raises(view.QueryError):
        view.read_view(tuples, spec, text)
    asked = view.read_requests(tuples, spec, spark.createDataFrame([(1, text), (2, "user_id=1"), (3, "")], "request_id int, query string"))
    assert {r["request_id"]: r["error"] is None for r in asked.collect()} == {1: False, 2: True, 3: True}
    answered = view.answer_requests(view.snapshot(tuples, spec), asked, spec).groupBy("request_id").count().collect()
    assert {r["request_id"]: r["count"] for r in answered} == {2: 4, 3: 8}


def test_undecodable_positional_key(spark, tuples):
    spec = ViewSpec(["ts", "id"], 4, ["user_id"])
    asked = view.read_requests(tuples, spec, spark.createDataFrame([(1, "partition=%zz")], "request_id int, query string"))
    assert asked.first()["error"] == "bad partition value for user_id"
    with pytest.raises(view.QueryError):
        view.read_view(tuples, spec, "partition=%zz")


def test_view_checks_run(tuples):
    with pytest.raises(CheckError):
        view.snapshot(tuples, ViewSpec(["ts", "id"], 4, ["nosuch"]))
    with pytest.raises(CheckError):
        view.snapshot(tuples, ViewSpec(["ts", "id"], 4, ["user_id", "user_id"]))


def test_the_whole_range_of_longs(spark):
    values = [-9_000_000_000_000_000_000, -1, 0, 5, 9_000_000_000_000_000_000]
    frame = spark.createDataFrame([(v,) for v in values * 20], "v long").withColumn("k", F.monotonically_increasing_id())
    got = [r["v"] for r in sequence(frame, ["v", "k"]).orderBy("seq").collect()]
    assert got == sorted(values * 20)


def test_a_live_view_before_its_first_batch(spark, tmp_path):
    assert LiveView(spark, str(tmp_path / "new"), ViewSpec(["ts"], 4)).contents().count() == 0
