"""Ordered plans against plain Python, with many small buckets and crowded keys."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wireglass.plans.buckets import Layout, measure, plan_layout
from wireglass.plans.intervals import ancestors, by_layout, by_width, contained, crossed, levels, nearby, pieces
from wireglass.plans.ordered import Measure, measures, neighbours, sequence

T0 = datetime(2024, 3, 1)


def crowded(spark, seed, count=200):
    """Rows with ties, one key that holds most of them, a null key, and a burst in time."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        seconds = rng.randrange(5) if rng.random() < 0.6 else rng.randrange(100_000)
        rows.append((i, T0 + timedelta(seconds=seconds), rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(-5, 6)))
    return rows, spark.createDataFrame(rows, "id long, ts timestamp, k string, v long")


@pytest.mark.parametrize("per_bucket", [1, 10, 10_000])
@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_running_measures(spark, per_bucket, keys, kind):
    rows, df = crowded(spark, per_bucket)
    df = df.withColumn("ts", F.col("ts").cast(kind))
    wanted = {
        "seq": Measure(F.lit(1).cast("long")),
        "before": Measure(F.col("v"), inclusive=False),
        "top": Measure(F.col("v"), how="max"),
    }
    found = {
        r["id"]: (r["seq"], r["before"], r["top"])
        for r in measures(df, ["ts", "id"], wanted, keys, measure(df, "ts", per_bucket)).collect()
    }
    assert len(found) == len(rows)
    seen: dict = {}
    for i, _, k, v in sorted(rows, key=lambda r: (r[1], r[0])):
        part = seen.setdefault(k if keys else 0, [])
        assert found[i] == (len(part) + 1, sum(part), max([*part, v]))
        part.append(v)


@pytest.mark.parametrize("per_bucket", [1, 10, 10_000])
def test_neighbours(spark, per_bucket):
    rows, df = crowded(spark, 3)
    found = {
        r["id"]: (r["prev"] and r["prev"]["id"], r["next"] and r["next"]["id"])
        for r in neighbours(df, ["ts", "id"], ["id"], ["k"], measure(df, "ts", per_bucket)).collect()
    }
    parts: dict = {}
    for i, _, k, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        parts.setdefault(k, []).append(i)
    for part in parts.values():
        for at, i in enumerate(part):
            assert found[i] == (part[at - 1] if at else None, part[at + 1] if at + 1 < len(part) else None)


def test_sequence_is_dense(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("at"))
    rows = sequence(df, ["at"], layout=measure(df, "at", 10)).collect()
    assert all(r["seq"] == r["at"] + 1 for r in rows) and len(rows) == 1000


@given(
    st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=60),
    st.integers(1, 20),
)
@settings(max_examples=60, deadline=None)
def test_layouts_cover_their_range(values, rows):
    values = sorted(values)
    layout = plan_layout(len(values), values[0], values[-1], values, rows)
    assert layout.low == values[0]
    assert layout.low + layout.width * len(layout.splits) > values[-1]
    assert all(split >= 1 for split in layout.splits)


def test_a_burst_is_split():
    # half of the rows in one of 100 slots
    quantiles = [0] + [500 + i % 10 for i in range(50)] + list(range(0, 1000, 20))
    layout = plan_layout(100_000, 0, 1000, sorted(quantiles), 1000)
    crowded_slot = 505 // layout.width
    assert layout.splits[crowded_slot] > 5
    assert layout.count < 400


def test_bucket_numbers_never_decrease(spark):
    layout = Layout(100, 10, (1, 5, 1, 3))
    df = spark.range(80, 160)
    numbers = [r["b"] for r in df.orderBy("id").select(layout.number(F.col("id"), df.schema["id"].dataType).alias("b")).collect()]
    assert numbers == sorted(numbers)
    assert numbers[0] == 0 and numbers[-1] == layout.count - 1
    assert len(set(numbers)) == layout.count


@pytest.mark.parametrize("plan", ["layout", "width"])
def test_interval_join_against_nested_loops(spark, plan):
    rng = random.Random(11)
    points = [(i, rng.randrange(1000), rng.choice("aab")) for i in range(150)]
    spans = []
    for j in range(60):
        start = rng.randrange(-50, 1000)
        end = None if plan == "layout" and j % 10 == 0 else start + rng.choice([0, 1, 30, 700])
        spans.append((j, start, end, rng.choice("aab")))
    p = spark.createDataFrame(points, "id long, at long, k string")
    s = spark.createDataFrame(spans, "span long, s long, e long, k string")
    if plan == "layout":
        # open ends need a time axis
        for name in ("at",):
            p = p.withColumn(name, F.timestamp_seconds(name))
        s = s.withColumn("s", F.timestamp_seconds("s")).withColumn("e", F.timestamp_seconds("e"))
        bucket_of = by_layout(measure(p, "at", 5))
    else:
        bucket_of = by_width(30)
    for partitions in (None, 3):
        rows = contained(p, s, "at", "s", "e", bucket_of, ["k"], partitions).collect()
        wanted = sorted(
            (i, j) for i, at, k in points for j, a, e, key in spans if k == key and a <= at and (e is None or at < e)
        )
        assert sorted((r["id"], r["span"]) for r in rows) == wanted


def test_tree_pieces_cover_each_bucket_once_and_are_few(spark):
    depth = levels(Layout(0, 1, (1,) * 37))
    pairs = [(a, b) for a in range(37) for b in range(a, 37)]
    frame = spark.createDataFrame(pairs, "a long, b long").select("a", "b", pieces(F.col("a"), F.col("b"), depth).alias("p"))
    over = {r["id"]: set(r["n"]) for r in spark.range(37).select("id", ancestors(F.col("id"), depth).alias("n")).collect()}
    for r in frame.collect():
        assert len(r["p"]) <= 2 * depth
        for bucket in range(37):
            assert len(over[bucket] & set(r["p"])) == (r["a"] <= bucket <= r["b"])


def test_nearby_holds_every_pair_once(spark):
    draw = random.Random(8)
    points = [(i, draw.randint(0, 300)) for i in range(80)]
    spans = [(i, s := draw.randint(0, 300), None if i % 9 == 0 else s + draw.choice([0, 3, 40, 250])) for i in range(60)]
    p = spark.createDataFrame(points, "i long, at long")
    q = spark.createDataFrame(spans, "j long, s long, e long")
    for rows in (2, 9, 1000):
        met = nearby(p, q, "at", F.col("s"), F.col("e"), measure(p, "at", rows))
        got = met.where("at >= s AND (e IS NULL OR at <= e)").select("i", "j").collect()
        want = [(i, j) for i, at in points for j, s, e in spans if s <= at and (e is None or at <= e)]
        assert sorted(map(tuple, got)) == sorted(want)


def tied(spark, seed=3):
    """Two crowded days, one of them with skewed second values, and some days between and around."""
    draw = random.Random(seed)
    rows = [(10, draw.randint(-500, 500)) for _ in range(4000)] + [(20, draw.choice([1, 2, 3, draw.randint(0, 10**9)])) for _ in range(3000)]
    rows += [(d, draw.randint(0, 50)) for d in (1, 9, 11, 15, 19, 21, 400) for _ in range(30)] + [(None, 5), (10, None), (20, None)]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "d long, s long, i long")
    return frame.repartition(4), rows


def test_crowded_values_are_split_by_the_next_column(spark):
    frame, rows = tied(spark)
    layout = measure(frame, "d", 200, then="s")
    assert layout.ties.values == (10, 20)
    placed = layout.place(frame, ["d", "s", "i"], "b").collect()
    place = lambda r: tuple((v is not None, v or 0) for v in (r["d"], r["s"]))
    numbers = [r["b"] for r in sorted(placed, key=place)]
    assert numbers == sorted(numbers) and numbers[0] == -1 and numbers[-1] < layout.total
    sizes = Counter(r["b"] for r in placed if r["d"] == 10)
    assert max(sizes.values()) <= 400 and len(sizes) >= 15
    # of the day 20 a third has the same second value: that stays together, the rest does not
    assert len({r["b"] for r in placed if r["d"] == 20}) > 3
    assert measure(frame, "d", 200).ties is None and measure(frame, "i", 200, then="s").ties is None


def test_numbers_over_ties(spark):
    frame, rows = tied(spark)
    layout = measure(frame, "d", 100, then="s")
    got = [r["i"] for r in sequence(frame, ["d", "s", "i"], layout=layout).orderBy("seq").collect()]
    want = sorted(range(len(rows)), key=lambda i: (*((v is not None, v or 0) for v in rows[i]), i))
    assert got == want
    met = neighbours(frame, ["d", "s", "i"], ["i"], layout=layout).collect()
    after = {r["i"]: r["next"] and r["next"]["i"] for r in met}
    assert [after[i] for i in want] == [*want[1:], None]


def test_two_dates_of_a_million_rows_each_are_spread(spark):
    frame = spark.range(2_000_000).select(F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("d"), "id")
    layout = measure(frame, "d", 100_000, then="id")
    sizes = layout.place(frame, ["d", "id"], "b").groupBy("b").count().collect()
    assert len(sizes) >= 19 and max(r["count"] for r in sizes) <= 200_000


def test_backward_minimum_over_buckets(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    wanted = {
        "at": Measure(F.col("v"), "min", backward=True),
        "after": Measure(F.col("v"), "min", inclusive=False, backward=True),
    }
    got = measures(rows, ["id"], wanted, keys=["k"], layout=measure(rows, "id", 20)).collect()
    assert len(got) == 500
    for row in got:
        later = [i for i in range(row["id"], 500) if i % 7 == 0 and i % 3 == row["k"]]
        assert row["at"] == min(later, default=None)
        assert row["after"] == min([i for i in later if i > row["id"]], default=None)


@pytest.mark.parametrize("rows, cell, strip", [(3, 4, 2), (20, 7, 3), (None, 50, 256)])
def test_crossed_against_all_pairs(spark, rows, cell, strip):
    rng = random.Random(8)
    points = [(rng.choice([None, 40, *range(100)]), i) for i in range(150)] + [(40, 150 + i) for i in range(30)]
    spans = [(rng.choice([None, rng.randrange(-20, 120)]), i % 25 or None) for i in range(60)]
    spans = [(s, rng.choice([None, s, s, *range(-10, 130)]), k) for s, k in spans]
    spans += spans[:5]
    p = spark.createDataFrame(points, "at long, id long")
    q = spark.createDataFrame(spans, "s long, e long, k long")
    layout = rows and measure(p, "at", rows)
    met = crossed(p, q, "at", "s", "e", layout, cell, strip)
    assert met.columns == ["at", "id", "k"]
    expected = sorted(
        (at, i, k or -1)
        for at, i in points
        for s, e, k in spans
        if at is not None and s is not None and s <= at and (e is None or at < e)
    )
    assert sorted((r["at"], r["id"], r["k"] or -1) for r in met.collect()) == expected
    none = crossed(p.where("id < 0"), q, "at", "s", "e"), crossed(p, q.where("k < 0"), "at", "s", "e")
    assert [df.count() for df in none] == [0, 0]
