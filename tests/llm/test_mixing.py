"""Mixing: targets, certain copies, sizes of the sample, reruns."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import mixing


def docs_of(sizes, rng):
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * rng.randint(0, 60)), source, "x"))
    return rows


def plain_targets(totals, weights=(5, 2, 1)):
    names = sorted([s for s in totals if s is not None], key=lambda s: s.encode()) + [s for s in totals if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    closed, want = set(), 1.5 * sum(totals.values())
    while True:
        rest = want - sum(2 * totals[s] for s in closed)
        share = rest / sum(weight[s] for s in names if s not in closed)
        over = {s for s in names if s not in closed and weight[s] * share > 2 * totals[s]}
        if not over:
            return {s: 2.0 * totals[s] if s in closed else weight[s] * share for s in names}
        closed |= over


def test_targets_and_sizes(frame):
    rng = random.Random(1)
    rows = docs_of({"b": 400, "a": 150, "é": 100, "Z": 300, None: 120}, rng)
    rows += [(len(rows), None, "a", "x"), (len(rows) + 1, "", None, "x")]
    docs = frame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    totals, taken = defaultdict(int), defaultdict(int)
    for r in got:
        totals[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = plain_targets(totals)
    for r in got:
        assert r["source_size"] == totals[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 5
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_certain_copies(frame):
    rng = random.Random(2)
    rows = docs_of({"a": 40, "b": 400}, rng)
    got = mixing.mix(frame(rows, "doc_id long, text string, source string, x string"))
    assert {r["copies"] for r in got.where("doc_id < 40").collect()} == {2}


def test_documents_repeat_as_taken(frame):
    rng = random.Random(3)
    rows = docs_of({"a": 40, "b": 100, "c": 90}, rng)
    rows += [rows[5], rows[5], (None, "null id here", "a", "x")]
    docs = frame(rows, "doc_id long, text string, source string, extra string")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    per = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    want = {r["doc_id"]: r["n"] for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    assert per == {k: v for k, v in want.items() if v}


def test_no_words_and_no_rows(frame):
    docs = frame([(1, None, "a"), (2, " \t", None)], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.mix(docs).collect()} == {(0, 0.0, 0)}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_order_sampling_is_unequal(spark):
    """Ranks are random odds over inclusion odds: larger probabilities come first."""
    u = spark.range(4000).select(mixing.uniform(F.col("id")).alias("u")).toPandas()["u"].to_numpy()
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02
    p = np.where(np.arange(4000) % 2, 0.6, 0.2)
    rank = (u / (1 - u)) / (p / (1 - p))
    first = np.argsort(rank)[: int(p.sum())]
    assert abs((first % 2).mean() - 0.75) < 0.03
