"""Hard negatives against a plain scan in Python's integers."""

import math
import random

import numpy as np
import pytest

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<double>, label int"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def usable(row):
    _, v, label = row
    return row[0] is not None and label is not None and v is not None and all(x is not None and math.isfinite(256 * x) for x in v)


def plain(rows, anchors, n=5):
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in filter(usable, rows)]
    out = []
    for own, a, label in rows:
        if not anchors(own):
            continue
        scores = [(-sum(x * y for x, y in zip(a, v)), i, la) for i, v, la in rows if i != own and len(v) == len(a)]
        scores.sort()
        for p, pid, _ in [s for s in scores if s[2] == label][:n]:
            inside = [s for s in scores if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:n]
            out += [(own, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(table, anchors="vec_id % 100 = 0"):
    rows = hn.quantised(table)
    got = hn.mine(rows, rows.where(anchors))
    assert got.columns == OUT
    return sorted(map(tuple, got.collect()))


def made(seed, n, dims, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * rng.choice([0.1, 0.8]) + rng.normal(size=dims) * 0.6
        rows.append((i, (v / np.linalg.norm(v)).tolist(), label))
    return rows


@pytest.mark.parametrize(("seed", "dims"), [(1, 16), (2, 3), (3, 20)])
def test_against_a_plain_scan(frame, seed, dims):
    rows = made(seed, 900, dims)
    # a group of copies, and one label that holds most rows
    rows += [(1000 + i, rows[100][1], rows[100][2] if i % 2 else 3) for i in range(60)]
    rows += [(2000 + i, v, 3) for i, v, _ in made(seed + 10, 500, dims)]
    got = mined(frame(rows, VECTORS).repartition(4))
    assert got == plain(rows, lambda i: i % 100 == 0)
    assert len(got) > 50


def test_blocks_of_anchors_and_columns_give_the_same(frame, monkeypatch):
    rows = made(4, 400, 12)
    want = plain(rows, lambda i: i % 20 == 0)
    monkeypatch.setattr(hn, "ANCHORS", 6)
    monkeypatch.setattr(hn, "BLOCK", 500)
    assert mined(frame(rows, VECTORS).repartition(3), "vec_id % 20 = 0") == want


def test_odd_rows(frame):
    rows = made(5, 150, 8, 2)
    nan, inf = float("nan"), float("inf")
    rows += [(None, [0.5] * 8, 1), (200, None, 1), (300, [0.5] * 8, None), (400, [0.5, None] * 4, 1), (500, [nan] * 8, 1), (600, [inf] * 8, 0)]
    rows += [(700, [0.5] * 4, 0), (701, [0.4] * 4, 0), (702, [0.45] * 4, 1), (800, [], 0), (801, [], 0), (802, [], 1), (900, [1e308] * 8, 0)]
    rows += [rows[100], rows[100], rows[7], (1001, [0.0] * 8, 1)]
    table = frame([(*r, 5, "x") for r in rows], VECTORS + ", rank int, anchor string")
    want = plain(rows, lambda i: i % 100 == 0)
    # equal anchor rows are asked once, a repeated row is a positive and a negative of its own
    assert sorted(set(mined(table))) == sorted(set(want))
    assert mined(table.limit(0)) == [] and mined(table, "vec_id = 12345") == []


def test_large_numbers_stay_exact(frame):
    draw = random.Random(6)
    rows = [(i, [draw.choice([1e5, 3e6, -2e4]) + draw.random() for _ in range(6)], i % 2) for i in range(120)]
    rows += [(200, [4e7, 0.5, 0.25, 0.0, -3.0, 1e6], 1)]
    assert mined(frame(rows, VECTORS)) == plain(rows, lambda i: i % 100 == 0)


def test_huge_scores_are_clipped(frame):
    rows = [(0, [1e200, 1.0], 0), (1, [1e200, 2.0], 0), (2, [9e199, 1.0], 1)]
    assert mined(frame(rows, VECTORS)) == []  # the clipped positive leaves no whole window
    rows = [(0, [1e9, 1.0], 0), (1, [1e9, 2.0], 0), (2, [9e8, 1.0], 1)]
    got = mined(frame(rows, VECTORS))
    assert all(-(1 << 63) <= v < 1 << 63 for r in got for v in r)


def test_columns_are_skipped_for_excluded_rows():
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(size=(32, 5000)) * 20)
    x[:4] *= 20
    labels = np.sort(rng.integers(0, 2, 5000))
    block = hn.Block(np.arange(5000), labels, x)
    anchor = x[:, 17].copy()
    finder = hn.Positives(5)
    read = finder.look(block, int(labels[17]), anchor, 17)
    start, end = block.of_label(int(labels[17]))
    assert read < 0.7 * 32 * (end - start)
    scores = anchor @ x
    best = sorted((-scores[i], i) for i in range(start, end) if i != 17)[:5]
    assert list(zip((-finder.best[1]).tolist(), finder.best[0].tolist())) == best
