"""Ranked search against a plain scan, and its pruning."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import ranked_search as rs

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain(docs, items, k=20):
    """The contract, word for word."""
    texts = [(i, plain_terms(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n_docs, n_terms = len(texts), sum(len(t) for _, t in texts)
    df = Counter(w for _, t in texts for w in set(t))
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, t in texts:
            tf, m = Counter(t), 100 - 25 + ((25 * len(t) * n_docs) // n_terms)
            score = 0
            for w in plain_terms(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1000000000 * tf[w]) // (1000 * tf[w] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (minus, none, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if none else doc_id, -minus))
    return out


def order(row):
    return tuple((v is None, v or 0) for v in row)


def collected(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=order)


def made(seed, n_docs=300, n_items=12):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["Éa", "straße", "日本", "X9"]
    odds = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(draw.choices(vocabulary, odds, k=n))
    docs = [(i, text(draw.choice([1, 5, 30, 200]))) for i in range(n_docs)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, text(draw.choice([1, 4, 25]))) for i in range(n_items)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_scan(frame, seed):
    docs, items = made(seed)
    got = rs.search(frame(docs, DOCS).repartition(5), frame(items, ITEMS))
    assert collected(got) == sorted(plain(docs, items), key=order)


def test_terms_are_those_of_the_pattern():
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choices("aZ0 _-é日\x00\x7f\t{~🙂K", k=30))
        assert [t.decode() for t in rs.terms(text)] == plain_terms(text)


def test_blocks_and_small_shards_give_the_same(frame, monkeypatch):
    docs, items = made(4, 120, 9)
    want = sorted(plain(docs, items), key=order)
    monkeypatch.setattr(rs, "ITEMS", 2)
    assert collected(rs.search(frame(docs, DOCS).repartition(3), frame(items, ITEMS))) == want


def shard_of(docs, items):
    found = [rs.terms(t) for _, t in docs]
    wanted = [Counter(rs.terms(t)) for _, t in items]
    df = Counter(w for t in found for w in set(t))
    asked = rs.Asked.weigh(wanted, len(docs), sum(map(len, found)), df)
    return asked, [rs.Document(i, t, asked) for (i, _), t in zip(docs, found)]


def test_bounds_hold_and_exclude():
    docs, items = made(5, 3000, 30)
    asked, documents = shard_of(docs, items)
    hashes, total, scored = rs._hashes(asked.number), 0, 0
    best = [rs.Best(20) for _ in items]
    for shard in rs.shards(documents):
        present = shard.present(hashes)
        for (numbers, weights), kept in zip(asked.items, best):
            exact = np.array([d.score(numbers.tolist(), weights.tolist()) for d in shard.documents])
            assert (shard.bounds(present, numbers, weights) >= exact).all()
            total += len(exact)
        scored += rs.rank_shard(shard, asked, hashes, best)
    assert scored < total / 3


def test_a_term_is_never_missed():
    docs, items = made(6)
    asked, documents = shard_of(docs, items)
    hashes = rs._hashes(asked.number)
    for shard in rs.shards(documents):
        for level, bitmap in zip(rs.LEVELS, shard.present(hashes)):
            bits = np.unpackbits(bitmap, axis=1, count=len(shard.documents))
            for at, d in enumerate(shard.documents):
                assert all(bits[number, at] for number, tf in d.tf.items() if tf >= level)


def test_nulls_repeats_ties_clashes_and_empty_tables(frame):
    long = "alpha beta " * 60_000
    docs = [(1, "alpha"), (1, "alpha"), (None, "alpha"), (2, None), (3, ""), (4, " -- "), (5, long), (6, "gamma"), (0, "alpha")]
    items = [(1, "ALPHA beta"), (1, "ALPHA beta"), (2, None), (3, "..."), (4, "unknown"), (None, "gamma gamma")]
    got = collected(rs.search(frame([(*r, 1) for r in docs], DOCS + ", rank int"), frame([(*r, "x") for r in items], ITEMS + ", key string")))
    assert got == sorted(plain(docs, items), key=order)
    assert [r[2] for r in got if r[0] == 1][:2] == [5, 5]
    empty = frame([], DOCS), frame([], ITEMS)
    assert rs.search(empty[0], frame(items, ITEMS)).count() == 0
    assert rs.search(frame(docs, DOCS), empty[1]).count() == 0
