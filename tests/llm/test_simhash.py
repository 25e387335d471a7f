"""SimHash groups against brute force over all pairs."""

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import simhash


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values, ids):
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(values)), 2):
        if bin(values[a] ^ values[b]).count("1") <= 2:
            root[find(a)] = find(b)
    groups = {}
    for k, i in enumerate(ids):
        groups.setdefault(find(k), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_against_brute_force(frame):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(60)]
    for text in texts[:20]:
        words = text.split()
        for _ in range(3):
            changed = list(words)
            if changed:
                changed[rng.randrange(len(changed))] = "changed"
            texts.append(" ".join(changed))
    texts += [None, "", " \t\n", "One", "one", "a b", "A  B", "É a b c", "é a b c", "x " * 30_000]
    rows = [(1000 - k, t, "x") for k, t in enumerate(texts)]
    got = simhash.digest(simhash.groups(frame(rows, "doc_id long, text string, fp string").repartition(3))).collect()
    values = [plain_fingerprint(t) for _, t, _ in rows]
    want = plain_components(values, [r[0] for r in rows])
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        r[0]: (f"{v:016x}", want[r[0]]) for r, v in zip(rows, values)
    }


def linked(spark, values, short):
    fps = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    edges = simhash.links(fps, short)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    return [roots.get(int(np.uint64(v).astype(np.int64)), int(np.uint64(v).astype(np.int64))) for v in values]


def test_long_lists_lose_no_link(spark):
    rng = random.Random(4)
    values = {rng.getrandbits(64) for _ in range(40)}
    for base in list(values)[:6]:
        chain = base
        for _ in range(25):
            chain ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(chain)
    values = sorted(values)
    want = plain_components(values, list(range(len(values))))
    for short in (1, 4, 1000):
        got = linked(spark, values, short)
        same = [(a, b) for a, b in itertools.combinations(range(len(values)), 2) if want[a] == want[b]]
        assert all(got[a] == got[b] for a, b in same)
        assert len(set(got)) == len(set(want.values()))


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, 501: 500}


def test_repeated_rows_nulls_and_keeping_one(frame, spark):
    rows = [(3, "a b c d e", "s"), (1, "a b c d e", "s"), (1, "a b c d e", "s"), (2, "other words stand here now", None), (None, "lonely text of a null id", "s")]
    docs = frame(rows, "doc_id long, text string, source string")
    assert simhash.groups(docs).count() == 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select(F.coalesce("doc_id", F.lit(-1))).toPandas().iloc[:, 0]) == [-1, 1, 2]
    assert simhash.groups(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def kept_rows(docs):
    return sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)


def test_keeping_one_row_of_every_group_not_of_every_id(frame):
    schema = "doc_id long, text string, root string"
    lonely, other, same = "lonely text of no id", "other words stand here now", "a b c d e"
    # two groups without an id; a null id beside a numbered copy does not stand for them
    rows = [(None, lonely, "s"), (None, other, "s"), (None, other, "r"), (1, same, "s"), (None, same, "s")]
    assert kept_rows(frame(rows, schema)) == sorted([(None, lonely, "s"), (None, other, "r"), (1, same, "s")], key=str)
    # one id over two groups: the smallest of the second only
    rows = [(3, same, None), (5, same, None), (5, other, None), (5, other.upper(), None)]
    assert kept_rows(frame(rows, schema)) == sorted([(3, same, None), (5, other.upper(), None)], key=str)
    # and the smallest of both
    assert len(kept_rows(frame([(5, same, None), (5, other, None), (None, None, "x"), (None, "", "x")], schema))) == 3
