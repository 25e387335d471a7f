"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

from llm_fixtures import frame  # noqa: F401
from pyspark.sql import functions as F

from wireglass.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(AZ))


def plain(text, items):
    tokens, hit, found = words(text), set(), set()
    for item, body in items:
        want = words(body)
        n = min(len(want), 10)
        windows = {tuple(want[i : i + n]) for i in range(len(want) - n + 1)} if n else set()
        for at in range(len(tokens) - n + 1) if n else ():
            if tuple(tokens[at : at + n]) in windows:
                hit.update(range(at, at + n))
                found.add(str(item))
    ids = ",".join(sorted(found))
    return len(tokens), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def cases():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "été", "don't", "X-Y"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, text(n)) for k, n in enumerate([30, 25, 10, 12, 9, 3, 1, 30])]
    items += [(20, items[0][1]), (21, None), (22, " .. "), (23, "")]
    docs = [(k, text(rng.randint(0, 60))) for k in range(30)]
    docs += [(100, text(5) + " " + items[0][1].upper() + "; " + text(5)), (101, items[1][1].replace(" ", " -- ")), (102, None), (103, ""), (104, "...")]
    docs += [(105, " ".join([items[2][1]] * 30)), (105, " ".join([items[2][1]] * 30)), (105, "w1"), (None, items[3][1])]
    return docs, items


def test_against_brute_force(frame):
    docs, items = cases()
    table = frame([(i, t, "x") for i, t in docs], "doc_id long, text string, hash string").repartition(3)
    benchmark = frame(items, "item_id int, text string")
    got = decontaminate.digest(decontaminate.scan(table, benchmark)).collect()
    want = [(i, *plain(t, items)) for i, t in docs]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_a_set_in_parts_gives_the_same(frame, monkeypatch):
    docs, items = cases()
    table, benchmark = frame(docs, "doc_id long, text string"), frame(items, "item_id int, text string")
    want = sorted(map(str, decontaminate.digest(decontaminate.scan(table, benchmark)).collect()))
    monkeypatch.setattr(decontaminate, "SET_WINDOWS", 25)
    assert sorted(map(str, decontaminate.digest(decontaminate.scan(table, benchmark)).collect())) == want


def test_the_set_grows_with_the_benchmark(spark):
    # 300 words give a thousand times more windows than the items use; 1,000,000 windows, 200,000 clean places
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", k), F.lit(300)).cast("string"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1009)), word), " ")
    benchmark = spark.range(1000).select(F.col("id").alias("item_id"), text.alias("text"))
    clean = spark.range(5000, 5200).select(F.col("id").alias("doc_id"), text.alias("text"))
    windows = decontaminate._hashed_windows(benchmark, 10)
    assert windows.count() == 1_000_000
    placed = decontaminate._places(clean, windows)
    assert placed.where("at = 0").count() == 200
    assert placed.where("at > 0").count() < 0.01 * 200 * 1000
    assert decontaminate._hits(placed, windows).count() == 0
    own = benchmark.limit(3).select(F.col("item_id").alias("doc_id"), "text")
    assert {(r["n_hit"], r["n_items"]) for r in decontaminate.scan(own, benchmark).collect()} == {(1009, 1)}


def test_only_places_that_pass_are_shuffled(frame):
    docs, items = cases()
    table, benchmark = frame(docs, "doc_id long, text string"), frame(items, "item_id int, text string")
    text = decontaminate.scan(table, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    # the texts themselves are read before, in one stage without an exchange
    assert "text#" not in text.replace("text_hash#", "")


def test_removals(frame, spark):
    passage = "one two three four five six seven eight nine ten"
    docs = frame(
        [(1, f"Keep this. {passage.upper()}, and this!", "a"), (2, "clean", "b"), (3, passage, None), (4, None, "c")],
        "doc_id long, text string, source string",
    )
    benchmark = frame([("q", passage)], "item_id string, text string")
    kept = decontaminate.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert cut == {1: "Keep this. and this!", 2: "clean", 3: "", 4: None}
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.remove_documents(docs, none).count() == 4
    assert decontaminate.scan(docs.limit(0), benchmark).count() == 0


def test_no_python_in_the_plan(frame):
    docs, items = cases()
    plan = decontaminate.scan(frame(docs, "doc_id long, text string"), frame(items, "item_id int, text string"))
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text.split("== Physical Plan ==")[1])
