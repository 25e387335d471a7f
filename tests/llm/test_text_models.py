"""Toxicity and language: held-out accuracy, and the defined results of odd rows."""

from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import language, toxicity

DOCS = "doc_id long, text string, lang string, source string, score int"


def held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def corpus(n=240):
    import random

    rng = random.Random(5)
    words = {
        "en": "the of and with that river house green winter apple".split(),
        "de": "der die und nicht mit haus fluss grün winter apfel".split(),
    }
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        text = [rng.choice(words[lang]) + rng.choice(["", "s", "en"]) for _ in range(rng.randint(30, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(5):
                text[rng.randrange(len(text))] = "blorkhead" + rng.choice(["", "ed", "ing", "ish", "s"])
        rows.append((i, " ".join(text), lang, "s", int(toxic)))
    return rows


ODD = [(9001, None, "en", None, 0), (9002, "", None, "s", 0), (9003, "12 34 !", "de", "s", 0), (9004, "x" * 300_000, "en", "s", 0)]


def test_toxicity_on_held_out_rows(frame):
    rows = corpus()
    docs = frame([*rows, *ODD], DOCS)
    labels = frame([(r[0], None, r[4]) for r in rows] + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.predict(docs, labels, slots=1 << 14).collect()}
    assert len(got) == len(rows) + len(ODD)
    assert all(got[r[0]]["held_out"] == held_out(r[0]) for r in rows)
    right = [got[r[0]]["predicted"] == r[4] for r in rows if held_out(r[0])]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[9001]["score"] == got[9002]["score"] and got[9001]["predicted"] == 0
    kept = toxicity.keep_ordinary(docs, labels, slots=1 << 14)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_toxicity_without_labels(frame, spark):
    docs = frame(ODD, DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert toxicity.predict(docs.limit(0), none).count() == 0


def test_repeated_passages_are_no_evidence(frame):
    rows = corpus()
    # a neutral passage copied into many toxic texts, always after the same words
    rows = [(i, t + " zimzim quolq" * 40 if x and i % 10 == 0 else t, la, s, x) for i, t, la, s, x in rows]
    labels = frame([(r[0], r[4]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(frame(rows, DOCS), labels, slots=1 << 14)
    ratios = toxicity.Ratios(*model.table)
    assert ratios["blorkheadish"] > ratios["quolq"] + 1


def test_every_expression_with_evidence_counts(frame):
    """Small shards change no score: nothing is pushed out, and shards that do not stay in memory are read again."""
    rows = corpus()
    docs, labels = frame(rows, DOCS), frame([(r[0], r[4]) for r in rows], "doc_id long, toxic int")
    whole = toxicity.fit(docs, labels)
    n = len(whole.table[0][0].value[0])
    split = toxicity.fit(docs, labels, slots=n // 5 + 1)
    assert len(whole.table[0]) == 1 and len(split.table[0]) == 5 > toxicity.RESIDENT
    assert sum(len(s.value[0]) for s in split.table[0]) == n
    want = {r["doc_id"]: r["score"] for r in whole.score(docs).collect()}
    assert len(set(want.values())) > 100
    assert {r["doc_id"]: r["score"] for r in split.score(docs.repartition(3)).collect()} == want


def test_language_on_held_out_rows(frame):
    rows = corpus()
    docs = frame([*rows, *ODD], DOCS)
    got = {r["doc_id"]: r for r in language.predict(docs).collect()}
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in rows if held_out(r[0])]) > 0.95
    for odd in (9001, 9002, 9003):
        assert (got[odd]["lang_pred"], got[odd]["score"]) == ("und", 0.0)
    assert got[9004]["lang_pred"] in ("en", "de")
    nothing = language.predict(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_whole_text_counts():
    """The windows cover every byte: a text whose second half decides is judged by it."""
    assert language.cut(b"a" * 600).shape == (3, language.WINDOW)
    assert bytes(language.cut(b"abc")[0][:4]) == b"abc\0"


def test_network_paths_agree():
    rng = np.random.default_rng(0)
    net = language.Network.new(3, rng)
    x = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    assert np.allclose(net.pooled(x)[0], language._pooled_for_training(net, x)[0], atol=1e-5)


def test_predecessors_are_counted_at_every_size(spark):
    rows = []
    for size in (1, 10, 60, 150, 400, 3000, 60_000):
        bits = toxicity.predecessor_bits([f"w{size}x{i}" for i in range(size)])
        rows.append((size, 10 * size, *np.bitwise_or.reduce(bits).view(np.int64).tolist()))
    frame = spark.createDataFrame(rows, "size long, texts long, a long, b long, c long")
    for r in frame.select("size", toxicity.different(F.col("texts"), [F.col(c) for c in "abc"]).alias("n")).collect():
        assert 0.5 * r["size"] <= r["n"] <= 2 * r["size"]
    few = frame.select(toxicity.different(F.lit(7), [F.col(c) for c in "abc"]).alias("n")).collect()
    assert all(r["n"] <= 7 for r in few)


def test_one_strong_expression_shows_in_a_long_text():
    known = {"bad": 4.0, **{f"w{i}": -0.05 for i in range(500)}}
    keys = toxicity.hashes(list(known), "word").view(np.int64)
    order = np.argsort(keys)
    ratios = toxicity.Ratios([SimpleNamespace(value=(keys[order], np.array(list(known.values()))[order]))], 0.0)
    plain = " ".join(f"w{i}" for i in range(500))
    x = toxicity.features(ratios, [plain, plain + " bad", "", "bad"])
    assert np.allclose([x[1][3], x[0][3], x[3][3]], [4.0, -0.05, 4.0]) and x[1][1] > x[0][1]
    assert list(x[2]) == [0.0] * 5


def test_a_column_named_like_the_score_stays(frame):
    docs = [(i, "good words here" if i % 2 else "awful nasty words", 5) for i in range(40)]
    table = frame(docs, "doc_id long, text string, __score int")
    kept = toxicity.keep_ordinary(table, frame([(i, (i + 1) % 2) for i in range(40)], "doc_id long, toxic int"))
    assert kept.columns == ["doc_id", "text", "__score"]
    assert {r["__score"] for r in kept.collect()} <= {5}


def test_counts_and_ratios_equal_plain_kneser_ney(frame):
    """Counts of texts and bits of predecessors by plain loops, and the formula over them."""
    rows = [(t, x) for _, t, _, _, x in corpus()[:300]] + [(None, 1), ("", 0), ("?!", 1), ("a a a", 0), ("a a a", 0)]
    texts, before = {0: Counter(), 1: Counter()}, {0: defaultdict(set), 1: defaultdict(set)}
    for text, toxic in rows:
        found = toxicity.words(text)
        parts = {w: [("word", w), *[("start", w[:n]) for n in toxicity.STARTS if n < len(w)]] for w in found}
        texts[toxic].update({e for w in found for e in parts[w]})
        for last, word in zip(["", *found], found):
            for e in parts[word]:
                before[toxic][e].add(last)

    def estimate(toxic, e):
        if not before[toxic][e]:
            return 0.0
        bits = np.bitwise_or.reduce(toxicity.predecessor_bits(sorted(before[toxic][e])))
        ones = int(bits[0]).bit_count()
        assert ones < toxicity.FULL  # beyond it the bitmaps answer, which have a test of their own
        return min(-64 * np.log(1 - ones / 64), texts[toxic][e])

    every = texts[0].keys() | texts[1].keys()
    n = {e: (estimate(1, e), estimate(0, e)) for e in every}
    classes = {e: (texts[1][e] > 0) + (texts[0][e] > 0) for e in every}
    total = [sum(v[c] for v in n.values()) for c in (0, 1)]
    size, d = min(total), toxicity.DISCOUNT
    scaled = {e: [v[c] * size / total[c] for c in (0, 1)] for e, v in n.items()}
    backoff = [sum(min(v[c], d) for v in scaled.values()) / size for c in (0, 1)]
    shared = {e: classes[e] / sum(classes.values()) for e in every}
    p = {e: [max(v[c] - d, 0) / size + backoff[c] * shared[e] for c in (0, 1)] for e, v in scaled.items()}
    want = {e: np.log(p[e][0] / p[e][1]) for e in every if max(scaled[e]) > d}
    assert len(want) > 20

    counts = toxicity.count(frame(rows, "text string, toxic int").repartition(4))
    ratios, other = toxicity.log_ratios(counts)
    assert {r["key"]: (r["toxic"], r["ordinary"]) for r in counts.collect()} == {
        int(toxicity.hashes([e[1]], e[0]).view(np.int64)[0]): (texts[1][e], texts[0][e]) for e in every
    }
    got = {r["key"]: r["ratio"] for r in ratios.collect()}
    want = {int(toxicity.hashes([e[1]], e[0]).view(np.int64)[0]): r for e, r in want.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert abs(other - np.log(backoff[0] / backoff[1])) < 1e-9
