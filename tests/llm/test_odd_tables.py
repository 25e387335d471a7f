"""Every operator and stage over odd rows, clashing column names, columns without an order, and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import frame  # noqa: F401
from wireglass.llm import (
    decontaminate,
    hard_negatives,
    html,
    language,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    ranked_search,
    simhash,
    token_counts,
    tokens,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "many words of one long text " * 4000
ROWS = [
    (1, "an ordinary text with several words in it", "en", "a", 10),
    (1, "an ordinary text with several words in it", "en", "a", 10),
    (2, None, "en", "a", 0),
    (3, "", "de", None, 0),
    (4, LONG, "en", "b", 5),
    (None, "a text without an id", "fr", "b", 5),
    (None, "another text without an id", None, "b", 5),
    (5, "½ ② 12", None, "c", 5),
    (6, "the benchmark passage is one two three four five six seven", "en", "c", None),
    (7, "\n\n  \n", "fr", "c", 5),
]
CLASHES = ["__row", "__id", "__hash", "__hashes", "__lines", "__doc", "__text", "__guess", "__score", "__size", "__own", "__root", "__a", "key", "rank", "score", "n_words"]


def documents(frame, clashing=True):
    docs = frame(ROWS, DOCS)
    if not clashing:
        return docs
    docs = docs.withColumns({name: F.lit(7) for name in CLASHES})
    return docs.withColumn("notes", F.create_map(F.lit("k"), F.col("doc_id")))


@pytest.fixture
def labels(frame):
    return frame([(1, 0), (2, None), (4, 0), (6, 1), (7, 1), (None, 1)], "doc_id long, toxic int")


@pytest.fixture
def benchmark(frame):
    items = [(1, "one two three four five six seven"), (2, None), (3, ""), (None, "no id"), (1, "one two three four five six seven")]
    return frame([(*i, 1) for i in items], "item_id long, text string, __hash int")


OPERATORS = {
    "html": lambda d, *_: html.extract(d.withColumnsRenamed({"doc_id": "page_id", "source": "url", "text": "html"})),
    "line_dedup": lambda d, *_: line_dedup.remove(d),
    "language": lambda d, *_: language.predict(d),
    "toxicity": lambda d, labels, _: toxicity.predict(d, labels),
    "mixing": lambda d, *_: mixing.mix(d),
    "tokens": lambda d, *_: tokens.roundtrip(d),
    "simhash": lambda d, *_: simhash.digest(simhash.groups(d)),
    "licenses": lambda d, *_: licenses.scan(d),
    "decontaminate": lambda d, _, benchmark: decontaminate.digest(decontaminate.scan(d, benchmark)),
    "remove_spans": lambda d, _, benchmark: decontaminate.remove_spans(d, benchmark),
    "token_counts": lambda d, *_: token_counts.count(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_each(frame, labels, benchmark, name):
    docs = documents(frame)
    assert len(OPERATORS[name](docs, labels, benchmark).collect()) == len(ROWS)
    assert OPERATORS[name](docs.limit(0), labels, benchmark).collect() == []


def test_searches(frame, benchmark):
    got = ranked_search.search(documents(frame), benchmark).collect()
    assert {r["item_id"] for r in got} == {1, None} and {r["rank"] for r in got if r["item_id"] == 1} >= {1}
    rows = [(0, [1.0] * 12, 0), (None, [1.0] * 12, 0), (100, [0.5] * 12, 1), (3, None, 1), (4, [2.0] * 12, None), (5, [1.0, 2.0] * 6, 0)]
    vectors = frame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, query_id int")
    found = neighbours.search(vectors, vectors.where("vec_id % 100 = 0"))
    assert {(r["query_id"], r["vec_id"]) for r in found.collect()} == {(0, 100), (0, 4), (0, 5), (100, 0), (100, 4), (100, 5)}
    assert neighbours.search(vectors.limit(0), vectors.limit(0)).count() == 0
    prepared = hard_negatives.quantised(vectors)
    assert hard_negatives.mine(prepared, prepared.where("vec_id = 0")).count() == 0


def test_number_characters_are_no_letters(frame):
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(documents(frame)).collect() if r["doc_id"]}
    assert (got[2], got[3], got[5], got[7]) == ("und",) * 4 and got[1] != "und"


@pytest.fixture
def tables(tmp_path, labels, benchmark):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages(spark, frame, tables, name):
    docs = documents(frame)
    got = STAGES[name](spark, docs, tables)
    rows = got.collect()
    if name != "tokens":
        assert got.columns == docs.columns
        kept = [(r["doc_id"], r["text"]) for r in rows]
        given = [(r[0], r[1]) for r in ROWS]
        assert set(kept) <= set(given)
        assert all(r["__row"] == 7 and r["notes"] == ({"k": r["doc_id"]}) for r in rows)
        if name == "near_duplicates":
            # null, empty and blank texts are one group
            assert sorted(kept, key=str) == sorted(set(given) - {(3, ""), (7, "\n\n  \n")}, key=str)
        if name == "decontamination":
            assert sorted(kept, key=str) == sorted([g for g in given if g[0] != 6], key=str)
    assert STAGES[name](spark, docs.limit(0), tables).collect() == []
