"""Token counts against the library, over texts of every kind."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import token_counts

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))


@pytest.fixture(scope="module")
def counts():
    return token_counts.Counts(token_counts.Merges.load(public_tokenizers.path(token_counts.MODEL)))


def plain_bpe(text, ranks):
    """Byte-pair merging as it is defined: look for the best pair anew each time."""
    symbols = list(text)
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
        if not pairs:
            return sum(1 if s in ranks else len(s.encode()) for s in symbols)
        _, i = min(pairs)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


ODD = [
    "", " ", "  ", "\n", "\t\t", "a", " a", "a ", "▁", "▁▁ a", "<s>", "</s> x <unk>", "<0x0A>", "é́ ﬁ Ａ", "日本語のテキスト", "🙂🙂🙃",
    "x" * 5000, " " * 333, " " * 40 + "word" + " " * 17 + "next", "  ​", "a\x00b", "line\r\nline\n\n\n", "0123456789 1,000.00",
    "\U0010ffff", "ǅ ß ﷺ", "The quick brown fox." * 200,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, counts, text):
    assert counts.of(text) == len(library.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, counts, text):
    assert counts.of(text) == len(library.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ▁aehtnrs\n.é語", max_size=80))
def test_texts_that_merge_much(library, counts, text):
    assert counts.of(text) == len(library.encode(text))


def test_heap_gives_what_the_definition_gives():
    draw = random.Random(4)
    for _ in range(300):
        pieces = {"".join(draw.choices("abc", k=draw.randint(2, 4))) for _ in range(12)}
        ranks = {p: draw.randint(0, 5) for p in [*"ab", *pieces]}
        text = "".join(draw.choices("abc", k=draw.randint(1, 40)))
        assert token_counts.Merges(ranks).tokens(text) == plain_bpe(text, ranks)


def test_all_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in token_counts.count(docs).collect()}
    assert len(got) == docs.count()
    for row in docs.collect():
        found = got[row["doc_id"]]
        assert found["n_tokens"] == len(library.encode(row["text"] or ""))
        assert found["n_bytes"] == len((row["text"] or "").encode())
        assert found["over_limit"] == (found["n_tokens"] > 4096)


def test_nulls_repeats_clashes_and_empty_tables(frame, library):
    long = "many words in a row " * 5000
    rows = [(1, None, 7, "a"), (None, "", 7, "b"), (2, long, 7, "c"), (2, long, 7, "c"), (3, "x", None, None)]
    docs = frame(rows, DOCS + ", n_tokens int, __text string")
    got = token_counts.count(docs)
    assert set(got.columns) == {"doc_id", "text", "n_tokens", "__text", "n_bytes", "over_limit"}
    found = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got.collect())
    n = len(library.encode(long))
    assert found == [(0, 0, 0, False), (1, 0, 0, False), (2, 100000, n, True), (2, 100000, n, True), (3, 1, 1, False)]
    assert token_counts.count(docs.limit(0)).count() == 0


def test_the_memory_of_counts_is_bounded(counts, library, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 50)
    counts = token_counts.Counts(counts.merges)
    text = " ".join(f"word{i}x{chr(97 + i % 26)}" for i in range(500))
    assert counts.of(text) == len(library.encode(text))
    assert len(counts) <= 50


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="behind a space"):
        token_counts.Merges({"a▁b": 0, "a": 1})
