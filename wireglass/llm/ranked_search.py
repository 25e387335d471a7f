"""Ranked lexical search with bit-sliced Bloom signatures.

Every document gets a Bloom signature of its terms: PROBES bits per term, and the
same again for terms that occur at least 2, 4 and 8 times. Signatures are kept as
slices: one bitmap over documents per signature bit. The AND of a term's slices is
a bitmap of the documents that may hold it - all that do, and some that do not.

Upper bound of a document for an item: per level of occurrences the weighted sum of
the item's slices, times what a term of that level adds at most in a document of
that length. Signatures only err towards "present", so no bound is too low. A
document is rescored exactly, from its own counts, unless its bound is below the
score of K documents already found for the item.

Documents are read twice: once for N, L and the document counts of the asked terms,
once to search. A task gathers documents of BLOCK_BYTES, sorts them by the number
of their terms and cuts them into shards of like length, so that a shard's
signatures have the length its documents need (density DENSITY at most). Of each
task K documents per item remain; they are merged in two steps, so that no task
gets all answers of an item. No text is shuffled.

Items are asked in blocks of bounded size (ITEMS different texts, ITEM_BYTES of
terms, measured), each broadcast; items with equal texts are asked once.

Null and termless documents are found by none and count in no statistic; null and
termless items, and items whose terms occur nowhere, have no rows. A null doc_id
ranks behind others of equal score. Repeated document rows are documents of their
own; repeated item rows give their rows once each. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireglass.llm.common import LOWER, UPPER, small_batches
from wireglass.session import landed

K = 20
PROBES, DENSITY = 3, 1 / 3
#: A term counts for every level that it occurs as often as.
LEVELS = (1, 2, 4, 8)
BLOCK_BYTES, SHARD_DOCS = 4_000_000, 4096
ITEMS, ITEM_BYTES = 2_000, 16_000_000
#: Tasks that merge the answers of one item first.
MERGERS = 16
_STEP = 0x9E3779B97F4A7C15
# A-Z to lower case, all that separates terms to a space, other bytes as they are
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 75 + (25 * n * n_docs) // n_terms


def share(tf, norm):
    """What an occurrence count adds per unit of weight; of numbers or arrays."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


class Asked:
    """The items of one block: their terms with weights, by number of the term."""

    def __init__(self, number: dict[bytes, int], items: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int):
        self.number, self.items, self.n_docs, self.n_terms = number, items, n_docs, n_terms

    @classmethod
    def weigh(cls, items: list[Counter], n_docs: int, n_terms: int, df: dict[bytes, int]) -> Asked:
        known = sorted({t for item in items for t in item if df.get(t) and weight(n_docs, df[t]) > 0})
        number = {t: i for i, t in enumerate(known)}
        weighed = []
        for item in items:
            pairs = sorted((number[t], c * weight(n_docs, df[t])) for t, c in item.items() if t in number)
            weighed.append((np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)))
        return cls(number, weighed, n_docs, n_terms)


def _hashes(found: Counter) -> np.ndarray:
    return np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)


def _slots(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Signature bits of terms at a level, PROBES per term."""
    mixed = (hashes + np.uint64(level)) * np.uint64(_STEP)
    first, step = mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)
    return ((first[:, None] + probes * step[:, None]) % np.uint64(bits)).astype(np.int64)


class Document:
    """What a task keeps of a document: id, length, hashes and levels of all its terms, counts of the asked ones."""

    def __init__(self, doc_id: int | None, found: list[bytes], asked: Asked):
        counts = Counter(found)
        self.doc_id, self.n = doc_id, len(found)
        self.hashes = _hashes(counts)
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        self.most = int(tf.max())
        self.levels = [np.flatnonzero(tf >= level) for level in LEVELS[1:]]
        self.entries = len(counts) + sum(map(len, self.levels))
        self.norm = length_norm(self.n, asked.n_docs, asked.n_terms)
        self.tf = {asked.number[t]: counts[t] for t in counts.keys() & asked.number.keys()}

    def score(self, numbers: list[int], weights: list[int]) -> int:
        total, tf, norm = 0, self.tf, self.norm
        for number, weighed in zip(numbers, weights):
            count = tf.get(number)
            if count:
                total += weighed * ((1_000_000_000 * count) // (1000 * count + 12 * norm))
        return total


class Shard:
    """Slices of the signatures of some documents."""

    def __init__(self, documents: list[Document]):
        self.documents = documents
        self.bits = max(64, math.ceil(-PROBES * max(d.entries for d in documents) / math.log(1 - DENSITY)))
        slices = np.zeros((self.bits, len(documents)), bool)
        for at, d in enumerate(documents):
            slices[_slots(d.hashes, 0, self.bits), at] = True
            for level, rows in enumerate(d.levels, 1):
                slices[_slots(d.hashes[rows], level, self.bits), at] = True
        self.slices = np.packbits(slices, axis=1)
        norms = np.array([d.norm for d in documents], np.int64)
        most = np.array([d.most for d in documents], np.int64)
        # at most so many occurrences at a level, and what they add beyond the level before
        tops = [np.minimum(most, level - 1) for level in LEVELS[1:]] + [most]
        caps = [share(top, norms).astype(np.float64) for top in tops]
        self.gains = [caps[0], *[b - a for a, b in zip(caps, caps[1:])]]

    def present(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Per level the bitmaps of the documents that may hold each term so often."""
        found = []
        for level in range(len(LEVELS)):
            rows = self.slices[_slots(hashes, level, self.bits)]
            found.append(np.bitwise_and.reduce(rows, axis=1))
        return found

    def bounds(self, present: list[np.ndarray], numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document scores more than its bound."""
        n = len(self.documents)
        total = np.zeros(n)
        for bitmap, gain in zip(present, self.gains):
            rows = np.unpackbits(bitmap[numbers], axis=1, count=n)
            total += gain * (weights.astype(np.float64) @ rows)
        # above the rounding of doubles
        return total * (1 + 1e-9) + 0.5


class Best:
    """The K best documents found for one item; the worst of them first."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """A lower score cannot enter any more."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if score > 0 and len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif score > 0 and entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> list[tuple[int, int | None]]:
        return [(score, -minus if known else None) for score, known, minus in self.heap]


def shards(documents: list[Document]) -> Iterator[Shard]:
    """Documents of like length together: the longest of a shard has at most twice the terms of its shortest."""
    documents.sort(key=lambda d: d.entries)
    start = 0
    for at in range(1, len(documents) + 1):
        if at == len(documents) or at - start == SHARD_DOCS or documents[at].entries > 2 * documents[start].entries:
            yield Shard(documents[start:at])
            start = at


def rank_shard(shard: Shard, asked: Asked, hashes: np.ndarray, best: list[Best]) -> int:
    """Offer all documents that the bounds do not exclude; gives the number of exact scores."""
    scored = 0
    if not len(hashes):
        return scored
    present = shard.present(hashes)
    for (numbers, weights), kept in zip(asked.items, best):
        if not len(numbers):
            continue
        bounds = shard.bounds(present, numbers, weights)
        able = np.flatnonzero(bounds >= kept.least)
        able = able[np.argsort(-bounds[able], kind="stable")]
        pair = numbers.tolist(), weights.tolist()
        for at in able.tolist():
            if bounds[at] < kept.least:
                break
            document = shard.documents[at]
            kept.offer(document.score(*pair), document.doc_id)
            scored += 1
    return scored


def _blocks(batches: Iterator[pa.RecordBatch], asked: Asked) -> Iterator[list[Document]]:
    """Documents with terms, gathered up to about BLOCK_BYTES."""
    block, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = terms(text.as_py())
            if found:
                block.append(Document(doc_id, found, asked))
                size += sum(map(len, found))
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    if block:
        yield block


def statistics(docs: DataFrame, wanted: frozenset[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with terms, all their terms, and how many documents hold each wanted term."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, held, n_docs, n_terms = shared.value, Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = terms(text.as_py())
                n_docs += bool(found)
                n_terms += len(found)
                held.update(wanted.intersection(found))
        # a term is never empty: the empty key and the space carry the totals
        keys, values = [b"", b" ", *held], [n_docs, n_terms, *held.values()]
        yield pa.RecordBatch.from_pydict({"term": pa.array(keys, pa.binary()), "n": pa.array(values, pa.int64())})

    # at most the wanted terms and two more reach the driver
    summed = docs.select("text").mapInArrow(task, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {bytes(r["term"]): r["n"] for r in summed.collect()}
    return counts.pop(b"", 0), counts.pop(b" ", 0), counts


def _answers(docs: DataFrame, keys: list[str], asked: Asked, k: int) -> DataFrame:
    """(key, doc_id, score): the k best of every task for each item of a block."""
    # plain values: classes of this module travel in the function, not in the broadcast
    shared = docs.sparkSession.sparkContext.broadcast((keys, (asked.number, asked.items, asked.n_docs, asked.n_terms)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = shared.value
        asked = Asked(*parts)
        hashes = _hashes(asked.number)
        best = [Best(k) for _ in keys]
        for block in _blocks(batches, asked):
            for shard in shards(block):
                rank_shard(shard, asked, hashes, best)
        rows = [(key, doc_id, score) for key, kept in zip(keys, best) for score, doc_id in kept.rows()]
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array([r[0] for r in rows], pa.string()),
                "doc_id": pa.array([r[1] for r in rows], pa.int64()),
                "score": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "key string, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of `docs` for every row of `items`."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = items.select("item_id", F.sha2("text", 256).alias("__key"), "text").where(F.col("text").isNotNull())
    texts = keyed.groupBy("__key").agg(F.first("text").alias("text"))
    texts = landed(texts.select(F.col("__key").alias("key"), "text"), "items")
    size = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // ITEMS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    found = spark.createDataFrame([], "key string, doc_id long, score long")
    for block in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()
        keys, wanted = [r["key"] for r in rows], [Counter(terms(r["text"])) for r in rows]
        n_docs, n_terms, df = statistics(docs, frozenset().union(*wanted))
        answers = _answers(docs, keys, Asked.weigh(wanted, n_docs, n_terms, df), k) if n_docs else found.limit(0)
        # of several blocks each is finished before the next is asked
        found = found.union(landed(answers, "answers")) if blocks > 1 else answers
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGERS))
    some = found.withColumn("part", part)
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("key", "part").orderBy(*order))).where(F.col("place") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("rank") <= k)
    answered = keyed.select("item_id", "__key").join(ranked, F.col("__key") == F.col("key"))
    return answered.select("item_id", "rank", "doc_id", "score")


_TERMS = f"""regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
SQL = f"""
WITH doc AS (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
full_doc AS (SELECT doc_id, t, len(t) AS n FROM doc WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM full_doc),
item AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL
),
occ AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, n, unnest(t) AS term FROM full_doc)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL
),
weighed AS (
  SELECT term, floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM occ, total GROUP BY term
),
scored AS (
  SELECT item_id, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN occ USING (term) JOIN weighed USING (term), total
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {K}
"""
