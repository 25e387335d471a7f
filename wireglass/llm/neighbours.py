"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: vectors are centred and rotated; the rotation is learned in numpy on a
bounded sample (SAMPLE vectors) so that the signs lose least (iterative
quantisation). The signs give one bit per dimension.

Index: a code is split into substrings of SUBSTRING bits, each with its own table
of postings. A code within Hamming radius r of a query agrees with it in some
substring to within floor(r / substrings) bits, so probing each table at all
values that close retrieves every code within the radius (pigeonhole). These are
checked on their whole code, then ranked by the exact distance of the floats.

The radius is learned too: on the sample, the one within which RECALL of the true
nearest neighbours of sample queries lie. The nearest ones of a larger table are
closer, so there the recall is higher.

Rows are indexed in blocks of BLOCK by the task that reads them; a block answers
all queries of one query block with its own nearest ones, and the answers are
merged per query. Query blocks of QUERIES rows are broadcast one after the other
(their size is bounded); what is shuffled is `k` rows per query and task.

Vectors that have no id, are null, zero, hold a null or a non-finite number, or have another
length than most of the sample take no part, neither as query nor as candidate. Repeated ids are
separate candidates; a query leaves out the rows of its own id. Fewer candidates
than k give fewer rows; within a block with fewer codes in the radius than k, the
radius grows until k are found. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireglass.session import landed

K = 10
SUBSTRING = 8
SAMPLE = 10_000
SAMPLE_QUERIES = 200
RECALL = 0.97
BLOCK = 16_384
QUERIES = 10_000
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: values within each number of bits of a value: NEAR[r][v]
NEAR = [[np.flatnonzero(ONES[np.arange(256) ^ v] <= r) for v in range(256)] for r in range(SUBSTRING + 1)]


def valid(vector: str = "embedding"):
    """Whether a vector takes part, whatever its length."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Codes:
    """Centre, rotation and radius; `encode` gives packed bits."""

    def __init__(self, centre: np.ndarray, rotation: np.ndarray, radius: int):
        self.centre, self.rotation, self.radius = centre, rotation, radius

    def encode(self, x: np.ndarray) -> np.ndarray:
        # zeros fill the last substring: equal in all codes, they change no distance
        return np.packbits((x - self.centre) @ self.rotation > 0, axis=1)


def learn(sample: np.ndarray, recall: float = RECALL, rounds: int = 30, seed: int = 3) -> Codes:
    """Iterative quantisation on a sample, and the radius that reaches `recall` there."""
    centre = sample.mean(axis=0)
    x = sample - centre
    _, _, axes = np.linalg.svd(x.T @ x)
    y = x @ axes.T
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    codes = Codes(centre, axes.T @ turn, 0)
    bits = codes.encode(sample)
    differing = []
    for q in rng.permutation(len(sample))[:SAMPLE_QUERIES]:
        near = ((sample - sample[q]) ** 2).sum(axis=1)
        near[q] = np.inf
        best = np.argsort(near, kind="stable")[:K]
        differing.append(ONES[bits[best] ^ bits[q]].sum(axis=1))
    codes.radius = int(np.ceil(np.quantile(np.concatenate(differing), recall))) if len(sample) > 1 else 0
    return codes


class Index:
    """Postings of one block: per substring, the rows ordered by its value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: Codes):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.bits = codes.encode(vectors)
        self.orders = [np.argsort(column, kind="stable") for column in self.bits.T]
        self.starts = [
            np.searchsorted(column[order], np.arange(257)) for column, order in zip(self.bits.T, self.orders)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius, by probing every substring table."""
        reach = min(radius // len(code), SUBSTRING)
        found = np.zeros(len(self.ids), bool)
        for value, order, starts in zip(code, self.orders, self.starts):
            for v in NEAR[reach][value]:
                found[order[starts[v] : starts[v + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[ONES[self.bits[rows] ^ code].sum(axis=1) <= radius]

    def search(self, own: int, vector: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, never the query's own id."""
        radius, most = self.codes.radius, 8 * len(code)
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != own]
            if len(rows) >= k or radius >= most:
                break
            radius = min(radius + len(code), most)
        distance = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], distance))[:k]
        return self.ids[rows][best], distance[best]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of equal length as doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def fit(vectors: DataFrame, recall: float = RECALL, sample: int = SAMPLE) -> tuple[Codes | None, int]:
    """Codes and vector length from the rows with the smallest hashes of the id."""
    rows = vectors.where(valid()).orderBy(F.xxhash64("vec_id"), "vec_id").select("embedding").limit(sample).toPandas()
    if rows.empty:
        return None, 0
    size = Counter(map(len, rows["embedding"])).most_common(1)[0][0]
    same = [v for v in rows["embedding"] if len(v) == size]
    return learn(np.array(same, np.float64), recall), size


def search(vectors: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of `vectors` found for every row of `queries`."""
    spark = vectors.sparkSession
    shape = "query_id long, vec_id long, score double"
    codes, size = fit(vectors, recall)
    usable = valid() & (F.size("embedding") == size)
    asked = queries.where(usable).select(F.col("vec_id").alias("query_id"), "embedding") if codes else None
    # query blocks of bounded size, told apart by a hash
    blocks = -(-asked.count() // QUERIES) if codes else 0
    rows = vectors.where(usable).select("vec_id", "embedding") if codes else None
    answers = spark.createDataFrame([], shape)
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        got = mine.toArrow()
        shared = spark.sparkContext.broadcast(
            (got.column("query_id").to_numpy(), matrix(got.column("embedding").combine_chunks(), size))
        )
        parts = (codes.centre, codes.rotation, codes.radius)

        def task(batches: Iterator[pa.RecordBatch], shared=shared, parts=parts) -> Iterator[pa.RecordBatch]:
            query_ids, query_vectors = shared.value
            codes = Codes(*parts)
            query_codes = codes.encode(query_vectors)
            best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(query_ids)
            for ids, x in _blocks(batches, size):
                index = Index(ids, x, codes)
                for i, own in enumerate(query_ids):
                    found = index.search(own, query_vectors[i], query_codes[i], k)
                    both = [np.concatenate(pair) for pair in zip(best[i], found)]
                    keep = np.lexsort(both)[:k]
                    best[i] = (both[0][keep], both[1][keep])
            counts = [len(b[0]) for b in best]
            if sum(counts):
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": np.repeat(query_ids, counts),
                        "vec_id": np.concatenate([b[0] for b in best]),
                        "score": np.concatenate([b[1] for b in best]),
                    }
                )

        found = landed(rows.mapInArrow(task, shape), "answers")
        answers = answers.union(found) if block else found
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrow batches gathered into blocks of about BLOCK rows."""
    ids, parts, n = [], [], 0
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        parts.append(matrix(batch.column(1), size))
        n += len(ids[-1])
        if n >= BLOCK:
            yield np.concatenate(ids), np.concatenate(parts)
            ids, parts, n = [], [], 0
    if n:
        yield np.concatenate(ids), np.concatenate(parts)


def brute_force(ids: np.ndarray, vectors: np.ndarray, own: int, vector: np.ndarray, k: int = K):
    """The true k nearest, for measuring the recall."""
    distance = np.sqrt(((vectors - vector) ** 2).sum(axis=1))
    keep = np.flatnonzero(ids != own)
    best = keep[np.lexsort((ids[keep], distance[keep]))[:k]]
    return ids[best], distance[best]
