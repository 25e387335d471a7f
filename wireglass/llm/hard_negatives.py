"""Hard-negative mining by a vertical scan with branch-and-bound (BOND).

Rows are landed once as column blocks: BLOCK numbers each, every dimension a
column of its own with its least and greatest value, rows ordered by label. For an
anchor the columns are read STEP at a time in descending order of the anchor's
magnitudes. After each step a candidate's score lies between its partial sum plus
the least and plus the greatest that the unread columns can add; candidates whose
range cannot matter leave the bitmap, and later columns are read for the rest only.

Two scans: first the anchor's positives (rows of its label; a candidate goes when
its greatest score is below the n-th best least score), then the negatives (rows of
other labels; a candidate goes when its range misses every window between
`low` and `high` per cent of a positive's score, or cannot enter the best of one).
What is left after the last column has its exact score.

Anchors are asked in blocks of ANCHORS rows, broadcast one after the other; every
block of rows answers all of them with its best few, which are merged per anchor.
No row is shuffled, and none is compared outside the scan, so a label or a group
of copies that holds most rows does no harm.

Rows with a null id, label or vector, with a null or non-finite component, or with
one that scaling makes infinite take no part. Rows of another length than the anchor's
are no candidates. Scores are exact integers; beyond 64 bits they are clipped in the
result. A row with the anchor's id is the anchor itself. Repeated candidate rows are
candidates of their own; equal anchor rows are asked once. Ties go to the smaller
id. Fewer candidates than asked give fewer rows; an empty table gives none. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireglass.session import landed

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
SCALE = 256
#: Numbers in a block of columns, columns read between two prunings, anchors broadcast together.
BLOCK, STEP, ANCHORS = 2_000_000, 8, 4_096
#: Sums below this are exact in doubles; others are taken in Python's integers.
EXACT = float(1 << 53)
_BLOCKS = "size int, ids array<long>, labels array<int>, numbers array<double>"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the rows that take part, with components floor(scale * x)."""
    def number(x: Column) -> Column:
        # doubles of 2^52 and more have no fraction, and their floor may not fit a long
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)

    fits = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(fits, F.lit(False)))
    vector = F.transform("embedding", number).alias("v")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), vector)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def columns(rows: DataFrame) -> DataFrame:
    """Column blocks of the rows that a task reads, one per length of vector and BLOCK numbers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            ids, labels, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            sizes = np.asarray(vectors.value_lengths())
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                parts = held.setdefault(size, [])
                parts.append((ids[at], labels[at], _matrix(vectors.take(pa.array(at)), size) if size else np.zeros((len(at), 0))))
                if sum(len(p[0]) for p in parts) * max(size, 1) >= BLOCK:
                    yield _packed(size, held.pop(size))
        for size, parts in held.items():
            yield _packed(size, parts)

    return rows.select("vec_id", "label", "v").mapInArrow(task, _BLOCKS)


def _packed(size: int, parts: list) -> pa.RecordBatch:
    ids, labels, x = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(labels, kind="stable")
    return pa.RecordBatch.from_pydict(
        {
            "size": pa.array([size], pa.int32()),
            "ids": pa.array([ids[order]], pa.list_(pa.int64())),
            "labels": pa.array([labels[order]], pa.list_(pa.int32())),
            "numbers": pa.array([x[order].T.ravel()], pa.list_(pa.float64())),
        }
    )


class Block:
    """Columns of one block, with the range of every column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.least, self.most = (x.min(axis=1), x.max(axis=1)) if x.size else (np.zeros(len(x)), np.zeros(len(x)))

    def slice(self, start: int, end: int) -> Block:
        part = Block.__new__(Block)
        part.ids, part.labels, part.x = self.ids[start:end], self.labels[start:end], self.x[:, start:end]
        # the range of the whole block holds for its parts too
        part.least, part.most = self.least, self.most
        return part

    def of_label(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.labels, [label, label + 1]))


def scan(block: Block, anchor: np.ndarray, own: int, keep) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and exact scores of the rows that `keep(least, most)` leaves, and the numbers read.

    `keep` gets the ranges of the candidates' scores and gives those that stay.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a, least, most = anchor[order], block.least[order], block.most[order]
    if float(np.abs(a) @ np.maximum(np.abs(least), np.abs(most))) >= EXACT:
        a, least, most = (np.array([int(v) for v in values], object) for values in (a, least, most))
    whole = a.dtype == object
    low, high = np.minimum(a * least, a * most), np.maximum(a * least, a * most)
    # what the columns from a place on can add
    rest_low = np.concatenate([low[::-1].cumsum()[::-1], np.zeros(1, a.dtype)])
    rest_high = np.concatenate([high[::-1].cumsum()[::-1], np.zeros(1, a.dtype)])
    alive = block.ids != own
    rows = np.flatnonzero(alive)
    sums = np.zeros(len(rows), a.dtype)
    read = 0
    for at in range(0, max(len(a), 1), STEP):
        end = min(at + STEP, len(a))
        if end > at:
            wanted = order[at:end]
            x = block.x[wanted] if len(rows) == len(block.ids) else block.x[wanted[:, None], rows]
            if whole:
                x = np.array([[int(v) for v in column] for column in x], object).reshape(len(wanted), len(rows))
            sums = sums + a[at:end] @ x
            read += x.size
        stay = keep(sums + rest_low[end], sums + rest_high[end])
        if not stay.all():
            rows, sums = rows[stay], sums[stay]
        if not len(rows):
            break
    return block.ids[rows], sums, read


def best_of(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n highest scores, ties to smaller ids."""
    if scores.dtype == object:
        first = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:n], np.int64)
    else:
        first = np.lexsort((ids, -scores))[:n]
    return ids[first], scores[first]


def _joined(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


NONE = (np.zeros(0, np.int64), np.zeros(0))


class Positives:
    """The best rows of the anchor's label so far."""

    def __init__(self, n: int):
        self.n, self.best = n, NONE

    def look(self, block: Block, label: int, vector: np.ndarray, own: int) -> int:
        start, end = block.of_label(label)
        if start == end:
            return 0

        def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            known = np.concatenate([least, self.best[1]])
            if len(known) < self.n or not self.n:
                return np.ones(len(least), bool)
            floor = np.sort(known)[-self.n] if known.dtype == object else np.partition(known, -self.n)[-self.n]
            return most >= floor

        ids, scores, read = scan(block.slice(start, end), vector, own, keep)
        self.best = best_of(*_joined(self.best, (ids, scores)), self.n)
        return read

    def found(self) -> list[tuple]:
        return [(0, *self.best)]


class Negatives:
    """The best rows of other labels so far, per window below a positive's score."""

    def __init__(self, n: int, positive_scores: list[int], low: int = LOW, high: int = HIGH):
        self.n, self.positive_scores = n, positive_scores
        self.windows = [window(score, low, high) for score in positive_scores]
        self.best = [NONE] * len(positive_scores)

    def found(self) -> list[tuple]:
        return [(score, *best) for score, best in zip(self.positive_scores, self.best)]

    def _floors(self) -> list:
        """What a score must reach to enter each window's best."""
        return [best[1][-1] if len(best[1]) == self.n else low for best, (low, _) in zip(self.best, self.windows)]

    def look(self, block: Block, label: int, vector: np.ndarray, own: int) -> int:
        floors = self._floors()

        def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(least), bool)
            for floor, (_, high) in zip(floors, self.windows):
                stay |= (most >= floor) & (least <= high)
            return stay

        start, end = block.of_label(label)
        total = 0
        for part in ((0, start), (end, len(block.ids))):
            if part[0] == part[1] or not self.windows:
                continue
            ids, scores, read = scan(block.slice(*part), vector, own, keep)
            total += read
            for at, (low, high) in enumerate(self.windows):
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                if len(inside):
                    self.best[at] = best_of(*_joined(self.best[at], (ids[inside], scores[inside])), self.n)
        return total


def window(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int] | None:
    """The scores s with low * positive <= 100 * s <= high * positive."""
    ends = -(-low * positive // 100), high * positive // 100
    return ends if ends[0] <= ends[1] else None


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for at in range(batch.num_rows):
            size, ids, labels, numbers = (batch.column(i)[at] for i in range(4))
            size = size.as_py()
            ids, labels = np.asarray(ids.values), np.asarray(labels.values)
            yield size, Block(ids, labels, np.asarray(numbers.values).reshape(size, len(ids)))


def _clipped(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
    return scores.astype(np.int64)


def _scanned(blocks: DataFrame, anchors: list[tuple], finder: Callable, wanted: list) -> DataFrame:
    """(anchor, target, vec_id, score): per task what `finder(wanted[number])` finds for each anchor (id, label, vector)."""
    # plain values: classes of this module travel in the function, not in the broadcast
    shared = blocks.sparkSession.sparkContext.broadcast((anchors, wanted))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wanted = shared.value
        finders = [finder(some) for some in wanted]
        for size, block in _unpacked(batches):
            for (own, label, vector), found in zip(anchors, finders):
                if len(vector) == size:
                    found.look(block, label, vector, own)
        rows = [(number, *found) for number, some in enumerate(finders) for found in some.found() if len(found[1])]
        if rows:
            counts = [len(r[2]) for r in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": np.repeat(np.array([r[0] for r in rows], np.int32), counts),
                    "target": np.repeat(np.array([r[1] for r in rows], np.int64), counts),
                    "vec_id": np.concatenate([r[2] for r in rows]),
                    "score": np.concatenate([_clipped(r[3]) for r in rows]),
                }
            )

    return blocks.mapInArrow(task, "anchor int, target long, vec_id long, score long")


def _first(found: DataFrame, n: int) -> DataFrame:
    """The n best of each anchor and target, numbered from 1."""
    order = Window.partitionBy("anchor", "target").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` and `anchors` are frames of `quantised`; `low` and `high` are per cent of
    the positive's score.
    """
    spark = rows.sparkSession
    blocks = landed(columns(rows), "columns")
    asked = landed(anchors.dropDuplicates(["vec_id", "label", "v"]), "anchors")
    parts = -(-asked.count() // ANCHORS)
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], shape)
    for part in range(parts):
        got = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)) == part).select("vec_id", "label", "v").toArrow()
        vectors = got.column("v").combine_chunks()
        some = [
            (i, label, np.asarray(vectors[at].values, np.float64))
            for at, (i, label) in enumerate(zip(got.column("vec_id").to_pylist(), got.column("label").to_pylist()))
        ]
        nearest = _scanned(blocks, some, lambda _: Positives(positives), [None] * len(some))
        near = landed(_first(nearest, positives), "positives")
        # at most `positives` scores per anchor of the block
        wanted: list[list[int]] = [[] for _ in some]
        for r in near.select("anchor", "score").distinct().collect():
            if window(r["score"], low, high):
                wanted[r["anchor"]].append(r["score"])
        hard = _first(_scanned(blocks, some, lambda scores: Negatives(negatives, scores, low, high), wanted), negatives)
        names = spark.createDataFrame([(number, i) for number, (i, _, _) in enumerate(some)], "anchor int, anchor_id long")
        pairs = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("target"))
        mined = pairs.join(hard, ["anchor", "target"]).join(names, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            F.col("target").alias("positive_score"), F.col("score").alias("negative_score"),
        )
        out = out.union(landed(mined, "negatives")) if parts > 1 else mined
    return out


SQL = f"""
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
