"""Toxicity by two class-conditional Kneser-Ney models over words and their beginnings.

The history of an expression w is its text's class c (toxic, ordinary):

    p_c(w) = max(n_c(w) - D, 0) / N_c + L_c p(w),    L_c = sum over v of min(n_c(v), D) / N_c

n_c(w) is a continuation count: the number of different words that w follows in
the class, but no more than the texts that hold it. So a passage that is copied a
thousand times, or a word that one text repeats, counts little. p(w) is the shared
backoff, the number of classes w continues (one or two) over the sum of that
number: a word that is rare in one class is judged by what both have in common,
and a word rare in both says nothing. The counts of the larger class are
scaled to the size of the smaller first, so that the same discount D means the
same evidence. Different predecessors are counted in 192 bits per word and class, which
merge by OR: 64 for linear counting, and where these are nearly full MAPS bitmaps of
16 bits, in which bit i is set with probability 2^-(i+1) (probabilistic counting,
good for some 500,000 predecessors; the number of texts is the bound beyond).
Expressions are words and their first 8, 6, 5 and 4 letters. A word with evidence
of its own in a class is judged by it; any other word takes half the log ratio of its
longest beginning that has some, so that an unseen form of a known stem is recognised
and a made-up word that begins like one is not condemned.

A text's score compares the two log-likelihoods per word (a repeated pair of words
counts once), over the whole text and over its worst stretches of 1, 3 and 20 words:
one strong expression shows in a text of any length. A logistic curve turns these, and
the length that makes a bad stretch likelier, into a probability.

Spark counts the words of all labelled texts that are neither held out nor set
aside for the curve. Every expression with evidence keeps its log ratio, however
many there are: the table is split by key into shards of about SLOTS expressions
(their number is measured), each a broadcast of its own. The driver makes one
shard at a time. Scoring looks up the new words of a bounded piece of the texts
shard by shard; of many shards a Python worker holds RESIDENT, the others are
read from the executor's disk in turn. Expressions whose discounted counts are
zero in both classes have the ratio of an unseen one and need no entry. The curve alone is fitted on a bounded sample (CURVE_ROWS) of labelled
rows, set aside by a hash of the id.

Null and empty texts get the share of toxic labels. If a class has no labelled
row, all scores are that share. Repeated rows are scored each; repeated labels
count once per label row. Extra columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import fold, small_batches, unused
from wireglass.session import landed

DISCOUNT = 2.0
CLASSES = ("toxic", "ordinary")
#: Set bits from which the 64 no longer tell numbers apart, and bitmaps that do.
FULL, MAPS = 60, 8
#: Words of the stretches whose worst counts.
STRETCHES = (20, 3, 1)
#: Expressions of one shard, and shards that a worker holds at a time.
SLOTS, RESIDENT = 1 << 22, 2
CURVE_ROWS = 20_000
HELD_OUT = 2
THRESHOLD = 0.3
#: Lengths of the beginnings of a word that are counted besides the word, longest first.
STARTS = (8, 6, 5, 4)
#: What a word takes of the ratio of its beginning, if it has none of its own.
LENT = 0.5
#: Expressions a task counts before it hands them on, and words it remembers while scoring.
HELD_KEYS, HELD_WORDS = 500_000, 300_000
#: Characters of the texts whose words are looked up together.
PIECE = 4_000_000
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


#: Key of the hash by kind of expression; pandas asks for 16 characters.
HASH_KEYS = {"word": "0123456789123456", "start": "start of a word:", "bits": "word that goes b"}


def hashes(found: list[str], kind: str) -> np.ndarray:
    """Unsigned 64-bit hashes of words, the same in every process."""
    out = pd.util.hash_array(np.array(found, dtype=object), hash_key=HASH_KEYS[kind], categorize=False)
    return out.astype(np.uint64, copy=False)


class Numbers(dict):
    """Numbers of strings, in the order in which they are asked for first."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number

    def of(self, found: Iterable[str], size: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, size)


class Vocabulary:
    """Words, number 0 for the start of a text, and the numbers of their beginnings (NONE: too short), longest first."""

    NONE = -1

    def __init__(self):
        self.words, self.starts = Numbers({"": 0}), Numbers()
        self.links = np.full((1, len(STARTS)), self.NONE)

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words, of the words before them, and where the words of each text end."""
        found = [words(t) for t in texts]
        ends = np.cumsum([0, *map(len, found)])
        numbers = self.words.of(chain.from_iterable(found), int(ends[-1]))
        before = np.zeros_like(numbers)
        before[1:] = numbers[:-1]
        before[ends[:-1][np.diff(ends) > 0]] = 0
        return numbers, before, ends

    def new(self) -> tuple[list[str], list[str]]:
        """The words and beginnings that came since the last call; their links are known from then on."""
        n_starts = len(self.starts)
        found = list(islice(self.words, len(self.links), None))
        number = self.starts.__getitem__
        links = [number(w[:n]) if n < len(w) else self.NONE for w in found for n in STARTS]
        self.links = np.vstack([self.links, np.array(links, np.int64).reshape(-1, len(STARTS))])
        return found, list(islice(self.starts, n_starts, None))


def predecessor_bits(found: list[str]) -> np.ndarray:
    """The bits of words among 192, as rows of three longs: one of the first 64, and one of MAPS bitmaps of 16."""
    number = hashes(found, "bits")
    rest = number >> np.uint64(16) | np.uint64(1 << 15)
    level = np.log2((rest & (~rest + np.uint64(1))).astype(float)).astype(np.uint64)
    place = np.uint64(16) * (number >> np.uint64(6) & np.uint64(MAPS - 1)) + level
    out = np.zeros((len(found), 3), np.uint64)
    out[:, 0] = np.uint64(1) << (number & np.uint64(63))
    out[np.arange(len(found)), 1 + (place >> np.uint64(6)).astype(int)] = np.uint64(1) << (place & np.uint64(63))
    return out


def _or_by(groups: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """OR of the rows of each of `size` groups."""
    out = np.zeros((size, rows.shape[1]), np.uint64)
    if len(groups):
        order = np.argsort(groups, kind="stable")
        groups = groups[order]
        first = np.flatnonzero(np.diff(groups, prepend=-1))
        out[groups[first]] = np.bitwise_or.reduceat(rows[order], first, axis=0)
    return out


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([array, np.zeros((size - len(array), *array.shape[1:]), array.dtype)])


class Counted:
    """Texts and predecessor bits of the expressions of some texts, per class."""

    def __init__(self):
        self.vocabulary, self.bits = Vocabulary(), predecessor_bits([""])
        self.texts = {c: np.zeros(1, np.int64) for c in CLASSES}
        self.texts_of_starts = {c: np.zeros(0, np.int64) for c in CLASSES}
        self.before = {c: np.zeros((1, 3), np.uint64) for c in CLASSES}

    def __len__(self) -> int:
        return len(self.vocabulary.words) + len(self.vocabulary.starts)

    def add(self, texts: list[str | None], name: str) -> None:
        """Count texts of one class."""
        numbers, before, ends = self.vocabulary.numbered(texts)
        found, _ = self.vocabulary.new()
        self.bits = np.vstack([self.bits, predecessor_bits(found)])
        size, n_starts = len(self.vocabulary.words), len(self.vocabulary.starts)
        # a text counts once for an expression
        home = np.repeat(np.arange(len(texts)), np.diff(ends))
        home, held = np.divmod(np.unique(home * size + numbers), size)
        self.texts[name] = _grown(self.texts[name], size) + np.bincount(held, minlength=size)
        links = self.vocabulary.links[held]
        once = np.unique((home[:, None] * n_starts + links)[links != Vocabulary.NONE])
        starts = np.bincount(once % max(n_starts, 1), minlength=n_starts)
        self.texts_of_starts[name] = _grown(self.texts_of_starts[name], n_starts) + starts
        pairs, last = np.divmod(np.unique(numbers * size + before), size)
        self.before[name] = _grown(self.before[name], size) | _or_by(pairs, self.bits[last], size)

    def rows(self) -> pd.DataFrame:
        vocabulary, size = self.vocabulary, len(self.vocabulary.words)
        keys = [hashes([*islice(vocabulary.words, 1, None)], "word"), hashes([*vocabulary.starts], "start")]
        columns = {"key": np.concatenate(keys).view(np.int64)}
        owner, place = np.nonzero(vocabulary.links != Vocabulary.NONE)
        starts = vocabulary.links[owner, place]
        for c in CLASSES:
            columns[c] = np.concatenate([_grown(self.texts[c], size)[1:], _grown(self.texts_of_starts[c], len(vocabulary.starts))])
        for c in CLASSES:
            before = _grown(self.before[c], size)
            both = np.vstack([before[1:], _or_by(starts, before[owner], len(vocabulary.starts))])
            columns |= {f"{c}_before{i}": both[:, i].copy().view(np.int64) for i in range(3)}
        return pd.DataFrame(columns)


def count(texts: DataFrame) -> DataFrame:
    """key, toxic, ordinary (texts), and the bits of the words before (three longs per class) of all expressions.

    Summed per task before the shuffle.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted = Counted()
        for batch in batches:
            for name, label in zip(CLASSES, (1, 0)):
                for piece in _pieces(batch["text"][batch["toxic"] == label].tolist()):
                    counted.add(piece, name)
                    if len(counted) > HELD_KEYS:
                        yield counted.rows()
                        counted = Counted()
        yield counted.rows()

    bits = [f"{c}_before{i}" for c in CLASSES for i in range(3)]
    counted = texts.mapInPandas(task, "key long, toxic long, ordinary long, " + ", ".join(f"{b} long" for b in bits))
    return counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in CLASSES], *[F.bit_or(b).alias(b) for b in bits])


def different(texts: Column, bits: list[Column]) -> Column:
    """Number of different predecessors, at most the number of texts."""
    ones = F.bit_count(bits[0])
    few = -64.0 * F.log(1.0 - ones / 64.0)
    # the lowest bit that no predecessor set, averaged over the bitmaps
    maps = [F.shiftrightunsigned(part, 16 * i).bitwiseAND(F.lit(0xFFFF)) for part in bits[1:] for i in range(4)]
    lowest = [F.bit_count(F.bitwise_not(m).bitwiseAND(m + 1) - 1) for m in maps]
    many = F.pow(F.lit(2.0), sum(lowest) / float(MAPS)) * (MAPS / 0.77351)
    return F.least(F.when(ones < FULL, few).otherwise(F.greatest(many, F.lit(float(FULL)))), texts.cast("double"))


def log_ratios(counts: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, float]:
    """(key, ratio) of the words with evidence, and the ratio of all others: log p_toxic / p_ordinary."""
    counts = counts.select(
        "key",
        *[different(F.col(c), [F.col(f"{c}_before{i}") for i in range(3)]).alias(c) for c in CLASSES],
        (F.when(F.col("toxic") > 0, 1).otherwise(0) + F.when(F.col("ordinary") > 0, 1).otherwise(0)).alias("n"),
    )
    counts = landed(counts, "words")
    # no counted text at all gives nulls
    total = {c: n or 0.0 for c, n in counts.agg(*[F.sum(c).alias(c) for c in (*CLASSES, "n")]).first().asDict().items()}
    size = float(min(total["toxic"], total["ordinary"])) or 1.0
    scaled = {c: F.col(c) * F.lit(size / max(total[c], 1.0)) for c in CLASSES}
    masses = counts.agg(*[F.sum(F.least(scaled[c], F.lit(discount))).alias(c) for c in CLASSES]).first()
    backoff = {c: max(masses[c] or 0.0, 1e-9) / size for c in CLASSES}
    above = {c: F.greatest(scaled[c] - discount, F.lit(0.0)) / size for c in CLASSES}
    shared = F.col("n") / F.lit(float(total["n"]) or 1.0)
    likely = {c: above[c] + backoff[c] * shared for c in CLASSES}
    known = counts.where((above["toxic"] > 0) | (above["ordinary"] > 0))
    ratio = F.log(likely["toxic"] / likely["ordinary"])
    return known.select("key", ratio.alias("ratio")), float(np.log(backoff["toxic"] / backoff["ordinary"]))


def to_shards(ratios: DataFrame, slots: int) -> list[Broadcast]:
    """Broadcasts of (sorted keys, log ratios), one per remainder of the key: all rows of `ratios`, `slots` of them at a time on the driver."""
    spark = ratios.sparkSession
    n_shards = -(-ratios.count() // slots)
    rows = ratios.select("key", F.col("ratio").cast("float").alias("ratio"), F.pmod("key", F.lit(max(n_shards, 1))).alias("shard"))
    if n_shards > 1:
        # a file holds few shards, so that each is read without the others
        rows = landed(rows.repartition("shard").sortWithinPartitions("shard"), "ratios")
    shards = []
    for shard in range(n_shards):
        found = rows.where(F.col("shard") == shard).select("key", "ratio").toArrow()
        keys, values = found.column(0).to_numpy(), found.column(1).to_numpy()
        order = np.argsort(keys)
        shards.append(spark.sparkContext.broadcast((keys[order], values[order])))
    return shards


class Ratios:
    """Log ratios of words: a word's own or else a part of that of its longest beginning with evidence."""

    def __init__(self, shards: list[Broadcast], other: float):
        self.shards, self.other = shards, other
        self.forget()

    def forget(self) -> None:
        self.vocabulary, self.values, self.lent = Vocabulary(), np.zeros(1), np.zeros(0)

    def learn(self) -> None:
        """Look up the words that the vocabulary got since the last call, all in one turn of the shards."""
        found, starts = self.vocabulary.new()
        if not found:
            return
        keys = np.concatenate([hashes(found, "word"), hashes(starts, "start")]).view(np.int64)
        own, lent = np.split(self._look_up(keys), [len(found)])
        self.lent = np.concatenate([self.lent, lent])
        # one nan behind the beginnings stands for NONE
        lent = np.append(self.lent, np.nan)[self.vocabulary.links[-len(found) :]]
        longest = np.argmax(~np.isnan(lent), axis=1)
        lent = LENT * lent[np.arange(len(found)), longest]
        lent[np.isnan(lent)] = self.other
        self.values = np.concatenate([self.values, np.where(np.isnan(own), lent, own)])

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan)
        home = keys % max(len(self.shards), 1)
        for number, shard in enumerate(self.shards):
            mine = np.flatnonzero(home == number)
            if not len(mine):
                continue
            known, values = shard.value
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
                same = known[at] == keys[mine]
                out[mine[same]] = values[at[same]]
            del known, values
            if len(self.shards) > RESIDENT and number >= RESIDENT - 1:
                # the next use reads it from disk again
                vars(shard).pop("_value", None)
        return out

    def __getitem__(self, word: str) -> float:
        number = self.vocabulary.words[word]
        self.learn()
        return float(self.values[number])


def _pieces(texts) -> Iterator[list[str | None]]:
    """The texts in runs of about PIECE characters."""
    piece, size = [], 0
    for text in texts:
        piece.append(text)
        size += len(text or "")
        if size >= PIECE:
            yield piece
            piece, size = [], 0
    yield piece


def features(ratios: Ratios, texts) -> np.ndarray:
    """Per text: log ratio per word, per word of its worst stretches, and the logarithm of the number of words."""
    out = np.zeros((len(texts), 2 + len(STRETCHES)))
    row = -1
    for piece in _pieces(texts):
        if len(ratios.values) > HELD_WORDS:
            ratios.forget()
        numbers, before, ends = ratios.vocabulary.numbered(piece)
        ratios.learn()
        values, pairs = ratios.values[numbers], numbers * len(ratios.values) + before
        for row, (start, end) in enumerate(zip(ends[:-1], ends[1:]), row + 1):
            if start == end:
                continue
            # a pair of words that a text repeats counts at its first place only
            first = np.sort(np.unique(pairs[start:end], return_index=True)[1])
            sums = np.zeros(len(first) + 1)
            np.cumsum(values[start:end][first], out=sums[1:])
            worst = [((sums[n:] - sums[:-n]).max() if len(first) >= n else sums[-1]) / n for n in STRETCHES]
            out[row] = sums[-1] / len(first), *worst, np.log1p(len(first))
    return out


def fit_curve(features: np.ndarray, labels: np.ndarray, share: float, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve over (1, features), by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(features)), features * SCALE])
    w = np.zeros(x.shape[1])
    w[0] = np.log(share / (1 - share))
    if len(x):
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            ridge = np.diag([1e-6, *[1e-2] * features.shape[1]])
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ w * [0, *[1] * features.shape[1]])
            w += step
            if np.abs(step).max() < 1e-8:
                break
    return w


SCALE = np.array([20.0, 5.0, 2.0, 1.0, 1.0])


class Model:
    """Fitted table and curve; `score` adds the column score to documents."""

    def __init__(self, table, weights: np.ndarray, share: float):
        self.table, self.weights, self.share = table, weights, share
        self.ratios = Ratios(*table) if table else None

    def probabilities(self, texts) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(texts), self.share)
        x = np.column_stack([np.ones(len(texts)), features(self.ratios, texts) * SCALE])
        p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        p[[not words(t) for t in texts]] = self.share
        return p

    def score(self, docs: DataFrame, name: str = "score") -> DataFrame:
        """All rows and columns of `docs` with the score as column `name`."""
        small_batches(docs.sparkSession)
        # broadcasts travel in the function itself, not inside another broadcast
        table, weights, share = self.table, self.weights, self.share

        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = Model(table, weights, share)
            for texts in batches:
                yield pd.Series(model.probabilities(texts.tolist()))

        return docs.withColumn(name, of("text"))


def fit(docs: DataFrame, labels: DataFrame, slots: int = SLOTS, curve_rows: int = CURVE_ROWS, discount: float = DISCOUNT) -> Model:
    """Learn from labelled rows that are not held out: four fifths count, one fifth sets the curve."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") != 0).cast("int").alias("toxic"))
    known = known.where(fold(F.col("doc_id")) != HELD_OUT)
    texts = docs.select("doc_id", "text").where(fold(F.col("doc_id")) != HELD_OUT)
    learned = texts.join(known.hint("shuffle_hash"), "doc_id")
    learned = learned.select("doc_id", "text", "toxic", (F.abs(F.xxhash64("doc_id")) % 1_000_000).alias("draw"))
    shares = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not shares["n"] or not shares["toxic"] or shares["toxic"] == shares["n"]:
        return Model(None, np.zeros(1 + len(SCALE)), (shares["toxic"] or 0) / shares["n"] if shares["n"] else 0.0)
    share = shares["toxic"] / shares["n"]
    # of the labelled rows, those with the smallest draws set the curve: a fifth, but a bounded number
    limit = max(1, int(1_000_000 * min(0.2, curve_rows / shares["n"])))
    counts = count(learned.where(F.col("draw") >= limit).select("text", "toxic"))
    ratios, other = log_ratios(counts, discount)
    table = (to_shards(ratios, slots), other)

    names = [f"f{i}" for i in range(len(SCALE))]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ratios = Ratios(*table)
        for batch in batches:
            f = features(ratios, batch["text"].tolist())
            yield pd.DataFrame(f, columns=names).assign(toxic=batch["toxic"].to_numpy())

    sample = learned.where(F.col("draw") < limit).select("text", "toxic")
    shape = ", ".join(f"{n} double" for n in names) + ", toxic int"
    rows = sample.mapInPandas(task, shape).limit(2 * curve_rows).toPandas()
    weights = fit_curve(rows[names].to_numpy(), rows["toxic"].to_numpy(float), share)
    return Model(table, weights, share)


def predict(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """All columns of `docs`, held_out, score, predicted (which replace columns of these names)."""
    scored = fit(docs, labels, **options).score(docs)
    held = fold(F.col("doc_id")) == HELD_OUT
    return scored.withColumn("held_out", held).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    name = unused(docs, "__score")
    return fit(docs, labels, **options).score(docs, name).where(F.col(name) < THRESHOLD).drop(name)
