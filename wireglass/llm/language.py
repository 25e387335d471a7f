"""Language of texts by a byte convolutional network, trained here in numpy.

A window of WINDOW bytes (lower-cased UTF-8) passes filters of several widths;
each filter's strongest answer in the window (max pooling) goes through one dense
layer and a softmax. A filter of width k is k tables of 256 weights, one per
place, so its answer is a sum of k lookups; two neighbouring places are looked up
together. A text is cut into windows from its first to its last byte, windows of
many texts form one batch, and the text's probabilities are the means over its
windows, weighted by their bytes.

Training takes a bounded sample: SAMPLE rows per language at most (SAMPLE_ALL in
all), chosen by a hash of the id among rows with a language that are not held
out; from each up to WINDOWS windows at places that the hash chooses, some cut
short so that short texts are known too. Scoring covers all rows and bytes.

Null texts and texts without a letter are `und` with score 0, as are all texts if
nothing can be learned. Repeated rows are scored each. Extra columns are kept.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import fold, small_batches, unused

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE, SAMPLE_ALL, WINDOWS = 1500, 20_000, 2
HELD_OUT = 2
UNKNOWN = "und"
#: Windows passed through the network at once.
BATCH = 64


def has_letter(text: str | None) -> bool:
    """A letter by its Unicode category, as `\\p{L}`; number characters are none."""
    return any(unicodedata.category(c)[0] == "L" for c in text or "")


def to_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


class Network:
    """Filters `tables[k]` of shape (k, 256, FILTERS) with `bias`, dense layer `dense` with `offset`."""

    def __init__(self, tables: list[np.ndarray], bias: np.ndarray, dense: np.ndarray, offset: np.ndarray):
        self.tables, self.bias, self.dense, self.offset = tables, bias, dense, offset
        self._pairs: list[list[np.ndarray]] | None = None

    @classmethod
    def new(cls, classes: int, rng: np.random.Generator) -> Network:
        tables = [rng.normal(0, 0.1, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS]
        size = FILTERS * len(WIDTHS)
        dense = rng.normal(0, 0.1, (size, classes)).astype(np.float32)
        return cls(tables, np.zeros(size, np.float32), dense, np.zeros(classes, np.float32))

    def _joined(self) -> list[list[np.ndarray]]:
        """Per filter width, tables over pairs of bytes (and a last single one)."""
        if self._pairs is None:
            self._pairs = []
            for t in self.tables:
                both = [(t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, -1) for i in range(0, len(t) - 1, 2)]
                self._pairs.append(both + ([t[-1]] if len(t) % 2 else []))
        return self._pairs

    def answers(self, windows: np.ndarray, table: list[np.ndarray], width: int) -> np.ndarray:
        """Filter answers at every place: (windows, places, FILTERS)."""
        places = windows.shape[1] - width + 1
        single = windows.astype(np.int32)
        double = (single[:, :-1] << 8) | single[:, 1:]
        total = None
        for i, t in enumerate(table):
            index = double if len(t) == 65536 else single
            part = t.take(index[:, 2 * i : 2 * i + places], axis=0)
            total = part if total is None else np.add(total, part, out=total)
        return total

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Strongest answers (windows, filters), and their places."""
        best, at = [], []
        for table, width in zip(self._joined(), WIDTHS):
            a = self.answers(windows, table, width)
            if where:
                place = a.argmax(axis=1)
                at.append(place)
                best.append(np.take_along_axis(a, place[:, None, :], 1)[:, 0])
            else:
                best.append(a.max(axis=1))
        return np.concatenate(best, axis=1) + self.bias, at

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows)[0], 0)
        return softmax(hidden @ self.dense + self.offset)

    def arrays(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.dense, self.offset]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, classes: int, seed: int = 7, steps: int = 1500) -> Network:
    """Adam on the cross entropy; the gradient of the maxima goes to the bytes that gave them."""
    rng = np.random.default_rng(seed)
    net = Network.new(classes, rng)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), 64)
        x, y = windows[pick], labels[pick]
        net._pairs = None
        raw, at = _pooled_for_training(net, x)
        hidden = np.maximum(raw, 0)
        p = softmax(hidden @ net.dense + net.offset)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ net.dense.T) * (raw > 0)
        grads = [np.zeros_like(t) for t in net.tables]
        rows = np.arange(len(y))[:, None]
        for g, width, place, part in zip(grads, WIDTHS, at, np.split(back, len(WIDTHS), axis=1)):
            for k in range(width):
                np.add.at(g[k], (x[rows, place + k], np.arange(FILTERS)[None, :]), part)
        grads += [back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]
        rate = 0.01 * (1 - step / (steps + 1))
        for a, g, (m, v) in zip(net.arrays(), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    net._pairs = None
    return net


def _pooled_for_training(net: Network, x: np.ndarray):
    best, at = [], []
    for t, width in zip(net.tables, WIDTHS):
        places = x.shape[1] - width + 1
        a = sum(t[k].take(x[:, k : k + places], axis=0) for k in range(width))
        place = a.argmax(axis=1)
        at.append(place)
        best.append(np.take_along_axis(a, place[:, None, :], 1)[:, 0])
    return np.concatenate(best, axis=1) + net.bias, at


def cut(data: bytes) -> np.ndarray:
    """All windows of a text; the last one padded with zeros."""
    rows = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


class Model:
    """A network with the names of its classes."""

    def __init__(self, arrays: list[np.ndarray] | None, names: list[str]):
        self.names = names
        self.net = Network(arrays[:-3], *arrays[-3:]) if arrays else None

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Names and scores of a batch of texts."""
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not known or self.net is None:
            return names, scores
        data = [to_bytes(texts[i]) for i in known]
        counts = np.array([-(-len(d) // WINDOW) for d in data])
        owner = np.repeat(np.arange(len(known)), counts)
        weight = np.full(len(owner), float(WINDOW))
        weight[np.cumsum(counts) - 1] = [(len(d) - 1) % WINDOW + 1 for d in data]
        windows = np.concatenate([cut(d) for d in data])
        sums = np.zeros((len(known), len(self.names)))
        for at in range(0, len(windows), BATCH):
            part = slice(at, at + BATCH)
            p = self.net.probabilities(windows[part]) * weight[part, None]
            np.add.at(sums, owner[part], p)
        sums /= sums.sum(axis=1, keepdims=True)
        best = sums.argmax(axis=1)
        for i, b, row in zip(known, best, sums):
            names[i] = self.names[b]
            scores[i] = min(float(row[b]), 1.0)
        return names, scores


def learn(docs: DataFrame, sample: int = SAMPLE, sample_all: int = SAMPLE_ALL, windows: int = WINDOWS) -> Model:
    """Train on a bounded sample of the rows with a language that are not held out.

    `sample` rows per language and `sample_all` in all; so that every language gets ten
    rows, the `sample_all` / 10 most frequent ones are learned and no others predicted.
    """
    usable = F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT) & F.col("text").rlike(r"\p{L}")
    known = docs.where(usable)
    # the number of learned languages is bounded by the sample: the most frequent ones
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample_all // 10).collect()
    if not counted:
        return Model(None, [])
    names = sorted(r["lang"] for r in counted)
    each = max(min(sample, sample_all // len(names)), 10)
    rates = {r["lang"]: min(1.0, each / r["n"]) for r in counted}
    rate = F.create_map(*[x for name, r in rates.items() for x in (F.lit(name), F.lit(r))])
    draw = F.abs(F.xxhash64("doc_id")) % 1_000_000 / 1_000_000.0
    text, length = F.lower("text"), F.length("text")
    places = [F.lit(1)] + [
        (F.abs(F.xxhash64("doc_id", F.lit(k))) % F.greatest(length - WINDOW, F.lit(1)) + 1).cast("int") for k in range(1, windows)
    ]
    pieces = F.array(*[F.substring(text, p, F.lit(WINDOW)) for p in places])
    picked = known.where(draw < rate[F.col("lang")]).select("lang", F.xxhash64("doc_id").alias("draw"), F.explode(pieces).alias("piece"))
    rows = picked.limit(2 * windows * sample_all).toPandas().sort_values(["lang", "draw", "piece"])
    rng = np.random.default_rng(11)
    data, labels = [], []
    for lang, piece in zip(rows["lang"], rows["piece"]):
        whole = to_bytes(piece)[:WINDOW]
        # a third of the windows is cut short
        size = int(rng.integers(8, WINDOW)) if rng.random() < 0.34 else WINDOW
        data.append(np.frombuffer(whole[:size].ljust(WINDOW, b"\0"), np.uint8))
        labels.append(names.index(lang))
    labels = np.array(labels)
    # every language is drawn alike
    order = [rng.permutation(np.flatnonzero(labels == k)) for k in range(len(names))]
    most = max(map(len, order))
    even = np.concatenate([np.resize(o, most) for o in order if len(o)])
    net = train(np.stack(data)[even], labels[even], len(names))
    return Model(net.arrays(), names)


def predict(docs: DataFrame, **options) -> DataFrame:
    """All columns of `docs` with held_out, lang_pred and score (which replace columns of these names)."""
    small_batches(docs.sparkSession)
    model = learn(docs, **options)
    shared = docs.sparkSession.sparkContext.broadcast((model.net.arrays() if model.net else None, model.names))

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        for batch in batches:
            names, scores = model.predict(batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    guess = unused(docs, "__guess")
    scored = docs.withColumn(guess, of("text")).withColumn("held_out", fold(F.col("doc_id")) == HELD_OUT)
    return scored.withColumn("lang_pred", F.col(guess)["lang_pred"]).withColumn("score", F.col(guess)["score"]).drop(guess)
