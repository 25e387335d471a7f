"""Token counts by heap-and-linked-list byte-pair merging: numbers only, no token is made.

A text is cut into chunks over which no piece of the vocabulary reaches, so that
every chunk can be merged by itself. A chunk starts as a linked list of its
characters. All neighbours that form a piece stand in a heap, the lowest rank
first and of equal ranks the leftmost. The top is popped; if its two symbols are
still there they become one, and the pairs that the new symbol forms with its
neighbours are pushed. When the heap is empty the count is the number of
characters less that of merges. A character that is no piece counts as its UTF-8
bytes (byte fallback) or as one unknown.

Rules of the library for such a model: text as it is (no normalisation), spaces
become U+2581, one is put in front of a text that is not empty, and the
strings of control pieces are ordinary text. Models with other rules (a
normalisation table, removed spaces, user-defined or unused pieces, no BPE) are
refused.

Counts of chunks are remembered by the worker (HELD of them, then it starts
anew); a chunk of n characters takes O(n log n), and texts have any length.

A null text counts like an empty one: no bytes, no tokens. Repeated rows are
counted each. An empty table gives an empty result. Extra columns are kept;
columns named like results are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import small_batches

MODEL = "piece_bpe_32k.model"
#: More tokens than this are over the limit.
LIMIT = 4096
#: Chunks whose counts a worker remembers, and the longest that it does.
HELD, HELD_LENGTH = 400_000, 48
SPACE = "▁"


class Merges:
    """What a model file says about merging: ranks of pieces, and whether bytes stand for unknown characters."""

    def __init__(self, ranks: dict[str, int], byte_fallback: bool = True, prefix: bool = True):
        self.ranks, self.byte_fallback, self.prefix = ranks, byte_fallback, prefix
        self.longest = max(map(len, ranks), default=1)
        joined = [p for p in ranks if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in joined):
            raise ValueError("a piece goes on behind a space: chunks would not be independent")
        # characters that no longer piece holds stand alone; ASCII ones are cut off so that chunks repeat more often
        inside = set("".join(joined))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else "")).findall

    @classmethod
    def load(cls, path: str) -> Merges:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = schema.ModelProto.SentencePiece
        refused = (
            trained.model_type != schema.TrainerSpec.BPE
            or bool(rules.precompiled_charsmap)
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
            or trained.treat_whitespace_as_suffix
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        )
        if refused:
            raise ValueError(f"{path} has rules that are not supported here")
        scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        # equal scores have equal ranks: then the place decides
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        ranks = {piece: order[score] for piece, score in scores.items()}
        return cls(ranks, trained.byte_fallback, rules.add_dummy_prefix)

    def tokens(self, chunk: str) -> int:
        """Tokens of one chunk."""
        ranks, size = self.ranks, len(chunk)
        symbols: list[str | None] = list(chunk)
        if size > 1:
            following, previous = list(range(1, size + 1)), list(range(-1, size - 1))
            # rank, place, and the length of the piece, by which outdated pairs are told
            heap = [(ranks[p], i, 2) for i in range(size - 1) if (p := chunk[i : i + 2]) in ranks]
            heapq.heapify(heap)
            while heap:
                _, i, length = heapq.heappop(heap)
                left = symbols[i]
                if left is None or (j := following[i]) >= size or len(left) + len(symbols[j]) != length:
                    continue
                symbols[i], symbols[j] = left + symbols[j], None
                after = following[i] = following[j]
                if after < size:
                    previous[after] = i
                    self._push(heap, symbols, i, after)
                if previous[i] >= 0:
                    self._push(heap, symbols, previous[i], i)
        return sum(self._cost(s) for s in symbols if s is not None)

    def _push(self, heap: list, symbols: list, i: int, j: int) -> None:
        length = len(symbols[i]) + len(symbols[j])
        if length <= self.longest and (rank := self.ranks.get(symbols[i] + symbols[j])) is not None:
            heapq.heappush(heap, (rank, i, length))

    def _cost(self, symbol: str) -> int:
        known = symbol in self.ranks or not self.byte_fallback
        return 1 if known else len(symbol.encode("utf-8", "surrogatepass"))


class Counts(dict):
    """Tokens by chunk, merged when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, chunk: str) -> int:
        count = self.merges.tokens(chunk)
        if len(chunk) <= HELD_LENGTH:
            if len(self) >= HELD:
                self.clear()
            self[chunk] = count
        return count

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        whole = (SPACE if self.merges.prefix else "") + text.replace(" ", SPACE)
        return sum(map(self.__getitem__, self.merges.chunks(whole)))


def count(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """All columns of `docs`, and n_bytes, n_tokens, over_limit of the column text.

    `model` is the path of the model file on every executor.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        path = model
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        counts = Counts(Merges.load(path))
        for texts in batches:
            yield pd.Series([counts.of(t) for t in texts], dtype="int64")

    counted = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = counted.withColumn("n_tokens", tokens("text"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
