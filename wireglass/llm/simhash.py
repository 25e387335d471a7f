"""SimHash near-duplicates: 64-bit fingerprints linked by an inverted index over byte positions.

Two fingerprints that differ in at most two bits share at least six of their
eight positional bytes, so of the four two-byte blocks at least two agree. The
index posts every distinct fingerprint under its six pairs of blocks (four
positional bytes each). In a short posting list the shared positional bytes of
each pair are tallied, pairs below the guaranteed six are dropped, the rest are
verified by their differing bits. In a long list no pairs are formed: each
member is posted again under itself and its one-bit neighbours within the four
remaining bytes; members that meet there differ in at most two bits, and any two
that do so meet. Such a meeting holds at most 33 members and links them to its
smallest. Both ways are exact, and neither grows with the square of a list.

Components come from alternating star contractions over fingerprints, landed in
the shared folder after every round. A third of all rows with equal text is one
fingerprint before anything is joined.

Null or wordless texts have fingerprint zero and are linked like any other.
Repeated rows are all returned. A null id gets a component like any other row,
null only if all ids of the component are null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import has_maps, small_batches, unpacked, whole_row
from wireglass.session import landed

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SHARED_BYTES = 6
#: Longest posting list whose pairs are formed; longer ones are linked through one-bit neighbours.
SHORT_LIST = 16
BLOCKS = 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = [xxhash.xxh64_digest(joined, SEED)]
    else:
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts = [0, *(e + 1 for e in ends[:-1])]
        digest = xxhash.xxh64_digest
        digests = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    octets = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(octets), 8192):
        ones += np.unpackbits(octets[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(octets))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: Column) -> DataFrame:
    """doc_id and fingerprint `fp` of every row, and `more` columns."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", of("text").alias("fp"), *more)


def _block(fp: Column, number: int) -> Column:
    return F.shiftright(fp, 16 * number).bitwiseAND(F.lit(0xFFFF))


def _postings(fps: DataFrame) -> DataFrame:
    """Six rows per fingerprint: `slot` (which two blocks), `key` (their four bytes), fp."""
    entries = [
        F.struct(
            F.lit(slot).alias("slot"),
            F.shiftleft(_block(F.col("fp"), i), 16).bitwiseOR(_block(F.col("fp"), j)).alias("key"),
        )
        for slot, (i, j) in enumerate(combinations(range(BLOCKS), 2))
    ]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.slot", "e.key")


def _neighbours(slot: Column, fp: Column) -> Column:
    """The fingerprint and its 32 one-bit changes outside the two blocks of the slot."""
    choices = None
    for number, pair in enumerate(combinations(range(BLOCKS), 2)):
        bits = [16 * block + bit for block in range(BLOCKS) if block not in pair for bit in range(16)]
        masks = [0, *((1 << b) - (1 << 64 if b == 63 else 0) for b in bits)]
        values = F.array(*[F.lit(m).cast("bigint") for m in masks])
        choices = values if choices is None else F.when(slot == number, values).otherwise(choices)
    return F.transform(choices, lambda mask: mask.bitwiseXOR(fp))


def links(fps: DataFrame, short: int = SHORT_LIST) -> DataFrame:
    """Pairs (a > b) of distinct fingerprints of at most two differing bits; long lists give a spanning subset of them."""
    postings = landed(_postings(fps), "postings")
    sizes = postings.groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = postings.join(sizes, ["slot", "key"])
    few = sized.where(F.col("n") <= short)
    left, right = few.select("slot", "key", F.col("fp").alias("a")), few.select("slot", "key", F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum(
        (F.when(F.shiftright(differing, 8 * k).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for k in range(8)),
        F.lit(0),
    )
    pairs = left.join(right, ["slot", "key"]).where("a > b").where(tally >= SHARED_BYTES)
    pairs = pairs.where(F.bit_count(differing) <= MAX_BITS).select("a", "b")
    many = sized.where(F.col("n") > short)
    spread = many.select("slot", "key", "fp", F.explode(_neighbours(F.col("slot"), F.col("fp"))).alias("meet"))
    met = spread.groupBy("slot", "key", "meet").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a != b")
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node reachable.

    `edges` has columns a and b. Rounds of large and small stars; each is landed,
    the driver sees a count and a checksum per round.
    """
    current = landed(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    seen = None
    while True:
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(current.agg(F.count("*"), checksum).first())
        if state == seen or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node that is the smallest of its own star has no larger-to-smaller edge left
        large = large.where("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = landed(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "stars")


def _rooted(fps: DataFrame) -> DataFrame:
    """(fp, first, root) of every distinct fingerprint: its smallest doc_id and the fingerprint that names its component."""
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(firsts.select("fp"))).withColumnRenamed("node", "fp")
    return firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fp, component_id (smallest doc_id of the component)."""
    marked = landed(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(marked)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(grouped: DataFrame) -> DataFrame:
    """The contract's columns: the fingerprint as 16 hexadecimal digits."""
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return grouped.select("doc_id", text.alias("fingerprint"), "component_id")


def _row_keys() -> list[Column]:
    """Two 64-bit hashes of doc_id and text, `__a` and `__b`; a hash passes over nulls, so their places are hashed too."""
    parts = [F.col("doc_id").isNull(), F.col("text").isNull(), F.col("doc_id"), F.col("text")]
    return [F.xxhash64(*parts).alias("__a"), F.xxhash64(F.lit(SEED), *parts).alias("__b")]


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, that of the smallest doc_id, with all its columns.

    Rows of the group that repeat that doc_id are reduced to one (the smallest by
    text, then by the other columns); so are the rows of a group without any id.
    An id that stands in several groups is kept in each of which it is the smallest.
    """
    marked = landed(fingerprints(docs, shingle, *_row_keys()), "fingerprints")
    rooted = landed(_rooted(marked).select("fp", "first", "root"), "roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # only these fingerprints can hold a kept row
    holders = rooted.join(smallest, "root").where(F.col("first").eqNullSafe(F.col("component_id")))
    rows = marked.join(holders.select("fp", F.col("root").alias("__root"), "component_id"), "fp")
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("__a", "__b", "__root").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    values = [F.col("__row")["text"], F.col("__row")["doc_id"], *[F.col("__row")[c] for c in others]]
    kept = docs.select(whole_row(docs), *_row_keys()).join(rows, ["__a", "__b"])
    if has_maps(docs.schema):
        # maps have no order: their JSON text stands for them
        ranked = F.struct(*values[:2], F.to_json("__row"))
        one = kept.groupBy("__root").agg(F.min_by("__row", ranked).alias("__row"))
        return unpacked(one, docs.columns)
    names = ["text", "doc_id", *others]
    one = kept.groupBy("__root").agg(F.min(F.struct(*[v.alias(n) for v, n in zip(values, names)])).alias("__row"))
    return unpacked(one, docs.columns)
