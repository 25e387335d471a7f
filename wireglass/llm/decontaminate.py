"""Benchmark decontamination: a broadcast hash set of normalised test windows, scanned over all texts.

Built-in functions only. A document is tokenised once, and one 64-bit hash made
for every window of its words (from the hashes of neighbouring pairs). The hash is
looked up map-side in a set of the benchmark's window hashes, a literal of the
plan: SET_BITS bits or more per window, two places per hash, so that under one
per cent of other windows pass. The set grows with the benchmark; above
SET_WINDOWS windows of a length it is split, and the texts are scanned once for
each part. Only places that pass are cut to their window text, written, and joined to
the windows, whose text must be equal: every hit is verified on its words, and false
positives cost time only. Beside them one narrow row per document is shuffled. A
window that a large part of the corpus holds makes a skewed key only where the
windows are too many for Spark to broadcast; adaptive execution splits it there.

Nulls and empties: a null or wordless text has no words and no hits; null or
wordless items have no windows. Repeated rows are all returned, each with its
own result; rows that agree in id and text share the computation. Extra columns
are ignored by `scan` and kept by the removals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import lower_az, unpacked, whole_row
from wireglass.plans.pinned import pinned
from wireglass.session import landed

# what separates words after lower-casing
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same words before lower-casing, each with what follows it
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Bits of the hash set per window, and windows of one length that a part of the set holds at most (4 to 8 MB of bits).
SET_BITS = 32
SET_WINDOWS = 1 << 20
SPOT = "struct<at:int,len:int,hash:bigint>"


def words(text: Column) -> Column:
    found = F.array_remove(F.split(lower_az(text), GAP), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _hashed(rows: DataFrame) -> DataFrame:
    """Adds the hashes of the words in `w` (`h`) and of the pairs of neighbours (`pairs`), each evaluated once per row."""
    rows = pinned(rows, {"h": F.transform("w", lambda w: F.xxhash64(w))})
    after = F.slice("h", F.lit(2), F.greatest(F.size("h") - 1, F.lit(0)))
    until = F.slice("h", F.lit(1), F.greatest(F.size("h") - 1, F.lit(0)))
    return pinned(rows, {"pairs": F.zip_with(until, after, lambda a, b: F.xxhash64(a, b))})


def _window_hashes(size: int) -> Column:
    """One hash per window of `size` words, of the hashes of the pairs that cover it."""
    if size == 1:
        return F.col("h")
    offsets = sorted({*range(0, size - 1, 2), size - 2})
    starts = F.slice("pairs", F.lit(1), F.greatest(F.size("pairs") - (size - 2), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get("pairs", i + k) for k in offsets[1:]]))


def _slots(value: Column, bits: int) -> list[Column]:
    """The two places of a hash in a set of `bits` bits (a power of two, 2^32 at most)."""
    mask = F.lit(bits - 1).cast("bigint")
    return [value.bitwiseAND(mask), F.shiftrightunsigned(value, 32).bitwiseAND(mask)]


def _hash_set(windows: DataFrame, n: int) -> tuple[Column, int]:
    """Bits of the hashes of `n` windows as a literal array of longs, and their number.

    Spark puts them together; the driver receives one text of some MB, for SET_WINDOWS windows 20 MB at most.
    """
    bits = 1 << max(6, (SET_BITS * n - 1).bit_length())
    slots = windows.select(F.explode(F.array(*_slots(F.col("hash"), bits))).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    longs = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(one).alias("long"))
    every = windows.sparkSession.range(bits // 64).withColumnRenamed("id", "at")
    dense = every.join(longs, "at", "left").select("at", F.coalesce("long", F.lit(0).cast("bigint")).alias("long"))
    packed = F.array_sort(F.collect_list(F.struct("at", "long")))
    text = dense.agg(F.array_join(F.transform(packed, lambda x: x["long"].cast("string")), ",")).first()[0]
    return F.split(F.lit(text), ",").cast("array<bigint>"), bits


def _in_set(value: Column, longs: Column, bits: int) -> Column:
    def test(slot: Column) -> Column:
        at = F.get(longs, F.shiftright(slot, 6).cast("int"))
        return F.call_function("getbit", at, slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    first, second = _slots(value, bits)
    return test(first) & test(second)


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: hash, length, text and the sorted ids of the items that hold it."""
    tokens = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    tokens = tokens.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(size)))
    placed = tokens.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)))
    cut = placed.select("item", "len", F.slice("w", F.col("at"), F.col("len")).alias("w"))
    return cut.groupBy("w", "len").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _hashed_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Written windows with their hash: hash, len, window (its text), items."""
    rows = _hashed(benchmark_windows(benchmark, size))
    value = F.coalesce(*[F.when(F.col("len") == n, F.get(_window_hashes(n), F.lit(0))) for n in range(1, size + 1)])
    return landed(rows.select(value.alias("hash"), "len", F.array_join("w", " ").alias("window"), "items"), "windows")


def _spot(n: int, longs: Column, bits: int):
    """Function of a window's hash and its position: its place if the set has the hash, else null."""

    def of(value: Column, i: Column) -> Column:
        place = F.struct((i + 1).alias("at"), F.lit(n).alias("len"), value.alias("hash"))
        return F.when(_in_set(value, longs, bits), place).otherwise(F.lit(None).cast(SPOT))

    return of


def _places(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per document (at = 0) and one per place that passes the hash set: doc_id, text_hash, at, len, n_words, hash, cut."""
    counts = {r["len"]: r["n"] for r in windows.groupBy("len").agg(F.count("*").alias("n")).collect()}
    parts = {n: -(-count // SET_WINDOWS) for n, count in counts.items()}
    read = pinned(docs.select("doc_id", "text"), {"text_hash": F.xxhash64("text"), "w": words(F.col("text"))})
    read = _hashed(read.drop("text"))
    passes = []
    for part in range(max(parts.values(), default=1)):
        lengths = sorted(n for n in parts if part < parts[n])
        rows = pinned(read, {f"hashes{n}": _window_hashes(n) for n in lengths}) if lengths else read
        row = F.struct(F.lit(0).alias("at"), F.lit(0).alias("len"), F.lit(0).cast("bigint").alias("hash"))
        spots = [F.array(F.lit(None).cast(SPOT) if part else row)]
        for n in lengths:
            some = windows.where((F.col("len") == n) & (F.pmod("hash", F.lit(parts[n])) == part))
            longs, bits = _hash_set(some, min(counts[n], SET_WINDOWS))
            spots.append(F.transform(f"hashes{n}", _spot(n, longs, bits)))
        passed = pinned(rows, {"spots": F.array_compact(F.concat(*spots))})
        passes.append(passed.select("doc_id", "text_hash", "w", F.explode("spots").alias("spot")))
    text = F.array_join(F.slice("w", F.greatest("spot.at", F.lit(1)), F.col("spot.len")), " ")
    placed = reduce(DataFrame.unionAll, passes).select(
        "doc_id", "text_hash", "spot.*", F.size("w").alias("n_words"), text.alias("cut")
    )
    return landed(placed, "places")


def _hits(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """Places whose words are those of a window: doc_id, text_hash, at, len, items."""
    side = windows.withColumnsRenamed({"hash": "item_hash", "len": "item_len"})
    same = (F.col("hash") == F.col("item_hash")) & (F.col("len") == F.col("item_len")) & (F.col("cut") == F.col("window"))
    return placed.where("at > 0").join(side, same).select("doc_id", "text_hash", "at", "len", "items")


def _per_document(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    """One row per distinct (doc_id, text): copies, n_words, hit word positions, items."""
    hit = F.col("at") > 0
    covered = F.when(hit, F.sequence(F.col("at"), F.col("at") + F.col("len") - 1))
    windows = _hashed_windows(benchmark, size)
    placed = _places(docs, windows)
    every = placed.where("at = 0").select("doc_id", "text_hash", "at", "len", "n_words")
    return (
        every.unionByName(_hits(placed, windows), allowMissingColumns=True)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count_if(~hit).cast("int").alias("copies"),
            F.max("n_words").cast("bigint").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list(covered))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))).alias("items"),
        )
    )


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    found = _per_document(docs, benchmark, size)
    rows = found.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        "items",
        (F.size("hits") > 0).alias("contaminated"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of a scan."""
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", sha.alias("items_sha256"), "contaminated")


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Documents without any hit, with all their columns."""
    windows = _hashed_windows(benchmark, size)
    bad = _hits(_places(docs, windows), windows).select("doc_id", "text_hash").distinct()
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"), whole_row(docs))
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    return unpacked(rows.join(bad, same, "left_anti"), docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """All documents, the hit words (and what separates them from the next word) cut out of their text."""
    found = landed(
        _per_document(docs, benchmark, size)
        .where(F.size("hits") > 0)
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "hits"),
        "hits",
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    dirty = docs.select("doc_id", "text").join(found, same).dropDuplicates(["__id", "__hash"])
    pieces = dirty.select(
        "__id",
        "__hash",
        F.regexp_extract("text", LEAD, 0).alias("lead"),
        F.posexplode(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))).alias("at", "piece"),
    )
    cut = found.select("__id", "__hash", F.explode(F.transform("hits", lambda x: x - 1)).alias("at"))
    on = [pieces[c].eqNullSafe(cut[c]) for c in ("__id", "__hash", "at")]
    left = pieces.join(cut, on, "left_anti")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"])
    clean = left.groupBy("__id", "__hash", "lead").agg(F.array_join(parts, "").alias("rest"))
    clean = clean.select("__id", "__hash", F.concat("lead", "rest").alias("__clean"))
    # a document that loses all its words has no row there
    clean = found.select("__id", "__hash").join(
        clean.withColumnsRenamed({"__id": "__i", "__hash": "__h"}),
        F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__h")),
        "left",
    )
    clean = clean.select("__id", "__hash", F.coalesce("__clean", F.lit("")).alias("__clean"))
    rows = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"), whole_row(docs))
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    row = F.col("__row")
    columns = [F.coalesce("__clean", row[c]).alias(c) if c == "text" else row[c].alias(c) for c in docs.columns]
    return rows.join(clean, same, "left").select(*columns)


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), ip AS (
  SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM i WHERE len(ws) > 0
), iw AS (
  SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS win FROM ip
), spot AS (
  SELECT k, n, ws, unnest(range(1, len(ws) - n + 2)) AS p FROM w, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n
), hit AS (
  SELECT k, p, spot.n AS n, item FROM spot JOIN iw ON spot.n = iw.n AND array_to_string(ws[p:p + spot.n - 1], ' ') = win
), h AS (
  SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM hit) GROUP BY k
), m AS (
  SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY k
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (k) LEFT JOIN m USING (k)
"""
