"""Mixing sources to target weights by Pareto order sampling.

The sources' targets come from weights and a budget; a target stops at
`most_copies` times its source's size, and the excess is shared again by weight
among the others (Spark sums per round, the driver sees two numbers).

With r = target / source size, every document of a source gets floor(r) whole
copies for certain. The rest is a sample: each document has the inclusion
probability p = r - floor(r) and the rank (u / (1 - u)) / (p / (1 - p)) with u
uniform from a hash of its id; documents are taken in rank order as long as the
words left over hold them, so the sample's size is fixed; a document that does not
fit ends a round, and a few more rounds go on behind it. The words that then still
miss are filled with the one document of the rest whose size comes nearest
to them, if that brings the source closer. The prefix over a source is taken in
two levels, per slice of u and within a slice, so a source with a third of all
rows is no single task.

Null or empty texts have size 0 and are returned with 0 taken. Null is a source
of its own, last in order. Rows that repeat an id share u and are ordered by
size; equal rows are interchangeable. Without any words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireglass.llm.common import has_maps, unpacked, whole_row
from wireglass.session import landed

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2
SEED = "mix"
#: Slices of the uniform number per source, for the two-level prefix.
SLICES = 4096
#: Times that rows are taken in rank order: a row that does not fit ends a round.
ROUNDS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from md5 of seed and id: 48 bits, never an end."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def odds(u: Column) -> Column:
    return u / (1.0 - u)


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, weight, target of every source of `sizes` (source, size).

    The sources are ordered by code point, null last, and take the weights in turn.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    # one row per source
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), place)
    sources = landed(totals.select("source", "source_size", weight.alias("weight")), "sources")
    full = float(most) * F.col("source_size")
    want = sources.agg(F.sum("source_size")).first()[0] or 0
    closed = F.lit(False)
    count = -1
    while True:
        state = sources.agg(
            F.coalesce(F.sum(F.when(closed, full)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~closed, F.col("weight"))), F.lit(0)).alias("open"),
            F.count_if(closed).alias("n"),
        ).first()
        share = (budget * want - state["used"]) / state["open"] if state["open"] else 0.0
        if state["n"] == count:
            break
        count = state["n"]
        closed = closed | (F.col("weight") * F.lit(share) > full)
    target = F.when(closed, full).otherwise(F.col("weight") * F.lit(share))
    return sources.withColumn("target", target)


def with_gap(drawn: DataFrame, key: str) -> DataFrame:
    """Adds `gap`: the words of the key that the chosen rows leave of `left`."""
    taken = F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0))
    sums = drawn.groupBy(key).agg((F.max("left") - taken).alias("gap")).withColumnRenamed(key, "__key")
    return drawn.join(sums, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def order_sample(drawn: DataFrame, key: str, slices: int = SLICES) -> DataFrame:
    """Chooses more rows: in order of `rank`, as long as the words that miss hold them.

    `drawn` has the key, size, rank (null: not in the draw), u (uniform, in the
    order of the rank within a key), doc_id, tag (unique), left and chosen. Rows
    larger than the gap can never be taken, and do not stand in the way.
    """
    open_ = ~F.col("chosen") & F.col("rank").isNotNull() & (F.col("size") <= F.col("gap"))
    rows = with_gap(drawn, key).withColumn("fitting", F.when(open_, F.col("size")).otherwise(0))
    rows = rows.withColumn("slice", F.floor(F.col("u") * slices).cast("int"))
    sums = rows.groupBy(key, "slice").agg(F.sum("fitting").alias("inside"))
    # at most `slices` rows per key
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
    starts = starts.select(F.col(key).alias("__key"), F.col("slice").alias("__slice"), "before")
    placed = rows.join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("slice") == F.col("__slice")))
    inside = Window.partitionBy(key, "slice").orderBy("rank", "doc_id", "size", "tag")
    running = F.col("before") + F.sum("fitting").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    chosen = F.col("chosen") | (open_ & (running <= F.col("gap")))
    return placed.withColumn("chosen", chosen).drop("gap", "fitting", "slice", "before", "__key", "__slice")


def fill_gap(drawn: DataFrame, key: str) -> DataFrame:
    """Chooses one more row per key: of those not chosen the one whose size is nearest to the words that miss."""
    miss = F.abs(F.col("size") - F.col("gap"))
    rest = with_gap(drawn, key).where(~F.col("chosen") & F.col("rank").isNotNull() & (miss < F.col("gap")))
    best = rest.groupBy(key).agg(F.min(F.struct(miss, "rank", "doc_id", "size", "tag")).alias("best"))
    joined = drawn.join(best.select(F.col("best.tag").alias("__tag")), F.col("tag") == F.col("__tag"), "left")
    return joined.withColumn("chosen", F.col("chosen") | F.col("__tag").isNotNull()).drop("__tag")


def mix(
    docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES, seed: str = SEED
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, copies, taken."""
    # rows without an id are told apart by their text
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("\0"), "text")).alias("name")
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), name)
    sizes = sizes.withColumn("u", uniform(F.col("name"), seed)).drop("name").withColumn("tag", F.monotonically_increasing_id())
    sizes = landed(sizes, "sizes")
    aims = targets(sizes, weights, budget, most).withColumnRenamed("source", "__source")
    rows = sizes.join(aims, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "weight")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("ratio", ratio).withColumn("whole", F.floor("ratio").cast("bigint"))
    part = F.col("ratio") - F.col("whole")
    rows = rows.withColumn("rank", F.when(part > 0, odds(F.col("u")) / odds(part)))
    left = F.col("target") - F.col("whole") * F.col("source_size")
    drawn = rows.withColumn("left", left).withColumn("chosen", F.lit(False))
    for _ in range(ROUNDS):
        drawn = landed(order_sample(drawn, "source"), "drawn")
    drawn = fill_gap(drawn, "source")
    extra = F.when(F.col("chosen"), 1).otherwise(0)
    drawn = drawn.withColumn("copies", (F.col("whole") + extra).cast("bigint"))
    return drawn.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it was taken, in its own columns.

    The counts are those of `mix` per doc_id. Rows that repeat an id share the
    copies of that id among them, in order of size.
    """
    counts = mix(docs.select("doc_id", "source", "text"), **options).groupBy("doc_id", "size")
    counts = counts.agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    counts = counts.withColumnsRenamed({"doc_id": "__id", "size": "__size"})
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__words") == F.col("__size"))
    rows = docs.select(F.col("doc_id").alias("__doc"), word_count(F.col("text")).alias("__words"), whole_row(docs))
    # equal rows may change places, so what has no order counts by its JSON text
    ties = [F.to_json("__row")] if has_maps(docs.schema) else [F.col("__row")[c] for c in docs.columns if c != "text"]
    # of equal ids and sizes the first rows take what does not divide evenly
    order = Window.partitionBy("__id", "__size").orderBy(F.col("__row")["text"], *ties)
    own = F.floor(F.col("__copies") / F.col("__rows")) + F.when(
        F.row_number().over(order) <= F.col("__copies") % F.col("__rows"), 1
    ).otherwise(0)
    taken = rows.join(counts, same).withColumn("__own", own.cast("int")).where("__own > 0")
    repeated = taken.select("__row", F.explode(F.array_repeat(F.lit(1), F.col("__own"))).alias("__n"))
    return unpacked(repeated, docs.columns)


SQL = r"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, chr(0) || text, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source
), w AS (
  SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total
  FROM t
), o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k,
    count(*) OVER () AS n FROM w
), c AS (  -- the first k sources closed: what each open weight then gets
  SELECT b.k, (max(b.total) - coalesce(sum(2.0::DOUBLE * a.source_size) FILTER (WHERE a.k < b.k), 0.0::DOUBLE))
      / (sum(a.weight) FILTER (WHERE a.k >= b.k))::DOUBLE AS share,
    max(2.0::DOUBLE * b.source_size) AS full_size, max(b.weight) AS weight
  FROM o a CROSS JOIN o b GROUP BY b.k
), level AS (
  SELECT min(k) AS k, arg_min(share, k) AS share FROM c WHERE weight::DOUBLE * share <= full_size
), g AS (
  SELECT source, source_size,
    CASE WHEN o.k < level.k THEN 2.0::DOUBLE * source_size ELSE weight::DOUBLE * level.share END AS target
  FROM o, level
), r AS (
  SELECT s.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS ratio
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source
), q AS (
  SELECT *, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS p,
    target - floor(ratio)::BIGINT * source_size AS words_left, false AS chosen FROM r
), ROUNDS
), gap AS (
  SELECT source, max(words_left) - coalesce(sum(size) FILTER (WHERE chosen), 0) AS gap FROM d GROUP BY source
), best AS (
  SELECT d.doc_id FROM d JOIN gap ON d.source IS NOT DISTINCT FROM gap.source
  WHERE NOT chosen AND p > 0 AND abs(size - gap) < gap
  QUALIFY row_number() OVER (PARTITION BY d.source ORDER BY abs(size - gap), u, d.doc_id) = 1
)
SELECT d.doc_id, size, source_size, target,
  (whole + CASE WHEN chosen OR best.doc_id IS NOT NULL THEN 1 ELSE 0 END) * size AS taken,
  whole + CASE WHEN chosen OR best.doc_id IS NOT NULL THEN 1 ELSE 0 END AS copies
FROM d LEFT JOIN best ON d.doc_id = best.doc_id
"""


def _round_sql(number: int) -> str:
    """One round of the draw over the table of the round before."""
    old, new = f"q{number - 1}" if number > 1 else "q", "d" if number == ROUNDS else f"q{number}"
    return f"""g{number} AS (
  SELECT source, max(words_left) - coalesce(sum(size) FILTER (WHERE chosen), 0) AS gap FROM {old} GROUP BY source
), {new} AS (
  SELECT * EXCLUDE (gap, chosen), chosen OR (p > 0 AND size <= gap AND sum(CASE WHEN NOT chosen AND p > 0 AND size <= gap
      THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY u, doc_id ROWS UNBOUNDED PRECEDING) <= gap) AS chosen
  FROM (SELECT {old}.*, gap FROM {old} JOIN g{number} ON {old}.source IS NOT DISTINCT FROM g{number}.source)"""


SQL = SQL.replace("ROUNDS\n", "\n), ".join(map(_round_sql, range(1, ROUNDS + 1))) + "\n")
