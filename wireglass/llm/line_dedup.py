"""Cross-site boilerplate lines: how many sites a line is spread over, from HyperLogLog sketches.

A line (trimmed, without empty ones) is known by the hash of its text. Per hash,
sketches of the sites that show it are merged by aggregation, first within each
task. A sketch's estimate decides where it is clear: below `least` by the margin,
a line is kept; above it, it is boilerplate. Lines whose estimate is near the
threshold get the exact number of different sites. Boilerplate lines are removed
from every document.

The documents are read once more for the removal. The set of boilerplate hashes is
joined to the lines (it is broadcast only if Spark measures it to be small), and
only documents that lose lines are put together again.

Null texts stay null and have no lines. A null site counts as a site of its own.
Texts are split at \\n; a removed line goes with its line break, and other lines
keep their text and order, empty lines included. Repeated rows are treated alike
and all kept; rows with the same id but other texts are told apart by a hash of
the text. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import whole_row
from wireglass.session import landed

LEAST = 10
#: log2 of the registers of a sketch, and the relative error (four standard errors) that makes an estimate near.
REGISTERS = 8
MARGIN = 4 * 1.04 / (1 << (REGISTERS // 2))
SITE_COLUMN = "source"


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_hash(line: Column) -> Column:
    """Hash of a trimmed line; null for an empty one."""
    trimmed = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed != "", F.xxhash64(trimmed))


def _places(docs: DataFrame, site: str) -> DataFrame:
    """hash and site of every line that is not empty."""
    hashes = F.transform(lines(F.col("text")), line_hash)
    rows = docs.select(F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"), F.explode(hashes).alias("hash"))
    return rows.where(F.col("hash").isNotNull())


def spread_lines(docs: DataFrame, least: int = LEAST, site: str = SITE_COLUMN) -> DataFrame:
    """Hashes of the lines shown by at least `least` sites."""
    places = _places(docs, site)
    sketched = places.groupBy("hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS))).alias("sites"))
    estimated = landed(sketched.where(F.col("sites") >= least * (1 - MARGIN)), "spread")
    clear = estimated.where(F.col("sites") > least * (1 + MARGIN)).select("hash")
    near = estimated.where(F.col("sites") <= least * (1 + MARGIN)).select("hash")
    exact = places.join(near, "hash", "left_semi").distinct().groupBy("hash").agg(F.count("*").alias("n"))
    return clear.union(exact.where(F.col("n") >= least).select("hash"))


def remove(docs: DataFrame, least: int = LEAST, site: str = SITE_COLUMN) -> DataFrame:
    """All rows with their columns, text without boilerplate lines, n_lines (not empty) and n_removed.

    The last two replace columns of these names.
    """
    bad = landed(spread_lines(docs, least, site), "boilerplate")
    key = [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]
    marked = docs.select(*key, F.explode(F.transform(lines(F.col("text")), line_hash)).alias("hash"))
    hit = marked.where(F.col("hash").isNotNull()).join(bad, "hash").groupBy("doc_id", "text_hash")
    hits = hit.agg(F.collect_set("hash").alias("__hashes"))
    hits = hits.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__hashes")
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    rows = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"), whole_row(docs))
    joined = rows.join(hits, same, "left").select("__row", "__hashes")
    text = F.col("__row")["text"]
    pieces = F.transform(lines(text), lambda x: F.struct(x.alias("line"), line_hash(x).alias("hash")))
    joined = joined.withColumn("__lines", pieces)
    # null-safe: an empty line has no hash and stays
    stay = F.filter("__lines", lambda x: ~F.coalesce(F.array_contains("__hashes", x["hash"]), F.lit(False)))
    clean = F.array_join(F.transform(stay, lambda x: x["line"]), "\n")
    full = F.size(F.filter("__lines", lambda x: x["hash"].isNotNull()))
    left = F.size(F.filter(stay, lambda x: x["hash"].isNotNull()))
    made = {
        "text": F.when(F.col("__hashes").isNull(), text).otherwise(clean),
        "n_lines": F.coalesce(full, F.lit(0)).cast("bigint"),
        "n_removed": F.coalesce(full - left, F.lit(0)).cast("bigint"),
    }
    # in two steps, so that no column of the table is named like one that is still read
    ready = joined.select("__row", F.struct(*[value.alias(name) for name, value in made.items()]).alias("__made"))
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in made]
    return ready.select(*kept, *[F.col("__made")[name].alias(name) for name in made])


SQL = r"""
WITH l AS (
  SELECT doc_id, source, k, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM (SELECT doc_id, source, text, row_number() OVER () AS k FROM documents)
), t AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS trimmed FROM l
), bad AS (
  SELECT trimmed FROM t WHERE trimmed <> '' GROUP BY trimmed HAVING count(DISTINCT coalesce(source, chr(0))) >= 10
), d AS (
  SELECT k, any_value(doc_id) AS doc_id,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.trimmed IS NULL), '') AS text,
    count(*) FILTER (WHERE t.trimmed <> '')::BIGINT AS n_lines, count(bad.trimmed)::BIGINT AS n_removed
  FROM t LEFT JOIN bad ON t.trimmed = bad.trimmed GROUP BY k
)
SELECT doc_id, text, n_lines, n_removed FROM d
UNION ALL SELECT doc_id, text, 0, 0 FROM documents WHERE text IS NULL
"""
