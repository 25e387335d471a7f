"""The training-data operators over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.llm import (
    decontaminate,
    hard_negatives,
    html,
    language,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    ranked_search,
    simhash,
    token_counts,
    tokens,
    toxicity,
)
from wireglass.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.predict(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 100 = 0"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.roundtrip(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.groups(table(spark, sf_dir, "documents")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count(table(spark, sf_dir, "documents"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(vectors.withColumn("label", moved))
    return hard_negatives.mine(rows, rows.where("vec_id % 100 = 0"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_text,
        op2_line_dedup,
        op3_language,
        op4_toxicity,
        op5_mixing,
        op6_neighbours,
        op7_token_files,
        op8_simhash,
        op9_licenses,
        op10_decontaminate,
        op11_token_counts,
        op12_ranked_search,
        op13_hard_negatives,
    )
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op5_mixing": mixing.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op12_ranked_search": ranked_search.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
