"""The corpus pipeline: ordinary documents, one of each near-duplicate group, no benchmark passages, mixed, as token files.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wireglass.llm import decontaminate, mixing, simhash, tokens, toxicity
from wireglass.llm.common import table
from wireglass.session import landed


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled rows does not reject."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every SimHash group."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document written where it stands: doc_id, start, n_tokens, ids_crc32."""
    return tokens.roundtrip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Stages 1 (a trained model), 2 (XXH64) and 5 (a tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
