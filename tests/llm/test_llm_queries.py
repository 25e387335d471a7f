"""The registered queries and the pipeline over the given tables."""

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from wireglass.llm.queries import ORACLES, QUERIES
from wireglass.session import landed

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op6_neighbours", "op13_hard_negatives"}))
def test_one_row_each(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(landed(stage(spark, seen[-1], SMALL), name))
    for before, after in zip(seen[:3], seen[1:4]):
        assert after.columns == docs.columns
        assert after.exceptAll(before).count() == 0 and 0 < after.count() < before.count()
    assert seen[2].groupBy("doc_id").count().where("count > 1").count() == 0
    mixed, kept = seen[4], seen[3]
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().join(kept, "doc_id", "left_anti").count() == 0
    files = seen[5]
    assert files.count() == mixed.count()
    last = files.orderBy(F.desc("start"), F.desc("n_tokens")).first()
    assert last["start"] + last["n_tokens"] == files.agg(F.sum("n_tokens")).first()[0]
