"""Every registered query against its SQL, and the anchor numbers of the fixtures."""

import pytest
from compare import connect, difference
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

import __spark_entry__ as contract

QUERIES = {k: q for k, q in contract.queries().items() if k not in contract.LLM_QUERIES}
ORACLES = {k: q for k, q in contract.oracle_sql().items() if k not in contract.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_anchors_views(spark):
    row = QUERIES["view_part1"](spark, MEDIUM).agg(F.count("*"), F.sum("event_id")).first()
    assert tuple(row) == (2400, 20953978)
    row = QUERIES["view_last_batch"](spark, MEDIUM).agg(F.count("*"), F.sum("event_id")).first()
    assert tuple(row) == (2400, 18207883)
    assert QUERIES["answer_view_requests"](spark, MEDIUM).select("request_id").distinct().count() == 1895


def test_anchors_exchange(spark):
    row = QUERIES["request_metrics"](spark, MEDIUM).first()
    assert (row["received"], row["responded"] + row["errors"], row["timeouts"]) == (10000, 2416, 7584)
    assert row["key_not_found"] == 9655
    assert QUERIES["active_gauge"](spark, MEDIUM).agg(F.max("active")).first()[0] == 3


def test_anchors_messages(spark):
    kinds = QUERIES["ws_sessions"](spark, MEDIUM).agg(
        F.count_if(F.col("kind") == "open"),
        F.count_if("duplicate_open"),
        F.count_if(F.col("kind") == "close"),
        F.count_if("stray_close"),
    )
    assert tuple(kinds.first()) == (2017, 970, 2014, 1046)
    assert QUERIES["ws_clients_gauge"](spark, MEDIUM).agg(F.max("clients")).first()[0] == 91
    assert QUERIES["ws_fanout"](spark, MEDIUM).count() == 291664
    assert QUERIES["ws_ack"](spark, MEDIUM).count() == 398
