"""Fixtures of these tests; `spark` is that of the whole suite."""

import pytest


@pytest.fixture
def frame(spark):
    """A small table from rows and a schema."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
