"""Run queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns, types and rows."""
    left = result.toArrow()
    right = connection.sql(sql).to_arrow_table()
    kinds = [{n: str(t.schema.field(n).type).replace("large_", "") for n in t.column_names} for t in (left, right)]
    if kinds[0] != kinds[1]:
        return f"schema: {set(kinds[0].items()) ^ set(kinds[1].items())}"
    a, b = _rows(left), _rows(right)
    if len(a) != len(b):
        return f"rows: {len(a)} and {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"values {sorted(left.column_names)}: {x} and {y}"
    return None


def main() -> None:
    from wireglass.queries import ORACLES, QUERIES
    from wireglass.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                outcome = difference(result, connection, ORACLES[name]) or "ok"
            else:
                outcome = f"ok (rows only: {result.count()})"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += not outcome.startswith("ok")
        print(f"{name:26s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
