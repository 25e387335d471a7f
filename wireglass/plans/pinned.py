"""Evaluate expensive columns once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pinned(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like `withColumns`, but the values are not inlined into later filters.

    Catalyst pushes a filter on a computed column below the projection by
    repeating the computation, once per reference. A one-row generator stops
    that: the values are computed once and stay inside code generation. Filters
    on other columns still pass through.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(name) for name in df.columns if name not in columns]
    return df.select(*kept, F.explode(F.array(values)).alias("__pinned")).select(
        *kept, *[F.col(f"__pinned.{name}").alias(name) for name in columns]
    )
