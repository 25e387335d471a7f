"""Ordered computations over a whole table without a one-task window.

Every function works in two levels: inside an ordered bucket with an ordinary
window, and across buckets on one summary row per (keys, bucket). Neither a
table without keys nor a key that holds most of the rows ends up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from wireglass.plans.buckets import Layout, measure

_BUCKET, _KEY = "__bucket", "__key"


def _bucketed(
    df: DataFrame, order: Sequence[str], keys: Sequence[str], layout: Layout | None
) -> tuple[DataFrame, list[str], Layout]:
    """Rows with their key and bucket, the names of both, and the layout.

    The keys travel as one struct: it is never null and equal for equal keys,
    nulls included, so that the window, the totals and the join between them
    all partition by the same columns and the rows are shuffled once.
    """
    layout = layout or measure(df, order[0], then=order[1] if len(order) > 1 else None)
    rows = layout.place(df, order, _BUCKET)
    if keys:
        rows = rows.withColumn(_KEY, F.struct(*keys))
    return rows, [_KEY] if keys else [], layout


def _attach(rows: DataFrame, carry: DataFrame, keys: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Join the one carry row of each (key, bucket) to its rows."""
    on = [*keys, _BUCKET]
    renamed = carry.select(*[F.col(k).alias(f"__carry{k}") for k in on], *extra)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__carry{k}") for k in on])
    return rows.join(renamed, same, "left").drop(*[f"__carry{k}" for k in on])


@dataclass(frozen=True)
class Measure:
    """A running sum, max or min; `inclusive=False` leaves the row's own value out, `backward` runs from the last row."""

    value: Column
    how: str = "sum"
    inclusive: bool = True
    backward: bool = False

    def fold(self, name: str) -> Column:
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.how](name)

    def ordered(self, columns: Sequence[str]) -> list[Column]:
        return [F.col(c).desc() if self.backward else F.col(c).asc() for c in columns]

    def join(self, before: Column, inside: Column) -> Column:
        both = before + inside if self.how == "sum" else F.greatest(before, inside) if self.how == "max" else F.least(before, inside)
        known = F.coalesce(both, inside, before)
        return F.coalesce(known, F.lit(0)) if self.how == "sum" else known


def measures(
    df: DataFrame,
    order: Sequence[str],
    wanted: Mapping[str, Measure],
    keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> DataFrame:
    """Add running measures over one `order`, per `keys`.

    `order` must be total; its first column must be an integer or a timestamp.
    The input is read twice (rows and bucket totals, the latter with few columns).
    """
    values = {f"__v_{name}": measure_.value for name, measure_ in wanted.items()}
    source, part, layout = _bucketed(df.withColumns(values), order, keys, layout)

    def window(m: Measure) -> WindowSpec:
        end = Window.currentRow if m.inclusive else -1
        return Window.partitionBy(*part, _BUCKET).orderBy(*m.ordered(order)).rowsBetween(Window.unboundedPreceding, end)

    def across(m: Measure) -> WindowSpec:
        # one row per (key, bucket), so this window sees summaries only
        return Window.partitionBy(*part).orderBy(*m.ordered([_BUCKET])).rowsBetween(Window.unboundedPreceding, -1)

    inside = {f"__i_{n}": m.fold(f"__v_{n}").over(window(m)) for n, m in wanted.items()}
    rows = source.withColumns(inside)
    before = {n: F.lit(None) for n in wanted}
    if layout.total > 1:
        totals = source.groupBy(*part, _BUCKET).agg(*[m.fold(f"__v_{n}").alias(f"__t_{n}") for n, m in wanted.items()])
        carry = totals.withColumns({f"__b_{n}": m.fold(f"__t_{n}").over(across(m)) for n, m in wanted.items()})
        rows = _attach(rows, carry, part, [f"__b_{n}" for n in wanted])
        before = {n: F.col(f"__b_{n}") for n in wanted}
    result = {n: m.join(before[n], F.col(f"__i_{n}")) for n, m in wanted.items()}
    helpers = [f"__{kind}_{n}" for n in wanted for kind in "vib"]
    return rows.withColumns(result).drop(*helpers, *part, _BUCKET)


def running(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    value: Column,
    how: str = "sum",
    keys: Sequence[str] = (),
    layout: Layout | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """One running measure; see `measures`."""
    return measures(df, order, {name: Measure(value, how, inclusive)}, keys, layout)


def sequence(
    df: DataFrame,
    order: Sequence[str],
    name: str = "seq",
    keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> DataFrame:
    """Number the rows 1, 2, 3, ... in `order`, per `keys`; dense and exact."""
    return running(df, order, name, F.lit(1).cast("bigint"), keys=keys, layout=layout)


def neighbours(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> DataFrame:
    """Add structs `prev` and `next` with `columns` of the adjacent rows of the key.

    They are null at the ends. Same as lag and lead, but a key with very many
    rows is spread over the buckets.
    """
    source, part, layout = _bucketed(df, order, keys, layout)
    own = F.struct(*columns)
    inside = Window.partitionBy(*part, _BUCKET).orderBy(*order)
    rows = source.withColumn("prev", F.lag(own).over(inside)).withColumn("next", F.lead(own).over(inside))
    if layout.total > 1:
        place = F.struct(*order)
        ends = source.groupBy(*part, _BUCKET).agg(
            F.min_by(own, place).alias("__first"), F.max_by(own, place).alias("__last")
        )
        across = Window.partitionBy(*part).orderBy(_BUCKET)
        carry = ends.withColumn("__before", F.lag("__last").over(across)).withColumn(
            "__after", F.lead("__first").over(across)
        )
        rows = _attach(rows, carry, part, ["__before", "__after"])
        rows = rows.withColumn("prev", F.coalesce("prev", "__before")).withColumn(
            "next", F.coalesce("next", "__after")
        )
    return rows.drop("__before", "__after", *part, _BUCKET)
