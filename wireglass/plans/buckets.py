"""Ordered buckets of bounded size, laid out from a measured distribution.

Spark runs a window with no or few partition keys in few tasks. The plans of
this package cut the order axis into buckets first, work inside the buckets in
parallel and carry small per-bucket summaries across them. A layout says which
bucket a value falls into. It is measured once on the driver (two numbers per
slot, at most `SLOTS` slots), is written into the plan as literals, and is
therefore the same for every retry of every task.

A layout is a hint: any non-decreasing assignment gives the right answer, a
good one gives even buckets. Bursts are handled by splitting crowded slots. Many
rows of one single value (all orders of a day) are split by the next order column,
where the layout was measured with one: values that hold at least two of the
measured quantiles get a layout of their own over that column.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.plans.pinned import pinned

SLOTS = 512
ROWS_PER_BUCKET = 200_000
# a bucket number must stay far away from overflow
_MAX_BUCKETS = 10_000_000
_DAY = 86_400_000_000


def position(column: Column, data_type: T.DataType) -> Column:
    """A long that grows with an integer or timestamp column.

    Timestamps without time zone are read field by field, so that no session
    time zone can bend the order.
    """
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.TimestampNTZType):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60
        micros = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
        return F.unix_date(column.cast("date")).cast("bigint") * _DAY + seconds.cast("bigint") * 1_000_000 + micros
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("bigint") * _DAY
    return column.cast("bigint")


@dataclass(frozen=True)
class Ties:
    """Crowded values of the first order column, each cut by the second one.

    Value t has `slots` slots from lows[t], each widths[t] wide; they hold
    splits[t * slots + slot] buckets.
    """

    values: tuple[int, ...]
    slots: int
    lows: tuple[int, ...]
    widths: tuple[int, ...]
    splits: tuple[int, ...]

    def _each(self) -> list[tuple[int, ...]]:
        return [self.splits[t * self.slots : (t + 1) * self.slots] for t in range(len(self.values))]

    @property
    def extra(self) -> int:
        """Buckets beyond the one that every value has anyway."""
        return sum(sum(s) - 1 for s in self._each())

    def shift(self, first: Column, second: Column) -> Column:
        """What is added to the bucket number; never falls in the order of (first, second)."""
        # crowded values below a value push it up, and a crowded one its own rows by their second column
        pushed = [0, *accumulate(sum(s) - 1 for s in self._each())]
        bases = [base for s in self._each() for base in [0, *accumulate(s)][:-1]]
        below = _rank(first, self.values, 0)
        at = F.least(below, F.lit(len(self.values) - 1))
        offset = F.greatest(second - F.get(longs(self.lows), at), F.lit(0))
        width = F.get(longs(self.widths), at)
        slot = F.least(F.call_function("div", offset, width), F.lit(self.slots - 1)).cast("int")
        cell = at * self.slots + slot
        split = F.get(longs(self.splits), cell)
        within = (offset - slot.cast("bigint") * width).cast("double") / width.cast("double")
        inner = F.get(longs(bases), cell) + F.greatest(F.lit(0), F.least(F.floor(within * split).cast("bigint"), split - 1))
        here = F.coalesce(first == F.get(longs(self.values), at), F.lit(False))
        return F.get(longs(pushed), below) + F.when(here, F.coalesce(inner, F.lit(0))).otherwise(0)


def _rank(value: Column, bounds: tuple[int, ...], least: int) -> Column:
    """Number of bounds below a value, found by halving; `least` are known to be below."""
    if not bounds:
        return F.lit(least)
    half = len(bounds) // 2
    upper = _rank(value, bounds[half + 1 :], least + half + 1)
    return F.when(value > F.lit(bounds[half]), upper).otherwise(_rank(value, bounds[:half], least))


@dataclass(frozen=True)
class Layout:
    """Slot s covers [low + s*width, low + (s+1)*width) and holds `splits[s]` buckets.

    Positions are taken without their `drop` lowest bits, so that no difference
    leaves the range of a long.
    """

    low: int
    width: int
    splits: tuple[int, ...]
    drop: int = 0
    ties: Ties | None = None

    @property
    def count(self) -> int:
        return sum(self.splits)

    @property
    def total(self) -> int:
        """Buckets of `place`."""
        return self.count + (self.ties.extra if self.ties else 0)

    def place(self, df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
        """Add the bucket number of a row by its order columns, crowded values split by the second one."""
        kind = df.schema[order[0]].dataType
        if not self.ties or len(order) < 2:
            return df.withColumn(name, _known(order[0], self.number(F.col(order[0]), kind)))
        places = {f"{name}{i}": position(F.col(c), df.schema[c].dataType) for i, c in enumerate(order[:2])}
        # both are long expressions that the numbering reads many times
        rows = pinned(df, places)
        first, second = (F.col(c) for c in places)
        number = self.number(F.col(order[0]), kind) + self.ties.shift(first, second)
        return rows.withColumn(name, _known(order[0], number)).drop(*places)

    def number(self, column: Column, data_type: T.DataType) -> Column:
        """Bucket number of a value; values outside the range go to the end buckets."""
        if self.count == 1:
            return F.lit(0).cast("bigint")
        offset = _without_bits(position(column, data_type), self.drop) - F.lit(self.low)
        inside = F.greatest(F.lit(0), F.least(offset, F.lit(self.width * len(self.splits) - 1)))
        # exact integer division: a double quotient could misplace values near 2^53
        slot = F.call_function("div", inside, F.lit(self.width)).cast("int")
        if max(self.splits) == 1:
            return slot.cast("bigint")
        bases, total = [], 0
        for split in self.splits:
            bases.append(total)
            total += split
        base = F.get(longs(bases), slot)
        split = F.get(longs(self.splits), slot)
        within = inside - slot.cast("bigint") * F.lit(self.width)
        sub = F.floor(within.cast("double") / F.lit(float(self.width)) * split).cast("bigint")
        return base + F.greatest(F.lit(0), F.least(sub, split - 1))


def _known(name: str, number: Column) -> Column:
    """Rows without a place in the order come first, as in a window."""
    return F.when(F.col(name).isNull(), F.lit(-1).cast("bigint")).otherwise(number.cast("bigint"))


def longs(values) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")


def _without_bits(value: Column, drop: int) -> Column:
    return F.shiftright(value, drop) if drop else value


def measure(frame: DataFrame, column: str, rows_per_bucket: int | None = None, then: str | None = None) -> Layout:
    """Measure a layout for `column` in one pass over that column alone.

    Buckets aim at `rows_per_bucket` rows, and at no fewer buckets than the
    session has cores. The driver receives one row of `SLOTS` quantiles. If some
    values are crowded and `then` names the next order column, a second pass over
    the rows of these values measures that column, `SLOTS` quantiles in all.
    """
    cores = max(frame.sparkSession.sparkContext.defaultParallelism, 1)
    value = position(F.col(column), frame.schema[column].dataType)
    shares = ",".join(f"{i / SLOTS!r}D" for i in range(SLOTS + 1))
    row = frame.select(value.alias("v")).agg(
        F.count("v").alias("n"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.expr(f"percentile_approx(v, array({shares}), {2 * SLOTS})").alias("q"),
    ).first()
    if not row["n"]:
        return Layout(0, 1, (1,))
    rows = min(rows_per_bucket or ROWS_PER_BUCKET, math.ceil(row["n"] / cores))
    low, high, quantiles = row["low"], row["high"], row["q"]
    ties = _measure_ties(frame, column, then, row["n"], quantiles, max(rows, 1)) if then else None
    drop = 2 if high - low >= 1 << 62 else 0
    if drop:
        low, high, quantiles = low >> drop, high >> drop, [q >> drop for q in quantiles]
    return replace(plan_layout(row["n"], low, high, quantiles, max(rows, 1)), drop=drop, ties=ties)


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _measure_ties(frame: DataFrame, column: str, then: str, n: int, quantiles: list[int], rows: int) -> Ties | None:
    """Layouts over `then` of the values that hold two or more quantiles and more rows than a bucket."""
    kinds = frame.schema[column].dataType, frame.schema[then].dataType
    if not isinstance(kinds[1], (*_INTEGERS, T.TimestampType, T.TimestampNTZType, T.DateType)):
        return None
    crowded = sorted(v for v, c in Counter(quantiles).items() if c > 1 and n * c > rows * SLOTS)
    if not crowded:
        return None
    slots = max(SLOTS // len(crowded), 2)
    shares = ",".join(f"{i / slots!r}D" for i in range(slots + 1))
    first, second = position(F.col(column), kinds[0]), position(F.col(then), kinds[1])
    found = (
        frame.select(first.alias("v"), second.alias("s"))
        .where(F.col("v").isin(crowded))
        .groupBy("v")
        .agg(
            F.count("s").alias("n"),
            F.min("s").alias("low"),
            F.max("s").alias("high"),
            F.expr(f"percentile_approx(s, array({shares}), {2 * SLOTS})").alias("q"),
        )
        .collect()
    )
    # differences near the ends of a long are left to the first column
    found = sorted(r for r in found if r["n"] and r["high"] - r["low"] < 1 << 62)
    if not found:
        return None
    plans = [plan_layout(r["n"], r["low"], r["high"], r["q"], rows, slots) for r in found]
    splits = [(*p.splits, *(1,) * (slots - len(p.splits))) for p in plans]
    return Ties(
        tuple(r["v"] for r in found), slots, tuple(p.low for p in plans), tuple(p.width for p in plans), sum(splits, ())
    )


def plan_layout(n: int, low: int, high: int, quantiles: list[int], rows: int, most: int = SLOTS) -> Layout:
    """Choose at most `most` slots, and splits so that a bucket holds about `rows` rows."""
    span = high - low + 1
    slots = max(1, min(most, span, math.ceil(n / rows)))
    width = -(-span // slots)
    steps = max(len(quantiles) - 1, 1)
    splits = []
    for slot in range(slots):
        # share of the quantiles that fall into the slot = share of the rows
        inside = bisect_right(quantiles, low + (slot + 1) * width - 1) - bisect_right(quantiles, low + slot * width - 1)
        crowd = math.ceil(n * inside / steps / rows)
        splits.append(max(1, min(crowd, width, _MAX_BUCKETS // slots)))
    return Layout(low, width, tuple(splits))
