"""Live views: window contents kept by a streaming query.

The state lies in hash buckets of the keys. A micro-batch reads and writes the
buckets that its keys fall in and no others; a manifest per batch says which
batch wrote each bucket last, so that a batch can run again and a restart goes on.

A count window keeps the newest rows per key with their running number: a batch
adds, per key, only its newest rows and its row count, both cut down before the
shuffle. Other windows keep what can still be shown: rows leave by time, value or
punctuation, not by number. A row that comes too late to be ever shown goes to a
table of rejects. No Python code sees single rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wireglass.operators.view import Delta, Punctuation, SlidingTime, TumblingTime, ViewSpec
from wireglass.streaming.store import BucketStore

_NUMBER = "__r"


@dataclass
class LiveView(BucketStore):
    """Snapshot store of one view port below `root` (a folder executors share).

    `state/batch=<id>/__bucket=<b>` holds the buckets that a batch wrote, `clock` the
    newest row of the stream (or the two newest punctuations), `late` the rejects,
    and `manifest` which folders count. `evict_after` removes partitions whose newest
    row is that much older than the newest row of the stream. `buckets` should grow
    with the number of keys, so that a bucket stays far below a task's memory; it
    must not change while the view lives.

    A delta window keeps what is near the newest value and lets go the rest for good,
    so its contents equal the batch view where the attribute does not turn back.
    """

    spark: SparkSession
    root: str
    spec: ViewSpec
    evict_after: timedelta | None = None
    schema: T.StructType | None = None
    buckets: int = 64

    def __post_init__(self) -> None:
        if self.evict_after is not None and isinstance(self.spec.window, Punctuation):
            raise ValueError("a punctuation window empties its partitions itself")

    @property
    def _clocked(self) -> bool:
        return self.spec.window is not None or self.evict_after is not None

    @property
    def _trigger(self) -> int:
        return self.spec.n if self.spec.tumbling else self.spec.trigger

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("int") if self.spec.keys else F.lit(0)

    def _clock(self, batch: int) -> DataFrame | None:
        return self.spark.read.parquet(self._path("clock", batch)) if batch >= 0 and self._clocked else None

    def _write(self, rows: DataFrame, before: dict[int, int], touched: set[int], batch: int) -> None:
        clock, old, window = self._clock(batch - 1), self._state(before, touched), self.spec.window
        if old is not None and self.evict_after is not None:
            old = self._living(old, clock)
        if window is not None:
            too_late(rows, old, clock, self.spec).write.mode("overwrite").parquet(self._path("late", batch))
        if self._clocked:
            seen = rows if clock is None else clock.unionByName(rows)
            marks = isinstance(window, Punctuation)
            seen = seen.where(F.col(window.column)) if marks else seen
            newest = seen.orderBy(*[F.col(c).desc() for c in self.spec.order]).limit(2 if marks else 1)
            newest.write.mode("overwrite").parquet(self._path("clock", batch))
        if window is None:
            merged = merge_state(old, rows, self.spec, self._trigger)
        else:
            merged = still_needed(rows if old is None else old.unionByName(rows), self._clock(batch), self.spec)
        self._keep(merged, batch)

    def _living(self, state: DataFrame, clock: DataFrame) -> DataFrame:
        """Without the partitions that are idle for too long."""
        ts, keys = self.spec.order[0], list(self.spec.keys)
        own = F.max(ts).over(Window.partitionBy(*keys)) if keys else state.agg(F.max(ts)).scalar()
        newest = clock.agg(F.max(ts)).scalar()
        return state.withColumn("__own", own).where(F.col("__own") > newest - F.lit(self.evict_after)).drop("__own")

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Run over everything available; the state survives restarts."""
        self.schema = stream.schema
        return super().start(stream)

    def contents(self, batch: int | None = None) -> DataFrame:
        """Rows visible after a batch, by default the last one; none before the first."""
        done = self.batches()
        if batch is None and done:
            batch = done[-1]
        state = None if batch is None else self._state(self.manifest(batch))
        if state is None:
            return self.spark.createDataFrame([], self.schema or T.StructType())
        clock = self._clock(batch)
        if self.evict_after is not None:
            state = self._living(state, clock)
        if self.spec.window is None:
            return visible(state, self.spec, self._trigger)
        if isinstance(self.spec.window, TumblingTime | Punctuation):
            # the newest row and punctuations are never shown themselves; they say what is
            state = state.join(clock, list(self.spec.order), "left_anti").unionByName(clock)
        return self.spec.window.contents(state, self.spec.order, self.spec.keys)

    def late(self) -> DataFrame:
        """Rows that came too late to be shown, of all batches."""
        paths = [f"{self.root}/late/{n}" for n in self._listed(f"{self.root}/late")]
        if not paths:
            return self.spark.createDataFrame([], self.schema or T.StructType())
        return self.spark.read.parquet(*paths)


# ---- windows by time, value and punctuation ------------------------------------------


def _window_end(clock: DataFrame, window: TumblingTime, ts: str) -> Column:
    """Start of the open window of the newest row: the end of the one that is shown."""
    width, shift = (f"{round(t.total_seconds() * 1e6)} microseconds" for t in (window.size, window.start))
    newest = clock.agg(F.max(ts).alias(ts))
    return newest.select(F.window(ts, width, startTime=shift)["start"].alias("end")).scalar()


def still_needed(rows: DataFrame, clock: DataFrame, spec: ViewSpec) -> DataFrame:
    """Rows that the window shows now or may show later."""
    window, ts = spec.window, spec.order[0]
    if isinstance(window, TumblingTime):
        return rows.where(F.col(ts) >= _window_end(clock, window, ts) - F.lit(window.size))
    if isinstance(window, Punctuation):
        place = F.struct(*spec.order)
        marks = clock.agg(F.min(place).alias("open"), F.count("*").alias("n"))
        opened = marks.select(F.when(F.col("n") == 2, F.col("open"))).scalar()
        kept = rows.where(~F.coalesce(F.col(window.column), F.lit(False)))
        return kept.where(F.coalesce(place > opened, F.lit(True)))
    return window.contents(rows, spec.order, spec.keys)


def too_late(rows: DataFrame, old: DataFrame | None, clock: DataFrame | None, spec: ViewSpec) -> DataFrame:
    """Rows of a batch that the state before it rules out for good."""
    window, ts, keys = spec.window, spec.order[0], list(spec.keys)
    if clock is None:
        return rows.limit(0)
    place = F.struct(*spec.order)
    if isinstance(window, TumblingTime):
        return rows.where(F.col(ts) < _window_end(clock, window, ts) - F.lit(window.size))
    if isinstance(window, Punctuation):
        marks = clock.agg(F.min(place).alias("open"), F.count("*").alias("n"))
        opened = marks.select(F.when(F.col("n") == 2, F.col("open"))).scalar()
        return rows.where(F.coalesce(place < opened, F.lit(False)))
    if old is None:
        return rows.limit(0)
    newest = [F.max(place).alias("__place"), F.max(ts).alias("__ts")]
    if isinstance(window, Delta):
        newest.append(F.max_by(window.attribute, place).alias("__value"))
    # one narrow row per key of the touched buckets
    whose = F.struct(*keys) if keys else F.lit(0)
    summary = old.groupBy(whose.alias("__key")).agg(*newest)
    if isinstance(window, SlidingTime):
        ruled_out = F.col(ts) <= F.col("__ts") - F.lit(window.size)
    else:
        ruled_out = (place < F.col("__place")) & (F.abs(F.col("__value") - F.col(window.attribute)) > F.lit(window.distance))
    return rows.join(summary, whose == F.col("__key")).where(ruled_out).select(*rows.columns)


# ---- count windows ---------------------------------------------------------------------


def _numbered(rows: DataFrame, depth: int, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Newest `depth` rows per key with their number inside the batch."""
    newest = [F.col(c).desc() for c in order]
    if keys:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__count"))
        counts = counts.withColumnsRenamed({k: f"__{k}" for k in keys})
        back = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        top = rows.withColumn("__back", back).where(F.col("__back") <= depth)
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
        placed = top.join(counts, same).drop(*[f"__{k}" for k in keys])
    else:
        top = rows.orderBy(*newest).limit(depth)
        # at most `depth` rows
        top = top.withColumn("__back", F.row_number().over(Window.orderBy(*newest)))
        placed = top.withColumn("__count", rows.agg(F.count(F.lit(1))).scalar())
    number = (F.col("__count") - F.col("__back") + 1).cast("bigint")
    return placed.withColumn(_NUMBER, number).drop("__back", "__count")


def merge_state(old: DataFrame | None, rows: DataFrame, spec: ViewSpec, trigger: int) -> DataFrame:
    """State after a batch: newest n + trigger - 1 rows per key, numbered from the start."""
    depth, keys = spec.n + trigger - 1, list(spec.keys)
    fresh = _numbered(rows, depth, spec.order, keys)
    if old is None:
        return fresh
    offsets = old.groupBy(*keys).agg(F.max(_NUMBER).alias("__offset"))
    if keys:
        offsets = offsets.withColumnsRenamed({k: f"__{k}" for k in keys})
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
        fresh = fresh.join(offsets, same, "left").drop(*[f"__{k}" for k in keys])
    else:
        fresh = fresh.withColumn("__offset", offsets.scalar())
    fresh = fresh.withColumn(_NUMBER, F.col(_NUMBER) + F.coalesce("__offset", F.lit(0))).drop("__offset")
    both = old.unionByName(fresh)
    newest = F.col(_NUMBER).desc()
    if not keys:
        return both.orderBy(newest).limit(depth)
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(newest))
    return both.withColumn("__back", back).where(F.col("__back") <= depth).drop("__back")


def visible(state: DataFrame, spec: ViewSpec, trigger: int) -> DataFrame:
    """Rows of the window as of the last trigger."""
    keys = list(spec.keys)
    count = F.max(_NUMBER).over(Window.partitionBy(*keys)) if keys else state.agg(F.max(_NUMBER)).scalar()
    shown = F.col("__count") - F.pmod(F.col("__count"), F.lit(trigger))
    rows = state.withColumn("__count", count)
    rows = rows.where((F.col(_NUMBER) <= shown) & (F.col(_NUMBER) > shown - spec.n))
    return rows.drop("__count", _NUMBER)
