"""WebSocket traffic as streams: whole messages, sessions with their gauge, acknowledgements.

Rows count in the order they arrive: by micro-batch, and inside one by `order`.
Where every session's rows land in their order, the results are those of the
batch forms. What a batch hands to the next is one row per session and its open
frames, in hash buckets (`store.py`), and one number for all sessions together.
Results are written per batch, under its id, so that a batch can run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.operators.messages import (
    acknowledgements,
    clients_gauge,
    ends_message,
    is_control,
    join_frames,
    number_frames,
    session_flags,
)
from wireglass.plans.ordered import neighbours
from wireglass.streaming.store import BucketStore

_BATCH, _CARRIED = "__batch", "__carried"


@dataclass
class SessionStore(BucketStore):
    """Store of a stream whose rows belong to sessions; `buckets` must not change while it lives."""

    spark: SparkSession
    root: str
    order: Sequence[str] = ("ts", "seq")
    buckets: int = 64

    @property
    def _place(self) -> list[str]:
        return [_BATCH, *self.order]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("session_key"), F.lit(self.buckets)).cast("int")

    def _out(self, part: str) -> DataFrame | None:
        """What the completely written batches gave out."""
        there = set(self._listed(f"{self.root}/{part}"))
        paths = [self._path(part, b) for b in range(max(self.batches(), default=-1) + 1) if f"batch={b}" in there]
        return self.spark.read.parquet(*paths) if paths else None

    def _count(self, name: str, batch: int) -> int:
        """A number carried over; 0 before the first batch."""
        return self.spark.read.parquet(self._path(name, batch)).first()[0] if batch >= 0 else 0

    def _set_count(self, name: str, value: int, batch: int) -> None:
        self.spark.range(1).select(F.lit(value).cast("bigint").alias("n")).write.mode("overwrite").parquet(self._path(name, batch))


class MessageAssembly(SessionStore):
    """Whole messages of a stream of frames.

    A session keeps its last boundary, with the number of boundaries up to it,
    and the frames after it. Frames that are never finished stay in the state
    until an open or close event of their session drops them.
    """

    def _write(self, rows: DataFrame, before: dict[int, int], touched: set[int], batch: int) -> None:
        line = rows.withColumns({_BATCH: F.lit(batch).cast("bigint"), _CARRIED: F.lit(None).cast("bigint")})
        old = self._state(before, touched)
        line = line if old is None else old.unionByName(line)
        ends = F.coalesce(_CARRIED, ends_message().cast("bigint"))
        numbered = number_frames(line, self._place, ends).persist()
        try:
            whole = join_frames(numbered.where(F.col(_CARRIED).isNull()), self._place).drop(_BATCH)
            whole.write.mode("overwrite").parquet(self._path("messages", batch))
            # from the last boundary on; its own content has been given out
            known = F.when(ends_message(), F.col("message_no") + ends)
            left = numbered.where(F.col("later").isNull()).withColumn(_CARRIED, known)
            left = left.withColumn("payload", F.when(~ends_message(), F.col("payload")))
            self._keep(left.drop("message_no", "later"), batch)
        finally:
            numbered.unpersist()

    def messages(self) -> DataFrame | None:
        """Messages finished so far; none before the first batch."""
        return self._out("messages")

    def open_frames(self) -> DataFrame | None:
        """Frames that wait for the rest of their message."""
        done = self.batches()
        state = self._state(self.manifest(done[-1])) if done else None
        return None if state is None else state.where(~is_control() & ~F.coalesce("fin", F.lit(False))).drop(_BATCH, _CARRIED)


class SessionRegistry(SessionStore):
    """Sessions and the number of connected clients from a stream of open and close events.

    An event is given out when the next of its session says how long it lasts;
    the last event of every session is the state. The gauge is given out at once.
    """

    def _write(self, rows: DataFrame, before: dict[int, int], touched: set[int], batch: int) -> None:
        opens = F.col("kind") == "open"
        names = ["session_key", *self._place, "kind"]
        flags = list(session_flags(opens))
        line = rows.withColumn(_BATCH, F.lit(batch).cast("bigint")).select(*names)
        old = self._state(before, touched)
        line = line if old is None else line.unionByName(old, allowMissingColumns=True)
        placed = neighbours(line, self._place, [self.order[0], "kind"], keys=["session_key"])
        new = F.col(_BATCH) == batch
        # what an event of an earlier batch changed is known already
        told = {
            name: value if old is None else F.when(new, value).otherwise(F.col(name)) for name, value in session_flags(opens).items()
        }
        until = F.when(opens, F.col(f"next.{self.order[0]}"))
        known = placed.withColumns({**told, "until": until, "__last": F.col("next").isNull()})
        known = known.select(*names, "until", *flags, "__last").persist()
        try:
            known.where("NOT __last").drop("__last", _BATCH).write.mode("overwrite").parquet(self._path("sessions", batch))
            self._keep(known.where("__last").drop("__last", "until"), batch)
            start = self._count("clients", batch - 1)
            arrived = known.where(F.col(_BATCH) == batch)
            clients_gauge(arrived, self.order, start=start).write.mode("overwrite").parquet(self._path("gauge", batch))
            change = arrived.agg(F.coalesce(F.sum("delta"), F.lit(0))).first()[0]
            self._set_count("clients", start + change, batch)
        finally:
            known.unpersist()

    def sessions(self) -> DataFrame | None:
        """Rows as the batch form gives them; `until` is null while an open session lasts."""
        done = self.batches()
        if not done:
            return None
        ended, state = self._out("sessions"), self._state(self.manifest(done[-1]))
        if state is None:
            return ended
        lasting = state.drop(_BATCH).withColumn("until", F.lit(None).cast(ended.schema["until"].dataType))
        return ended.unionByName(lasting.select(*ended.columns))

    def gauge(self) -> DataFrame | None:
        """Connected clients after every event so far."""
        return self._out("gauge")


@dataclass
class MessageCounter(SessionStore):
    """COUNT messages after every `ack_count`-th message of all clients; the state is one number."""

    ack_count: int = 1

    def update(self, rows: DataFrame, batch: int) -> None:
        start = self._count("count", batch - 1)
        rows = rows.select(*self.order).persist()
        try:
            told = acknowledgements(rows, self.ack_count, self.order, start=start)
            told.write.mode("overwrite").parquet(self._path("acks", batch))
            self._set_count("count", start + rows.count(), batch)
        finally:
            rows.unpersist()

    def batches(self) -> list[int]:
        names = [n for n in self._listed(f"{self.root}/count") if "_SUCCESS" in self._listed(f"{self.root}/count/{n}")]
        return sorted(int(n.split("=")[1]) for n in names)

    def acks(self) -> DataFrame | None:
        """COUNT messages so far."""
        return self._out("acks")
