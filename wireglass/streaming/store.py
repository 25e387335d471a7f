"""State of streaming queries in hash buckets, with a manifest per micro-batch.

A batch reads and writes the buckets its keys fall in and no others; the manifest
says which batch wrote each bucket last. All folders are named after the batch, so
that a batch can run again and a restart goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_BUCKET = "__bucket"


class BucketStore:
    """Base of the stores; a subclass says the bucket of a row and what a batch writes."""

    spark: SparkSession
    root: str

    def _bucket(self) -> Column:
        raise NotImplementedError

    def _write(self, rows: DataFrame, before: dict[int, int], touched: set[int], batch: int) -> None:
        raise NotImplementedError

    def _path(self, part: str, batch: int) -> str:
        return f"{self.root}/{part}/batch={batch}"

    def _hadoop(self, path: str):
        """File system and path, as the cluster's storage sees them."""
        context = self.spark.sparkContext
        there = context._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(context._jsc.hadoopConfiguration()), there

    def _listed(self, path: str) -> list[str]:
        files, there = self._hadoop(path)
        return sorted(e.getPath().getName() for e in files.listStatus(there)) if files.exists(there) else []

    def batches(self) -> list[int]:
        """Ids of the completely written batches, oldest first."""
        names = [n for n in self._listed(f"{self.root}/manifest") if n.startswith("batch=")]
        done = [n for n in names if "_SUCCESS" in self._listed(f"{self.root}/manifest/{n}")]
        return sorted(int(n.split("=")[1]) for n in done)

    def written(self, batch: int) -> list[int]:
        """Buckets that a batch wrote."""
        names = self._listed(self._path("state", batch))
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}="))

    def manifest(self, batch: int) -> dict[int, int]:
        """Batch that wrote each bucket last; at most `buckets` entries."""
        rows = self.spark.read.schema("bucket int, batch long").parquet(self._path("manifest", batch)).collect()
        return {r["bucket"]: r["batch"] for r in rows}

    def _state(self, where: dict[int, int], buckets: set[int] | None = None) -> DataFrame | None:
        paths = [f"{self._path('state', at)}/{_BUCKET}={b}" for b, at in where.items() if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def update(self, rows: DataFrame, batch: int) -> None:
        """foreachBatch function: merge a micro-batch into the buckets it touches."""
        earlier = [b for b in self.batches() if b < batch]
        if batch > 0 and (not earlier or earlier[-1] != batch - 1):
            raise RuntimeError(f"state of batch {batch - 1} is missing below {self.root}")
        before = self.manifest(batch - 1) if batch > 0 else {}
        # a batch is read several times; at most `buckets` numbers come to the driver
        rows = rows.withColumn(_BUCKET, self._bucket()).persist()
        try:
            touched = {r[0] for r in rows.select(_BUCKET).distinct().collect()}
            self._write(rows.drop(_BUCKET), before, touched, batch)
        finally:
            rows.unpersist()
        now = {b: at for b, at in before.items() if b not in touched} | dict.fromkeys(self.written(batch), batch)
        listed = self.spark.createDataFrame(sorted(now.items()), "bucket int, batch long")
        listed.coalesce(1).write.mode("overwrite").parquet(self._path("manifest", batch))
        self._forget(earlier, before, now)

    def _forget(self, earlier: list[int], before: dict[int, int], now: dict[int, int]) -> None:
        """Delete what neither this batch nor the one before it (which can run again) needs."""
        if len(earlier) < 2:
            return
        last = earlier[-2]
        for bucket, at in self.manifest(last).items():
            if before.get(bucket) != at and now.get(bucket) != at:
                self._delete(f"{self._path('state', at)}/{_BUCKET}={bucket}")
        for part in ("manifest", "clock"):
            self._delete(self._path(part, last))

    def _delete(self, path: str) -> None:
        files, there = self._hadoop(path)
        files.delete(there, True)

    def _keep(self, state: DataFrame, batch: int) -> None:
        """Write the state of the touched buckets."""
        # adaptive execution splits a bucket that holds most rows and joins small ones
        placed = state.withColumn(_BUCKET, self._bucket()).hint("rebalance", F.col(_BUCKET))
        placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(self._path("state", batch))

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Run over everything available; the state survives restarts."""
        return (
            stream.writeStream.foreachBatch(self.update)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
