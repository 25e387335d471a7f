"""Session settings the operators are written for."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # small inputs split over the cores, large ones stay at 128 MB per task
    "spark.sql.files.maxPartitionBytes": "128MB",
}


def build_session(
    app: str = "wireglass", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the library's settings; `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder all executors can reach, for streaming state and landed tables.

    The cluster names the shared folder in `spark.checkpoint.dir`. Without it a
    local temporary folder is used if the session runs in this one process, and
    removed when the process ends; on a cluster its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix=f"wireglass-{name}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    token = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return os.path.join(root, f"wireglass-{name}-{token}")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
