"""Readers and writers of landed traffic.

Schemas are fixed, nothing is inferred. Batch and streaming read the same
files; any other source (a message broker, a lake table) only has to give a
frame with these columns.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


_LONG, _TEXT, _INSTANT, _BYTES = T.LongType(), T.StringType(), T.TimestampType(), T.BinaryType()
_HEADERS = T.MapType(_TEXT, _TEXT)

RAW_REQUESTS = (
    T.StructType()
    .add("request_id", _LONG)
    .add("ts", _INSTANT)
    .add("method", _TEXT)
    .add("url", _TEXT)
    .add("content_type", _TEXT)
    .add("headers", _HEADERS)
    .add("body", _BYTES)
)
RESPONSES = (
    T.StructType()
    .add("key", _LONG)
    .add("rsp_ts", _INSTANT)
    .add("rsp_id", _LONG)
    .add("response", _TEXT)
    .add("status", T.IntegerType())
    .add("contentType", _TEXT)
    .add("header", _HEADERS)
)
RESPONSES_JSON = T.StructType().add("jsonString", _TEXT).add("rsp_ts", _INSTANT).add("rsp_id", _LONG)
WS_FRAMES = (
    T.StructType()
    .add("session_key", _TEXT)
    .add("ts", _INSTANT)
    .add("seq", _LONG)
    .add("kind", _TEXT)
    .add("fin", T.BooleanType())
    .add("payload", _BYTES)
)
VIEW_REQUESTS = (
    T.StructType().add("request_id", _LONG).add("ts", _INSTANT).add("port", T.IntegerType()).add("query", _TEXT)
)


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Batch read of a landed table (parquet, json, orc, ...)."""
    return spark.read.schema(schema).format(fmt).load(path)


def stream_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    event_time: str | None = None,
    delay: str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Streaming read of a folder, with a watermark on the event time.

    The watermark needs a delay: rows later than it are left out of stateful
    results, and the caller says how late a row may be.
    """
    if event_time is not None and delay is None:
        raise ValueError("a watermark needs its delay")
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    if event_time is None:
        return df
    if isinstance(schema[event_time].dataType, T.TimestampNTZType):
        # watermarks need an instant
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df.withWatermark(event_time, delay)


def read_blobs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Binary payload files as octet-stream requests, one per file.

    Spark's file scan leaves out files of length zero; they are added from the
    folder's listing, as empty posts.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    files = files.unionByName(_empty_files(spark, path, glob, files.schema))
    return files.select(
        F.col("modificationTime").alias("ts"),
        F.lit("POST").alias("method"),
        F.col("path").alias("url"),
        F.lit("application/octet-stream").alias("content_type"),
        F.create_map(F.lit("Content-Length"), F.col("length").cast("string")).alias("headers"),
        F.col("content").alias("body"),
    )


def _empty_files(spark: SparkSession, path: str, glob: str, schema: T.StructType) -> DataFrame:
    """Rows for the files of length zero of a folder, which are names only."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = hadoop.Path(place, glob) if system.getFileStatus(place).isDirectory() else place
    found = [s for s in system.globStatus(pattern) or [] if s.isFile() and s.getLen() == 0]
    rows = [
        (s.getPath().toString(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc), 0, b"")
        for s in found
    ]
    return spark.createDataFrame(rows, schema)


def read_fence_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a geofence file as column `value`."""
    return spark.read.text(path)


def write_frame(
    df: DataFrame, path: str, fmt: str = "parquet", checkpoint: str | None = None, mode: str = "append"
) -> StreamingQuery | None:
    """Write a batch frame, or run a streaming frame once over what is there."""
    if not df.isStreaming:
        df.write.format(fmt).mode(mode).save(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder")
    return (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
