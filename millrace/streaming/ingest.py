"""Streams over files: event-time counts, deduplication, and incremental ingest of captures.

A capture file is read once (the checkpoint remembers it); what a batch merges is idempotent, so a batch
that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, time: str = "ts", late: str = "1 day") -> DataFrame:
    """Parquet files as a stream with a watermark; the time column becomes a zoned timestamp, which watermarks need."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return raw.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def windowed_counts(events: DataFrame, time: str, width: str, by: list[str], slide: str | None = None) -> DataFrame:
    return events.groupBy(F.window(time, width, slide or width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def session_counts(events: DataFrame, time: str, gap: str, by: list[str]) -> DataFrame:
    return events.groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def deduplicated(events: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of a key within the watermark."""
    return events.dropDuplicatesWithinWatermark(keys)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of a session for what starts inside; streams keep those that they started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drain(df: DataFrame, checkpoint: str, out: str, mode: str = "append") -> None:
    """Process all that is there now, then stop; append writes Parquet, complete replaces it."""
    if mode == "append":
        query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    else:
        query = df.writeStream.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out)).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(spark: SparkSession, folder: str, checkpoint: str, merge: Callable[[DataFrame, int], None], seconds: int | None = None) -> StreamingQuery:
    """New HTML files as batches of file, html, bytes, captured_at, each handed to merge once it is complete.

    seconds: look for files that often until the query is stopped; None: what is there now.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.html").load(folder)
    meta = F.col("_metadata")
    rows = files.select(meta["file_name"].alias("file"), F.col("value").alias("html"), meta["file_size"].alias("bytes"), meta["file_modification_time"].alias("captured_at"))
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()
