"""Streams with state over the driver's tables: the life of pages, and completeness of targets, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.registry import query, read
from millrace.session import scratch
from millrace.streaming import completeness, states
from millrace.streaming.ingest import drain, settings


def _kind() -> Column:
    """Most events are captures that show nothing, so that pages are tried again and again."""
    k = F.col("event_id") % 9
    return F.when(k == 0, "valid").when(k == 1, "valid_empty").when(k == 2, "unavailable").when(k == 3, "restriction_like").otherwise("retry_zero")


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, CASE event_id % 9 WHEN 0 THEN 'saved' WHEN 1 THEN 'valid_empty' WHEN 2 THEN 'unavailable' WHEN 3 THEN 'blocked' END AS settled, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
s AS (SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS event_id, 'pending' AS status, (user_id % 3)::INTEGER AS retry_count FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT e.user_id, e.n, e.event_id, coalesce(settled, CASE WHEN s.retry_count < 2 THEN 'retry_pending' ELSE 'review' END),
    CASE WHEN settled IN ('saved', 'valid_empty') THEN 0 WHEN settled IS NULL AND s.retry_count < 2 THEN s.retry_count + 1 ELSE s.retry_count END FROM s JOIN e ON e.user_id = s.user_id AND e.n = s.n + 1)
SELECT user_id::VARCHAR AS url, event_id, status, retry_count, n AS attempts FROM s WHERE n > 0
""")
def stream_page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every page after each of its captures, kept by a stream that begins with what is known of the pages."""
    e = read(spark, sf_dir, "events")
    pages = e.select(F.col("user_id").cast("string").alias("url"), F.lit("pending").alias("status"), (F.col("user_id") % 3).cast("int").alias("retry_count")).distinct()
    raw = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    captures = raw.select(F.col("user_id").cast("string").alias("url"), "event_id", _kind().alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    out = scratch(spark, "states")
    with settings(spark, states.ROCKSDB):
        drain(states.page_states(captures, pages), f"{out}/checkpoint", f"{out}/rows")
    return spark.read.schema(states.RESULT).parquet(f"{out}/rows").filter("event_id IS NOT NULL").select("url", "event_id", "status", "retry_count", "attempts")


@query("""
SELECT user_id AS target, count(*) AS n_pages, count(*) FILTER (event_type <> 'error' AND event_id % 50 <= 30) AS n_captured, count(*) = count(*) FILTER (event_type <> 'error' AND event_id % 50 <= 30) AS complete,
  count(*) FILTER (event_type <> 'error' AND event_id % 50 > 30) AS n_late FROM events GROUP BY 1
""")
def stream_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets whose pages were all captured within half an hour; captures that came later are counted apart."""
    e, folder = read(spark, sf_dir, "events"), scratch(spark, "asked")
    at = F.col("ts").cast("timestamp")
    asked = e.select(F.col("user_id").alias("target"), F.col("event_id").alias("page"), at.alias("asked_at"))
    came = e.filter("event_type <> 'error'").select(F.col("user_id").alias("target"), F.col("event_id").alias("page"), (at + F.make_dt_interval(mins=(F.col("event_id") % 50).cast("int"))).alias("captured_at"))
    # a last row of either stream, long after the others, lets the watermark pass all of them
    end = e.agg((F.max(at) + F.expr("INTERVAL 10 DAYS")).alias("end")).select(F.lit(None).cast("long").alias("target"), F.lit(None).cast("long").alias("page"), "end")
    for name, rows, time in (("asked", asked, "asked_at"), ("came", came, "captured_at")):
        rows.write.parquet(f"{folder}/{name}/0")
        end.withColumnRenamed("end", time).write.parquet(f"{folder}/{name}/1")
    stream = lambda name, rows: spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}/*")
    drain(completeness.answered(stream("asked", asked), stream("came", came)), f"{folder}/checkpoint", f"{folder}/rows")
    pages = spark.read.parquet(f"{folder}/rows").filter("target IS NOT NULL")
    late = completeness.late(came, pages).groupBy("target").agg(F.count("*").alias("n_late"))
    return completeness.targets(pages).drop("asked_at").join(late, "target", "left").na.fill(0, ["n_late"])
