"""Completeness of targets over streams: pages that are asked for, joined with the captures that answer in time.

Both streams have watermarks, so the state holds what may still find its partner and no more. A page is told as captured
as soon as its capture arrives, as missing once the watermark has passed the time it had. A capture that comes
too late for that, or that nobody asked for, is in no result; `late` finds those for a table of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = ["target", "page"]


def answered(asked: DataFrame, captured: DataFrame, within: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Streams asked (target, page, asked_at) and captured (target, page, captured_at) -> a row for each page asked for.

    captured_at is null where nothing came within the time; delay: how far rows may come out of order.
    """
    a = asked.select(*PAGE, "asked_at").withWatermark("asked_at", delay).alias("a")
    c = captured.select(*PAGE, "captured_at").withWatermark("captured_at", delay).alias("c")
    in_time = (F.col("c.captured_at") >= F.col("a.asked_at")) & (F.col("c.captured_at") <= F.col("a.asked_at") + F.expr(f"INTERVAL {within}"))
    same = (F.col("a.target") == F.col("c.target")) & (F.col("a.page") == F.col("c.page"))
    return a.join(c, same & in_time, "left_outer").select("a.target", "a.page", "asked_at", "captured_at")


def targets(pages: DataFrame) -> DataFrame:
    """What the answered pages say of their targets; a page asked for several times counts as captured once one was."""
    per_page = pages.groupBy(*PAGE).agg(F.max(F.col("captured_at").isNotNull()).alias("here"), F.max("asked_at").alias("asked_at"))
    counts = per_page.groupBy("target").agg(F.count("*").alias("n_pages"), F.count_if("here").alias("n_captured"), F.max("asked_at").alias("asked_at"))
    return counts.withColumn("complete", F.col("n_pages") == F.col("n_captured"))


def late(captured: DataFrame, pages: DataFrame) -> DataFrame:
    """Captures (a table of all that came) that answered nothing."""
    return captured.join(pages.filter("captured_at IS NOT NULL").select(*PAGE, "captured_at").distinct(), [*PAGE, "captured_at"], "left_anti")
