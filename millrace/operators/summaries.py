"""Counts, summaries and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import per_minute, projected_seconds

PAGE_STATUSES = ("saved", "valid_empty", "unavailable", "pending", "retry_pending", "review", "blocked", "timeout")


def occurrence_summary(trace: DataFrame, key: str, page: str, order: list[str], firsts: list[str]) -> DataFrame:
    """Per key: appearances, distinct pages, and each column's first non-blank value in the trace's order."""
    first = [F.min_by(c, F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.struct(*order))).alias(c) for c in firsts]
    return trace.groupBy(key).agg(F.count("*").alias("n_occurrences"), F.count_distinct(page).alias("n_pages"), *first)


def status_counts(df: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    return df.groupBy(*by, status).agg(F.count("*").alias("n"))


def status_columns(df: DataFrame, by: list[str], statuses: list[str], status: str = "status") -> DataFrame:
    """A column for each status; one pass, no pivot shuffle."""
    return df.groupBy(*by).agg(*(F.count_if(F.col(status) == s).alias(f"n_{s}") for s in statuses))


def location_summary(pages: DataFrame, providers: DataFrame) -> DataFrame:
    """Pages by base URL with their statuses, the row of the largest advertised total standing for the rest, and providers."""
    by = ["specialty_url", "base_location_url"]
    named = lambda c: F.coalesce(F.max_by(c, F.struct("advertised_total", "url")), F.min_by(c, "url")).alias(c)
    counts = [F.count_if(F.col("status") == s).alias(f"{s}_pages") for s in PAGE_STATUSES]
    left = pages.groupBy(*by).agg(F.max("advertised_total").alias("advertised_total"), named("state_group"), named("location"), F.count("*").alias("n_pages"), *counts)
    right = providers.groupBy("base_location_url").agg(F.count_distinct("doctor_url").alias("n_providers"))
    return left.join(right, "base_location_url", "left").na.fill(0, ["n_providers"])


def column_qa(df: DataFrame, columns: list[str], empty_list_counts: bool = False) -> DataFrame:
    """A row a column: non-empty values and their per cent, in one pass. empty_list_counts: `[]` is a value."""
    def filled(c: str) -> Column:
        t = F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
        return (t != "") if empty_list_counts else (t != "") & (t != "[]")

    one = df.agg(F.count("*").alias("_n"), *(F.count_if(filled(c)).alias(c) for c in columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in columns)))
    share = F.when(F.col("_n") > 0, F.bround(F.col("m.n_filled") * 100.0 / F.col("_n"), 1)).otherwise(0.0)
    return one.select("_n", pairs.alias("m")).select("m.column_name", "m.n_filled", share.alias("pct_filled"))


def _ranked(events: DataFrame, by: list[str], value: str) -> DataFrame:
    """Each distinct value of a group, how often it occurs, and the running count up to it.

    Values are counted before they are ordered, and the running count streams, so no group is gathered.
    """
    counts = events.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    up = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)
    return counts.withColumn("_top", F.sum(known).over(up)).withColumn("_n", F.sum(known).over(Window.partitionBy(*by)))


def _value_at(rank: Column) -> Column:
    """Aggregate over ranked values: the value of a rank, counted from 0."""
    return F.min(F.when((F.col("_top") > rank) & F.col("_v").isNotNull(), F.col("_v")))


def _linear(p: float) -> Column:
    """Aggregate: interpolates between ranks."""
    place = (F.col("_n") - 1) * F.lit(p)
    low, high = _value_at(F.floor(place)), _value_at(F.ceil(place))
    return low + (high - low) * F.max(place - F.floor(place))


def _mean() -> Column:
    return F.sum(F.col("_v") * F.col("_c")) / F.max("_n")


def latency_summary(events: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean and percentiles between ranks."""
    return _ranked(events, by, value).groupBy(*by).agg(F.sum("_c").alias("n"), _mean().alias("mean"), _linear(0.5).alias("p50"), _linear(0.95).alias("p95"))


def timing_summary(events: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and nearest-rank 95th percentile: the value of rank (n - 1) 0.95, rounded half to even."""
    return _ranked(events, by, value).groupBy(*by).agg(_mean().alias("mean"), _value_at(F.bround((F.col("_n") - 1) * F.lit(0.95))).alias("p95_nearest"))


def throughput(n: Column, elapsed: Column, longest: Column) -> Column:
    return per_minute(n, F.greatest(elapsed, longest))


def median_eta(runs: DataFrame, order: str, rate: str, left: int, last: int = 5) -> DataFrame:
    """Median rate of the last runs with one, and the time that what is left takes at it."""
    recent = runs.filter(F.col(rate) > 0).orderBy(F.desc(order)).limit(last)
    return recent.agg(F.count("*").alias("n_runs"), F.median(rate).alias("rate")).withColumn("eta_seconds", projected_seconds(F.lit(left), F.col("rate")))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: weights below 1 count as 1; rows without a value don't count."""
    w = F.when(value.isNotNull(), F.greatest(F.lit(1), weight))
    return F.sum(value * w) / F.sum(w)


def runtime_projection(runs: DataFrame, by: list[str], seconds: str, done: str, left: Column) -> DataFrame:
    out = runs.groupBy(*by).agg(F.sum(seconds).alias("seconds"), F.sum(done).alias("done"))
    rate = per_minute(F.col("done"), F.col("seconds"))
    return out.withColumn("rate", rate).withColumn("projected_seconds", projected_seconds(left, F.col("rate")))


def unique_match(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, keep: str) -> DataFrame:
    """left with the row of right that has its key, where there is exactly one; a pattern match turned equi-join."""
    candidates = right.withColumn("_k", right_key)
    alone = candidates.groupBy("_k").agg(F.count("*").alias("_n"), F.first(keep).alias(f"matched_{keep}")).filter("_n = 1").drop("_n")
    return left.withColumn("_lk", left_key).join(alone, F.col("_lk") == F.col("_k")).drop("_lk", "_k")


def last_runs(runs: DataFrame, order: str, n: int, by: list[str]) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
    return runs.withColumn("rn", rn).filter(F.col("rn") <= n)
