"""Work queues as set operations: statuses are columns, transitions are expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import is_stale

MAX_RETRIES = 2
DONE = ("saved", "valid_empty", "unavailable", "retired")
RESETTABLE = ("opening", "timeout", "blocked", "review", "unavailable")


def page_transition(kind: Column, retries: Column, max_retries: int = MAX_RETRIES) -> Column:
    """(status, retry_count) of a page after a capture of a class."""
    pair = lambda s, n: F.struct(F.lit(s).alias("status"), n.cast("int").alias("retry_count"))
    return (
        F.when(kind == "valid", pair("saved", F.lit(0)))
        .when(kind == "valid_empty", pair("valid_empty", F.lit(0)))
        .when(kind == "unavailable", pair("unavailable", retries))
        .when(kind == "restriction_like", pair("blocked", retries))
        .when(kind == "timeout", pair("timeout", retries))
        .when(retries < max_retries, pair("retry_pending", retries + 1))
        .otherwise(pair("review", retries))
    )


def activate_retries(pages: DataFrame, chosen: Column | None = None) -> DataFrame:
    on = (F.col("status") == "retry_pending") & (F.lit(True) if chosen is None else chosen)
    return pages.withColumn("status", F.when(on, "pending").otherwise(F.col("status")))


def assign(jobs: DataFrame, order: list[str | Column], workers: int) -> DataFrame:
    """Pending jobs with `worker`: every job to one, in turn. Numbers are dealt within hash buckets, so no task sees all jobs."""
    bucket = F.pmod(F.xxhash64(*(c for c in jobs.columns)), F.lit(64))
    rn = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return jobs.filter("status = 'pending'").withColumn("_bucket", bucket).withColumn("worker", F.pmod(rn - 1 + F.col("_bucket"), F.lit(workers)).cast("int")).drop("_bucket")


def recover_stale(jobs: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Jobs opened too long ago are pending again, without a claim."""
    stale = F.coalesce((F.col("status") == "opening") & is_stale(F.col("claimed_at"), now, minutes), F.lit(False))
    return jobs.withColumn("status", F.when(stale, "pending").otherwise(F.col("status"))).withColumn("claimed_at", F.when(stale, F.lit(None)).otherwise(F.col("claimed_at")))


def reset(jobs: DataFrame, statuses: list[str]) -> DataFrame:
    if bad := set(statuses) - set(RESETTABLE):
        raise ValueError(f"cannot reset {sorted(bad)}")
    return jobs.withColumn("status", F.when(F.col("status").isin(*statuses), "pending").otherwise(F.col("status")))


def phase(pages: DataFrame) -> DataFrame:
    """What to work on next: seed pages, pages that need attention, pagination, or nothing."""
    open_seed = F.count_if((F.col("source") == "seed") & F.col("status").isin("pending", "opening"))
    attention = F.count_if(F.col("status").isin("timeout", "blocked", "review", "retry_pending"))
    rest = F.count_if(F.col("status").isin("pending", "opening"))
    return pages.agg(F.when(open_seed > 0, "seed").when(attention > 0, "attention").when(rest > 0, "pagination").otherwise("complete").alias("phase"))


def profile_reason(known: Column, parsed: Column, reactivated: Column, unavailable: Column, age: Column, refresh_days: int) -> Column:
    """Why a profile should be captured, else null. refresh_days 0: always."""
    return (
        F.when(unavailable, F.lit(None))
        .when(~known, "missing_profile")
        .when(~parsed, "unparsed_profile")
        .when(reactivated, "reactivated")
        .when(age >= refresh_days, "stale_profile")
    )


def attempt(status: Column, attempts: Column, ok: Column, max_attempts: int = MAX_RETRIES) -> Column:
    """(status, attempts) of a profile job after an attempt."""
    n = attempts + 1
    return F.struct(F.when(ok, "done").when(n <= max_attempts, "pending").otherwise("failed").alias("status"), n.alias("attempts"))


def run_status(completed: Column, failed: Column, pending: Column, error: Column) -> Column:
    """complete, partial or failed; nothing completed and something wrong is failed."""
    return F.when((completed == 0) & ((failed > 0) | (F.coalesce(error, F.lit("")) != "")), "failed").when((failed > 0) | (pending > 0), "partial").otherwise("complete")


def rounds(jobs: DataFrame, target: list[str], order: list[str | Column], after: tuple | None = None) -> DataFrame:
    """Pending jobs with `round`: each target's first job is in round 1, its second in round 2, so no target waits for a larger one.

    Inside a round targets follow each other; `later` is true for those up to `after`, the target served last, whose turn
    comes after the others'. Jobs in the order (round, later, target) take up a schedule where it stopped.
    """
    place = F.row_number().over(Window.partitionBy(*target).orderBy(*order))
    later = F.lit(False) if after is None else F.struct(*target) <= F.struct(*(F.lit(v).cast(jobs.schema[t].dataType).alias(t) for t, v in zip(target, after)))
    return jobs.filter("status = 'pending'").withColumn("round", place).withColumn("later", later)


def next_turns(jobs: DataFrame, target: list[str], order: list[str | Column], n: int, after: tuple | None = None) -> tuple[DataFrame, tuple | None]:
    """The next n jobs of a fair schedule, and the target served last, to be kept as the next call's `after`."""
    turn = ["round", "later", *target]
    chosen = rounds(jobs, target, order, after).orderBy(*turn).limit(n)
    last = chosen.orderBy(*(F.desc(c) for c in turn)).limit(1).select(*target).first()
    return chosen, after if last is None else tuple(last)


def reconcile(pages: DataFrame, captures: DataFrame, slug: str) -> DataFrame:
    """Pages whose file has turned up count as saved."""
    have = captures.select(F.col("file").alias("_f")).distinct()
    return pages.join(have, F.col(slug) == F.col("_f"), "left").withColumn("status", F.when(F.col("_f").isNotNull() & F.col("status").isin("pending", "opening"), "saved").otherwise(F.col("status"))).drop("_f")
