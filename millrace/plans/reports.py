"""Status, performance and runtime reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.measures import per_minute, projected_seconds
from millrace.operators import queue, summaries


def status_snapshot(pages: DataFrame, profiles: DataFrame, trace: DataFrame) -> dict[str, DataFrame]:
    """Statuses of pages by source and of profiles, and totals of the trace."""
    done = F.coalesce("trace_status", F.lit("")) == "parsed"
    return {
        "pages": summaries.status_counts(pages, ["source"]),
        "profiles": summaries.status_counts(profiles, []),
        "trace": trace.agg(F.count("*").alias("rows"), F.count_distinct("doctor_url").alias("providers"), F.count_distinct("listing_url").alias("pages")),
        "parsing": pages.filter("status = 'saved'").agg(F.count_if(done).alias("parsed"), F.count_if(~done).alias("unparsed")),
    }


def sync_status(runs: DataFrame, memberships: DataFrame, providers: DataFrame, limit: int = 10) -> dict[str, DataFrame]:
    """The latest runs and totals of what is active."""
    totals = lambda df: df.agg(F.count_if("is_active").alias("active"), F.count_if(~F.col("is_active")).alias("inactive"))
    return {"runs": runs.orderBy(F.desc("id")).limit(limit), "memberships": totals(memberships), "providers": totals(providers)}


def finalize(runs: DataFrame, locations: DataFrame, profile_jobs: DataFrame) -> DataFrame:
    """Runs with the counts of their targets and jobs, status and whether all that could be collected was."""
    s = F.col("status")
    per = locations.groupBy("run_id").agg(F.count_if(s == "complete").alias("completed"), F.count_if(s == "failed").alias("failed"), F.count_if(s.isin("pending", "running")).alias("pending"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_added", "n_removed")))
    jobs = profile_jobs.groupBy("run_id").agg(F.count_if(s == "failed").alias("jobs_failed"), F.count_if(s == "pending").alias("jobs_pending"))
    joined = runs.join(per, "run_id", "left").join(jobs, "run_id", "left").na.fill(0)
    status = queue.run_status(F.col("completed"), F.col("failed") + F.col("jobs_failed"), F.col("pending") + F.col("jobs_pending"), F.col("error"))
    return joined.withColumn("status", status).withColumn("collection_resolved", (F.col("pending") + F.col("jobs_pending")) == 0)


def performance(events: DataFrame, stages: list[str]) -> DataFrame:
    """Per run: events by status, means and percentiles of the total, mean of each stage where it was timed, throughput."""
    f = F.col
    means = [F.avg(s).alias(f"avg_{s}") for s in stages]
    out = events.groupBy("run").agg(
        F.count("*").alias("n"), F.count_if(f("status") == "saved").alias("n_saved"), F.count_if(f("status") == "failed").alias("n_failed"), F.avg("total_seconds").alias("mean_seconds"),
        F.percentile("total_seconds", 0.5).alias("p50_seconds"), F.percentile("total_seconds", 0.95).alias("p95_seconds"), F.max("total_seconds").alias("longest"), F.max("elapsed").alias("elapsed"), *means,
    )
    return out.withColumn("pages_per_minute", summaries.throughput(f("n"), f("elapsed"), f("longest")))


def combined(latest: DataFrame, stages: list[str]) -> DataFrame:
    """All runners together: summed rate and pages, stage means weighted by pages."""
    weight = F.col("n")
    return latest.agg(F.count("*").alias("runners"), F.sum("n").alias("n"), F.sum("pages_per_minute").alias("pages_per_minute"), *(summaries.weighted_mean(F.col(s), weight).alias(s) for s in stages))


def specialty_runtime(pages: DataFrame, trace: DataFrame, profiles: DataFrame, timings: DataFrame) -> DataFrame:
    """Per specialty: pages and providers by status, rate, projected time, and whether it is resolved or complete."""
    done = F.col("status").isin(*queue.DONE)
    per = pages.groupBy("specialty_slug").agg(F.count("*").alias("n_pages"), F.count_if(~done).alias("open_pages"), F.count_if(F.col("status") == "unavailable").alias("unavailable_pages"))
    seen = trace.select(F.col("listing_specialty_slug").alias("specialty_slug"), "doctor_url").distinct()
    status = seen.join(profiles.select("doctor_url", "status"), "doctor_url", "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    providers = status.groupBy("specialty_slug").agg(F.count_distinct("doctor_url").alias("providers"), F.count_if(F.col("status") == "saved").alias("saved_profiles"))
    timed = timings.groupBy("specialty_slug").agg(F.sum("seconds").alias("seconds"), F.sum("processed").alias("processed"))
    rate = per_minute(F.col("processed"), F.col("seconds"))
    out = per.join(providers, "specialty_slug", "left").join(timed, "specialty_slug", "left").na.fill(0, ["providers", "saved_profiles"])
    resolved = F.col("open_pages") == 0
    return out.withColumn("rate", rate).withColumn("projected_seconds", projected_seconds(F.col("open_pages"), F.col("rate"))).withColumn("resolved", resolved).withColumn("complete", resolved & (F.col("unavailable_pages") == 0))


def progress(before: DataFrame, now: DataFrame) -> DataFrame:
    """How the number of each status moved since a baseline."""
    a, b = before.select("status", F.col("n").alias("n0")), now.select("status", F.col("n").alias("n1"))
    return a.join(b, "status", "full").na.fill(0).select("status", (F.col("n1") - F.col("n0")).alias("delta"))


def reconcile(runs: DataFrame, locations: DataFrame) -> DataFrame:
    """What interrupted runs really reached; nothing is declared complete here."""
    per = locations.groupBy("run_id").agg(F.count_if(F.col("status") == "complete").alias("done"), F.count("*").alias("targets"))
    open_ = runs.filter(F.col("status").isin("running", "interrupted", "failed", "partial"))
    return open_.join(per, "run_id", "left").na.fill(0).withColumn("proposed", F.when(F.col("done") > 0, "partial").otherwise("failed"))
