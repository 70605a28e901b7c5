"""Upkeep of queues and pages: provenance, audits, resumption, imports. Each returns what would change; callers merge it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import url as U
from millrace.functions.values import matches_selector, text
from millrace.operators import dedup, queue
from millrace.operators.merge import union_priority

PROVENANCE = ["state_group", "location", "specialty_url", "specialty_name", "specialty_slug"]


def ensure_pages(pages: DataFrame, urls: DataFrame, seen_at: Column) -> DataFrame:
    """Rows for URLs that aren't pages yet; each inherits where it belongs from the first page of its base."""
    address = F.col("url")
    new = urls.select(U.normalize_url(address).alias("url")).distinct().join(pages.select("url"), "url", "left_anti")
    first = dedup.earliest(pages, ["base_location_url"], ["page_no", "url"], PROVENANCE)
    fresh = new.select("url", U.base_location_url(address).alias("base_location_url"), U.page_number(address).alias("page_no"))
    return fresh.join(first, "base_location_url", "left").na.fill("", PROVENANCE).withColumn("source", F.when(F.col("page_no") == 1, "seed").otherwise("pagination")).withColumn("status", F.lit("pending")).withColumn("discovered_at", seen_at)


def sources(trace: DataFrame, seen_at: Column) -> DataFrame:
    """Provider by page, from the trace."""
    return trace.groupBy("doctor_url", F.col("listing_url").alias("page_url")).agg(F.min("listing_specialty_url").alias("specialty_url"), F.min("listing_specialty_name").alias("specialty_name")).select("*", U.base_location_url(F.col("page_url")).alias("location_url"), seen_at.alias("seen_at"))


def mark_parsed(pages: DataFrame, trace: DataFrame, captures: DataFrame) -> DataFrame:
    """Pages whose trace is there and whose capture is gone count as parsed."""
    traced = trace.select(F.col("listing_url").alias("_t")).distinct()
    held = captures.select(F.col("file").alias("_f")).distinct()
    out = U.slugged(pages).join(traced, F.col("url") == F.col("_t"), "left").join(held, F.col("_slug") == F.col("_f"), "left")
    gone = F.col("_t").isNotNull() & F.col("_f").isNull() & (text(F.col("trace_status")) != "parsed")
    return out.withColumn("trace_status", F.when(gone, "parsed").otherwise(F.col("trace_status"))).drop("_t", "_f", "_slug")


def audit_empty(pages: DataFrame, results: DataFrame, captures: DataFrame) -> DataFrame:
    """Saved pages without providers: url, finding and next status.

    results: url, class of captures read again. A page without a capture is retried until its retries are used up.
    """
    held = captures.select(F.col("file").alias("_f")).distinct()
    doubtful = U.slugged(pages.filter("status = 'saved'")).join(results.select("url", F.col("class").alias("_class")), "url", "left").join(held, F.col("_slug") == F.col("_f"), "left")
    kind = F.when(F.col("_f").isNull(), "retry_zero").otherwise(F.col("_class"))
    said = queue.page_transition(kind, F.coalesce("retry_count", F.lit(0)))
    finding = F.when(F.col("_f").isNull() & (F.coalesce("retry_count", F.lit(0)) >= queue.MAX_RETRIES), "exhausted").when(F.col("_f").isNull(), "missing_capture").otherwise(F.col("_class"))
    return doubtful.filter(F.col("_f").isNull() | (F.col("_class") != "valid")).select("url", finding.alias("finding"), said["status"].alias("status"), said["retry_count"].alias("retry_count"))


def normalize_jobs(jobs: DataFrame, profiles: DataFrame, canonical: DataFrame, recheck: int = 0) -> DataFrame:
    """Jobs before work: what is unavailable stays so, what is stored is done, what failed is tried again.

    recheck: so many unavailable profiles, those longest unchecked, are tried once more.
    """
    gone = profiles.filter("status = 'unavailable'").select(F.col("doctor_url").alias("_g"), "saved_at")
    again = gone.orderBy(F.asc_nulls_first("saved_at"), "_g").limit(recheck).select(F.col("_g").alias("_a"))
    stored = canonical.filter(text(F.col("profile_sha256")) != "").select(F.col("doctor_url").alias("_s"))
    out = jobs.join(gone.drop("saved_at"), F.col("doctor_url") == F.col("_g"), "left").join(again, F.col("doctor_url") == F.col("_a"), "left").join(stored, F.col("doctor_url") == F.col("_s"), "left")
    status = (
        F.when(F.col("_a").isNotNull(), "pending")
        .when(F.col("_g").isNotNull(), "unavailable")
        .when(F.col("_s").isNotNull() & (F.col("reason").isin("missing_profile", "unparsed_profile")), "done")
        .when(F.col("status") == "failed", "pending")
        .otherwise(F.col("status"))
    )
    return out.withColumn("status", status).drop("_g", "_a", "_s")


def remaining_targets(targets: DataFrame, run_locations: DataFrame, run_id: int) -> DataFrame:
    """Targets that a run has not completed; ValueError if a newer run exists."""
    newest = run_locations.agg(F.max("run_id")).first()[0]
    if newest is not None and newest > run_id:
        raise ValueError(f"run {newest} is newer than {run_id}")
    done = run_locations.filter((F.col("run_id") == run_id) & (F.col("status") == "complete")).select("specialty_slug", "location_url")
    return targets.join(done, ["specialty_slug", "location_url"], "left_anti")


def open_run(run_locations: DataFrame, jobs: DataFrame) -> int | None:
    """The latest run with jobs that are still open."""
    waiting = jobs.filter("status IN ('pending', 'failed')").select("run_id").distinct()
    return run_locations.select("run_id").distinct().join(waiting, "run_id", "left_semi").agg(F.max("run_id")).first()[0]


def select_targets(declared: DataFrame, snapshots: DataFrame, specialties: list[str], from_snapshots: bool = False, limit: int | None = None) -> DataFrame:
    """Targets to work on, each once, in order: all declared ones, or those that have a snapshot."""
    base = declared
    if from_snapshots:
        base = declared.join(snapshots.select("location_url").distinct(), "location_url", "left_semi")
    keys = ["location_url"] if from_snapshots else ["specialty_slug", "location_url"]
    out = dedup.keep_first(base.filter(matches_selector(specialties, F.col("specialty_slug"), F.col("specialty_name"))), keys, ["specialty_slug", "location_url"]).orderBy("specialty_slug", "location_url")
    return out if limit is None else out.limit(limit)


def local_import(memberships: DataFrame, profiles: DataFrame, canonical: DataFrame, files: DataFrame) -> DataFrame:
    """Active providers without stored details, each with what a local import can do: import, unavailable, not_saved or missing_file.

    files: doctor_url, file, as profile_captures finds them.
    """
    lacking = memberships.filter("is_active").select("doctor_url").distinct().join(canonical.filter(text(F.col("profile_sha256")) != "").select("doctor_url"), "doctor_url", "left_anti")
    out = lacking.join(profiles.select("doctor_url", F.col("status").alias("_p")), "doctor_url", "left").join(files.select("doctor_url", "file"), "doctor_url", "left")
    kind = F.when(F.col("_p") == "unavailable", "unavailable").when(F.coalesce("_p", F.lit("")) != "saved", "not_saved").when(F.col("file").isNull(), "missing_file").otherwise("import")
    return out.select("doctor_url", "file", kind.alias("outcome"))


def repaired_redirects(profiles: DataFrame, redirects: DataFrame) -> DataFrame:
    """Profiles that wait although their capture came under another URL are saved under that file."""
    found = redirects.select(F.col("requested").alias("_r"), F.col("file").alias("_f"))
    out = profiles.join(found, F.col("doctor_url") == F.col("_r"), "left")
    hit = F.col("_f").isNotNull() & F.col("status").isin("pending", "opening", "timeout")
    return out.withColumn("file", F.when(hit, F.col("_f")).otherwise(F.col("file"))).withColumn("status", F.when(hit, "saved").otherwise(F.col("status"))).drop("_r", "_f")


def repaired_challenges(profiles: DataFrame, rejected: DataFrame) -> DataFrame:
    """Saved profiles whose capture proved to be a verification or missing page: pending again, or unavailable for good."""
    bad = rejected.select(F.col("url").alias("_u"), "reason")
    out = profiles.join(bad, F.col("doctor_url") == F.col("_u"), "left")
    status = F.when(F.col("reason").isNull(), F.col("status")).when(F.col("reason").contains("404") | F.col("reason").contains("not found"), "unavailable").otherwise("pending")
    return out.withColumn("status", status).withColumn("last_error", F.coalesce("reason", "last_error")).drop("_u", "reason")
