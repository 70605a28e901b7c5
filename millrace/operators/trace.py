"""The trace of appearances: kept per page, summarised per provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import url as U
from millrace.functions.measures import set_fingerprint
from millrace.functions.values import matches_selector
from millrace.operators import dedup, merge, quality

ORDER = ["listing_url", "card_index", "doctor_url"]


def ingest(trace: DataFrame, new: DataFrame) -> DataFrame:
    """The trace with the pages of new replaced; appearances of one page stay duplicates."""
    return merge.replace_groups(trace, new, ["listing_url"])


def page_results(parsed: DataFrame, run_ts: Column, compat: bool = False) -> DataFrame:
    """Listing captures with class, reason, provider count and set hash.

    Only valid and validly empty pages have a hash; compat: every page that isn't unavailable has one.
    """
    said = quality.listing_class(F.col("text"), F.col("title"), F.col("visible"), F.size("doctors"), F.col("advertised_total"))
    urls = F.array_distinct(F.transform("doctors", lambda d: d["doctor_url"]))
    out = parsed.withColumn("_c", said).withColumn("class", F.col("_c.class")).withColumn("reason", F.col("_c.reason")).drop("_c")
    hashed = F.col("class") != "unavailable" if compat else F.col("class").isin("valid", "valid_empty")
    return out.withColumn("n_doctors", F.size(urls)).withColumn("provider_set_hash", F.when(hashed, F.sha2(F.array_join(F.array_sort(urls), "\n"), 256))).withColumn("ingested_at", run_ts)


def coverage(parsed: DataFrame, trace: DataFrame) -> DataFrame:
    """Per page: providers validated on it and those that the trace lacks."""
    expected = parsed.select(U.normalize_url(F.col("url")).alias("listing_url"), F.explode("doctors.doctor_url").alias("doctor_url"))
    return quality.coverage(expected, trace, ["listing_url"], "doctor_url")


def doctors(trace: DataFrame, seen_at: Column) -> DataFrame:
    """First sightings of providers in the trace's order, ready to be merged into the registry."""
    first = dedup.earliest(trace, ["doctor_url"], ["listing_page_no", *ORDER[:2]], ["doctor_name", "listing_url", "listing_specialty_url", "listing_specialty_name"])
    return first.select("doctor_url", "doctor_name", F.col("listing_url").alias("first_seen_page_url"), U.base_location_url(F.col("listing_url")).alias("first_seen_location_url"), F.col("listing_specialty_url").alias("first_seen_specialty_url"), F.col("listing_specialty_name").alias("first_seen_specialty_name"), seen_at.alias("first_seen_at"), seen_at.alias("last_seen_at"))


DOCTOR_RULES = {"doctor_name": "backfill_blank", "first_seen_specialty_url": "backfill_blank", "first_seen_specialty_name": "backfill_blank", "last_seen_at": "overwrite"}


def summary(trace: DataFrame) -> DataFrame:
    """Appearances per provider with first non-blank identifiers, most seen first."""
    first = [F.min_by(c, F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.struct(*ORDER))).alias(c) for c in ("provider_id", "monolith_id", "npi")]
    out = trace.groupBy("doctor_url").agg(F.min_by("doctor_name", F.struct(*ORDER)).alias("doctor_name"), F.count("*").alias("listing_occurrences"), F.count_distinct("listing_url").alias("listing_pages"), *first)
    return out.orderBy(F.desc("listing_occurrences"), F.asc_nulls_last("doctor_name"), "doctor_url")


def observations(trace: DataFrame) -> DataFrame:
    """Provider by specialty; null keys are groups of their own."""
    return trace.groupBy("doctor_url", "listing_specialty_slug").agg(F.min_by("doctor_name", F.struct(*ORDER)).alias("doctor_name"), F.count("*").alias("occurrences"), F.count_distinct("listing_url").alias("pages"), F.min("listing_specialty_name").alias("specialty_name"))


def unique(trace: DataFrame) -> DataFrame:
    return dedup.keep_first(trace, ["doctor_url"], ORDER)


def evidence(trace: DataFrame) -> DataFrame:
    """What a provider's appearances say together; one pre-aggregated row each, joined to profiles once."""
    can = F.col("structured_can_have_appointments")
    composite = F.when(F.col("provider_location_key").contains("|"), F.col("provider_location_key"))
    return trace.groupBy("doctor_url").agg(
        quality.unanimous(can).alias("t_can_have"),
        (F.min(can) != F.max(can)).alias("t_conflict"),
        quality.any_true(F.col("listing_offers_video_visits")).alias("t_video"),
        quality.any_true(F.col("structured_offers_telemedicine")).alias("t_tele"),
        quality.any_true(F.col("structured_has_virtual_locations")).alias("t_virtual"),
        quality.any_true(F.col("structured_accepts_new_patients"), F.col("listing_accepts_new_patients")).alias("t_accepts"),
        quality.unanimous(F.col("structured_has_new_patient_availability")).alias("t_available"),
        F.min_by("state", F.when(F.col("state") != "", F.struct(*ORDER))).alias("t_state"),
        F.min_by("postal_code", F.when(F.col("postal_code") != "", F.struct(*ORDER))).alias("t_zip"),
        # a location's keys are few; they go along as a list of distinct ones
        F.array_sort(F.collect_set(F.struct(F.substring_index(composite, "|", -1).alias("location_id"), composite.alias("key")))).alias("t_keys"),
        F.array_sort(F.collect_set(F.when((F.col("provider_location_key") != "") & (F.col("postal_code") != ""), F.struct("postal_code", *ORDER[:2], F.col("provider_location_key").alias("key"))))).alias("t_zips"),
        F.count("*").alias("t_rows"),
    )


def by_specialty(df: DataFrame, trace: DataFrame, specialties: list[str], key: str = "doctor_url") -> DataFrame:
    """Rows whose provider appears in a listing of one of the specialties; no specialties select all."""
    if not [s for s in specialties if s.strip()]:
        return df
    hits = trace.filter(matches_selector(specialties, F.col("listing_specialty_url"), F.col("listing_specialty_name"), F.col("listing_specialty_slug"))).select(F.col("doctor_url").alias("_d")).distinct()
    return df.join(hits, F.col(key) == F.col("_d"), "left_semi")


def by_membership(df: DataFrame, memberships: DataFrame, specialties: list[str], key: str = "doctor_url") -> DataFrame:
    hits = memberships.filter(F.col("is_active") & matches_selector(specialties, F.col("specialty_slug"))).select(F.col("doctor_url").alias("_d")).distinct()
    return df.join(hits, F.col(key) == F.col("_d"), "left_semi")


def resolve_specialty(specialties: DataFrame, wanted: str) -> str:
    """The slug of the one specialty that a name, slug or URL means: exactly, else as a part. ValueError otherwise."""
    low = wanted.strip().lower()
    for test in (lambda c: F.lower(F.col(c)) == low, lambda c: F.contains(F.lower(F.col(c)), F.lit(low))):
        found = specialties.filter(test("specialty_name") | test("specialty_slug") | test("specialty_url")).select("specialty_slug").distinct().limit(2).collect()
        if len(found) == 1:
            return found[0][0]
        if found:
            raise ValueError(f"{wanted!r} means more than one specialty")
    raise ValueError(f"no specialty {wanted!r}")


def cleanup(pages: DataFrame, captures: DataFrame) -> DataFrame:
    """Captures whose page is traced and done: they may go. Count and sum their bytes for a dry run."""
    done = pages.filter((F.col("trace_status") == "parsed") & F.col("status").isin("saved", "valid_empty")).select(U.safe_slug(F.col("url")).alias("_f"))
    return captures.join(done, F.col("file") == F.col("_f"), "left_semi").select("file", "bytes")


def unparsed(pages: DataFrame, captures: DataFrame, force: bool = False, limit: int | None = None) -> DataFrame:
    """Pages with a capture that are not traced yet."""
    todo = pages if force else pages.filter(F.coalesce("trace_status", F.lit("")) != "parsed")
    out = U.slugged(todo).join(captures.select(F.col("file").alias("_f")), F.col("_slug") == F.col("_f"), "left_semi").drop("_slug").orderBy("url")
    return out if limit is None else out.limit(limit)


def set_hash(trace: DataFrame) -> DataFrame:
    return trace.groupBy("listing_url").agg(set_fingerprint(F.col("doctor_url")).alias("provider_set_hash"))
