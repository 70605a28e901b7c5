"""From profile captures and the trace to provider-location rows and the datasets derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schema
from millrace.functions import values as V
from millrace.functions import variants as X
from millrace.functions.measures import row_fingerprint
from millrace.operators import dedup, quality, trace


def _telemedicine() -> Column:
    virtual = F.exists("locations", lambda x: F.coalesce(x["is_virtual_location"], F.lit(False)))
    visits = F.exists("locations", lambda x: ~F.lower(F.trim(x["virtual_visit_type"])).isin("", "none"))
    return quality.telemedicine(
        {
            "profile.offersTelemedicine=true": F.col("p.offers_telemedicine"),
            "profile.hasVirtualLocations=true": F.col("p.has_virtual_locations"),
            "profile.location.isVirtual=true": virtual,
            "profile.location.virtualVisitType": visits,
            "listing.Also offers video visits": F.col("t_video"),
            "listing.provider.offersTelemedicine=true": F.col("t_tele"),
            "listing.provider.hasVirtualLocations=true": F.col("t_virtual"),
        },
        {"profile.offersTelemedicine=false": ~F.col("p.offers_telemedicine"), "profile.hasVirtualLocations=false": ~F.col("p.has_virtual_locations")},
    )


def provider_rows(profiles: DataFrame, appearances: DataFrame, source_zip: str = "office") -> DataFrame:
    """The 35 columns, one row a provider and location, with diagnostics and the location's place `loc_seq`.

    profiles: doctor_url and `profile` as parsed. Evidence is aggregated per provider before the join, and
    unknown stays unknown: no flag becomes false because nothing was said.
    """
    if source_zip not in ("office", "blank"):
        raise ValueError("source_zip is 'office' or 'blank'")
    known = profiles.filter("profile IS NOT NULL").select("doctor_url", F.col("profile").alias("p"))
    joined = known.join(trace.evidence(appearances), "doctor_url", "left")
    none = F.lit(None)
    blank = F.array(F.struct(*(none.cast(f.dataType).alias(f.name) if f.name.startswith(("is_", "can_", "has_")) else (F.coalesce("t_state", F.lit("")) if f.name == "state" else F.coalesce("t_zip", F.lit("")) if f.name == "postal_code" else F.lit("")).alias(f.name) for f in schema.PROFILE["locations"].dataType.elementType.fields)))
    joined = joined.withColumn("locations", F.when(F.size("p.locations") > 0, F.col("p.locations")).otherwise(blank))
    said = quality.appointments(F.col("t_can_have"), F.coalesce("t_conflict", F.lit(False)), F.col("p.is_bookable"), F.col("p.is_preview"), F.col("p.marketplace_enabled"))
    joined = joined.withColumn("_can", said).withColumn("_tele", _telemedicine()).withColumn("_name", V.split_name(F.col("p.full_name")))

    def key(x: Column) -> Column:
        by_id = F.get(F.filter("t_keys", lambda k: k["location_id"] == x["location_id"]), F.lit(0))["key"]
        by_zip = F.get(F.filter("t_zips", lambda k: k["postal_code"] == x["postal_code"]), F.lit(0))["key"]
        own = F.when((F.col("p.provider_id") != "") & (x["location_id"] != ""), F.concat(F.col("p.provider_id"), F.lit("|"), x["location_id"]))
        return V.first_nonempty(x["profile_key"], F.when(x["location_id"] != "", by_id), F.when(x["postal_code"] != "", by_zip), own)

    fields = [f.name for f in schema.LOCATION.fields]
    placed = F.transform("locations", lambda x: F.struct(*(x[n].alias(n) for n in fields), key(x).alias("provider_location_key")))
    rows = joined.withColumn("locations", placed).select("*", F.posexplode("locations").alias("loc_seq", "l"))
    name = lambda n: V.first_nonempty(F.col(f"p.{n}"), F.col(f"_name.{n}"))
    zipped = source_zip == "office"
    out = {
        **{c: F.col(f"l.{c}") for c in ("state", "address_line_1", "address_line_2", "city", "postal_code", "phone", "location_id", "location_name", "is_virtual_location", "provider_location_key")},
        **{c: F.col(f"p.{c}") for c in ("full_name", "specialty_name", "npi", "provider_id", "monolith_id", "average_rating", "review_count", "profile_url", "only_sees_children", "hospital_affiliations", "bio")},
        **{c: name(c) for c in ("first_name", "last_name", "prenominal", "postnominal")},
        "practice_name": V.first_nonempty(F.col("l.practice_name"), F.col("p.practice_name")),
        "accepts_new_patients": F.coalesce("p.accepts_new_patients", "t_accepts"),
        "offers_telemedicine": F.col("_tele.value"),
        "num_locations": F.size("locations"),
        "can_have_appointments": F.coalesce("l.can_have_appointments", "_can.value"),
        "has_new_patient_availability": F.coalesce("l.has_new_patient_availability", "p.has_new_patient_availability", "t_available"),
        "photo_url": V.photo_url(F.col("p.photo_url")),
        "locations": F.col("locations"),
        "source_zip": F.col("l.postal_code") if zipped else F.lit(""),
        "source_zip_state": F.col("l.state") if zipped else F.lit(""),
    }
    diagnostics = [F.col("_tele.evidence").alias("telemedicine_evidence"), F.col("_can.source").alias("can_have_appointments_source"), F.coalesce("t_rows", F.lit(0)).alias("trace_occurrences")]
    return rows.select("doctor_url", "loc_seq", *(out[c].alias(c) for c in schema.FINAL_COLUMNS), *diagnostics)


def final_rows(rows: DataFrame) -> DataFrame:
    """One row a location of a provider: by its location key, else by its address."""
    order = ["full_name", "doctor_url", "loc_seq"]
    parts = [F.col(c) for c in ("provider_id", "npi", "profile_url", "location_id", "address_line_1", "city", "state", "postal_code")]
    key = dedup.location_key(F.col("provider_location_key"), *parts, tie=F.concat_ws("#", "doctor_url", F.col("loc_seq").cast("string")))
    return dedup.keep_first(rows.withColumn("_key", key), ["_key"], order).drop("_key")


def guard(pages: DataFrame, profiles: DataFrame, allow_partial: bool = False) -> None:
    """ValueError while pages or profiles are still open."""
    open_ = lambda df: df.filter(F.col("status").isin("pending", "opening", "timeout", "blocked")).count()
    counts = {"pages": open_(pages), "profiles": open_(profiles)}
    if not allow_partial and any(counts.values()):
        raise ValueError(f"not complete: {counts}")


def derive(final: DataFrame) -> dict[str, DataFrame]:
    """Unique providers, virtual, physical and unknown locations."""
    who = dedup.identity(F.col("provider_id"), F.col("npi"), F.col("profile_url"))
    rows = final.withColumn("_who", who).withColumn("_has", F.size("locations") > 0)
    unique = dedup.keep_first(rows, ["_who"], [F.desc("_has"), "full_name", "profile_url", "loc_seq"] if "loc_seq" in final.columns else [F.desc("_has"), "full_name", "profile_url"])
    return {
        "unique_providers": unique.select(*schema.UNIQUE_COLUMNS),
        "virtual_locations": final.filter("is_virtual_location").select(*schema.FINAL_COLUMNS),
        "physical_locations": final.filter("NOT is_virtual_location").select(*schema.FINAL_COLUMNS),
        "unknown_locations": final.filter("is_virtual_location IS NULL").select(*schema.FINAL_COLUMNS),
    }


def zip_inputs(df: DataFrame) -> dict[str, DataFrame]:
    """ZIP codes by state: pairs, codes that several states claim, codes per state, and ragged columns."""
    pairs = df.select(V.normalize_state(F.col("state")).alias("state"), V.normalize_zip(F.col("postal_code")).alias("zip")).dropna().distinct()
    states = F.array_sort(F.collect_set("state"))
    conflicts = pairs.groupBy("zip").agg(F.array_join(states, ",").alias("states"), F.size(states).alias("n_states")).filter("n_states > 1")
    names = [r[0] for r in pairs.select("state").distinct().orderBy("state").collect()]
    wide = dedup.ragged_pivot(pairs, "state", "zip", names).orderBy("rn").drop("rn")
    return {"long": pairs.orderBy("state", "zip"), "conflicts": conflicts, "wide": wide, "counts": pairs.groupBy("state").agg(F.count_distinct("zip").alias("n_zips"))}


def typed(df: DataFrame) -> DataFrame:
    """Rows of a published CSV file, all text, with the published types; columns that it lacks are null or blank."""
    def cell(f) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType) if f.dataType != T.StringType() else F.lit("")
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.coalesce(F.from_json(F.nullif(F.trim(c), F.lit("")), f.dataType), F.array().cast(f.dataType))
        if isinstance(f.dataType, T.BooleanType):
            return V.tri_bool(c)
        return F.expr(f"try_cast(`{f.name}` AS int)") if isinstance(f.dataType, T.IntegerType) else V.text(c)

    return df.select(*(c for c in df.columns if c not in schema.FINAL.names), *(cell(f).alias(f.name) for f in schema.FINAL.fields))


def payloads(rows: DataFrame, order: str = "loc_seq") -> DataFrame:
    """doctor_url and `profile_data`: a provider's rows as one JSON text, in order. A provider has few rows."""
    row = F.struct(F.col(order).alias("_order"), *schema.FINAL_COLUMNS)
    data = F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(*(r[c].alias(c) for c in schema.FINAL_COLUMNS)))
    return rows.groupBy("doctor_url").agg(F.to_json(data, {"ignoreNullFields": "false"}).alias("profile_data"))


def from_payloads(stored: DataFrame) -> DataFrame:
    """Stored profiles as published rows: doctor_url, loc_seq, the 35 columns and `error`.

    A payload is an array of rows or one row, as JSON text or such a text quoted once more. A row that has a location of its own passes; one that only nests `locations` gives a row for each. What can't
    be used is a row with an error: unreadable, empty, unnamed or without a location.
    """
    held = X.payload(F.col("profile_data"))
    array = F.when(X.shape(held) == "object", F.concat(F.lit("["), F.to_json(held), F.lit("]"))).otherwise(F.to_json(held))
    parsed = stored.select("doctor_url", "profile_data", F.from_json(array, T.ArrayType(schema.FINAL)).alias("rows"))
    flat = parsed.select("doctor_url", F.col("rows").isNull().alias("_bad"), F.posexplode_outer("rows").alias("_seq", "r"))
    own = F.exists(F.array(*(V.text(F.col(f"r.{c}")) for c in ("location_id", "address_line_1", "city", "postal_code"))), lambda x: x != "")
    inner = F.when(~F.coalesce(own, F.lit(False)) & (F.size("r.locations") > 0), F.col("r.locations"))
    nested = flat.withColumn("_own", own).select("*", F.posexplode_outer(inner).alias("_place", "l"))
    level = set(schema.LOCATION_LEVEL) & set(schema.LOCATION.names + ["provider_location_key"])
    column = lambda c: F.when(F.col("l").isNotNull(), F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")) if c in level else F.col(f"r.{c}")
    error = (
        F.when(F.col("_bad"), "unreadable profile")
        .when(F.col("r").isNull(), "empty profile")
        .when(F.trim(V.text(F.col("r.full_name"))) == "", "unnamed provider")
        .when(~F.coalesce("_own", F.lit(False)) & F.col("l").isNull(), "no locations")
    )
    out = nested.select("doctor_url", (F.coalesce("_seq", F.lit(0)) * 1000 + F.coalesce("_place", F.lit(0))).alias("loc_seq"), *(column(c).alias(c) for c in schema.FINAL_COLUMNS), error.alias("error"))
    return out.withColumn("loc_seq", F.row_number().over(Window.partitionBy("doctor_url").orderBy("loc_seq")) - 1)


def reviewed(cohort: DataFrame, overrides_: DataFrame) -> DataFrame:
    """A cohort with reviewed aliases replaced by the provider that stands for them. overrides_: alias, doctor_url."""
    instead = overrides_.select(F.col("alias").alias("_a"), F.col("doctor_url").alias("_d"))
    return cohort.join(instead, F.col("doctor_url") == F.col("_a"), "left").withColumn("doctor_url", F.coalesce("_d", "doctor_url")).drop("_a", "_d").distinct()


def delivery(cohort: DataFrame, rows: DataFrame, open_pages: DataFrame, review: DataFrame) -> dict[str, DataFrame]:
    """Per specialty: rows without duplicates, conflicting duplicates counted, and whether all is ready.

    cohort: specialty_slug, doctor_url. rows: provider_rows. open_pages, review: specialty_slug and doctor or page keys.
    """
    content = row_fingerprint(*(c for c in schema.FINAL_COLUMNS))
    mine = cohort.distinct().join(rows, "doctor_url")
    key = dedup.location_key(F.col("provider_location_key"), *(F.col(c) for c in ("profile_url", "location_id", "address_line_1", "city", "state", "postal_code")), tie=F.concat_ws("#", "doctor_url", F.col("loc_seq").cast("string")))
    kept = dedup.conflicts(mine.withColumn("_key", key), ["specialty_slug", "_key"], ["full_name", "doctor_url", "loc_seq"], content).drop("_key")
    counts = kept.groupBy("specialty_slug").agg(F.count_distinct("doctor_url").alias("n_profiles"), F.sum("n_conflicts").alias("n_conflicts"))
    waiting = open_pages.groupBy("specialty_slug").agg(F.count("*").alias("n_open_pages"))
    doubtful = review.groupBy("specialty_slug").agg(F.count("*").alias("n_review"))
    summary = cohort.select("specialty_slug").distinct().join(counts, "specialty_slug", "left").join(waiting, "specialty_slug", "left").join(doubtful, "specialty_slug", "left").na.fill(0)
    ready = quality.delivery_gate(F.col("n_profiles"), F.col("n_open_pages"), F.col("n_conflicts"), F.col("n_review"))
    return {"rows": kept, "summary": summary.withColumn("ready", ready)}


def overrides(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Of each reviewed group of URLs the newest profile, if all agree in provider, NPI and offices.

    aliases: group_id, doctor_url. rows: doctor_url, provider_id, npi, saved_at and the office keys of each.
    """
    joined = aliases.join(rows, "doctor_url")
    per = joined.groupBy("group_id").agg(
        F.max_by("doctor_url", F.struct("saved_at", "doctor_url")).alias("doctor_url"),
        F.count_distinct("provider_id").alias("n_ids"),
        F.count_distinct(F.nullif("npi", F.lit(""))).alias("n_npis"),
        F.count_distinct(F.array_join(F.array_sort("offices"), "\n")).alias("n_offices"),
    )
    return per.withColumn("agreed", (F.col("n_ids") == 1) & (F.col("n_npis") == 1) & (F.col("n_offices") == 1)).select("group_id", "doctor_url", "agreed")


def page_outputs(pages: DataFrame, registry: DataFrame, sources: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
    """Page queue, provider links, location summary and profile queue."""
    from millrace.operators.summaries import location_summary

    seen = sources.groupBy("doctor_url").agg(F.count("page_url").alias("pages_seen"), F.count_distinct(F.nullif("specialty_url", F.lit(""))).alias("specialties_seen"))
    per_base = sources.select("doctor_url", F.col("location_url").alias("base_location_url"))
    return {
        "page_queue": pages.orderBy("specialty_name", "state_group", "location", "page_no", "url"),
        "doctor_links": registry.join(seen, "doctor_url", "left").na.fill(0, ["pages_seen", "specialties_seen"]).orderBy("doctor_name", "doctor_url"),
        "location_summary": location_summary(pages, per_base).orderBy("state_group", "location"),
        "profile_queue": profiles.orderBy("status", "doctor_name", "doctor_url"),
    }


def first_per_base(pages: DataFrame) -> DataFrame:
    """The page of each base URL that stands for it: the base itself, else the latest saved or discovered one."""
    exact = F.col("url") == F.col("base_location_url")
    w = Window.partitionBy("base_location_url").orderBy(F.desc(exact), F.desc_nulls_last("saved_at"), F.desc_nulls_last("discovered_at"), "url")
    return pages.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def update_targets(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Where to look for changes: declared targets first, then bases that only pages know."""
    from millrace.operators.merge import union_priority

    cols = ["specialty_slug", "location_url", "specialty_name", "location", "state_group"]
    declared = targets.filter("is_active").select("specialty_slug", F.col("listing_url").alias("location_url"), "specialty_name", "location", "state_group")
    seen = first_per_base(pages).select("specialty_slug", F.col("base_location_url").alias("location_url"), "specialty_name", "location", "state_group")
    return union_priority([declared.select(*cols), seen.select(*cols)], ["specialty_slug", "location_url"])


def projection(runs: DataFrame, locations: DataFrame, providers: DataFrame, memberships: DataFrame, events: DataFrame, run_uuid: str) -> dict[str, tuple[DataFrame, list[str]]]:
    """The five warehouse tables with their keys, in the order in which foreign keys allow writing them."""
    keyed = events.withColumn("event_key", F.concat(F.lit(run_uuid + ":"), F.col("id").cast("string")))
    return {
        "runs": (runs, ["run_uuid"]),
        "providers": (providers, ["doctor_url"]),
        "run_locations": (locations, ["run_uuid", "specialty_slug", "location_url"]),
        "memberships": (memberships, ["specialty_slug", "location_url", "doctor_url"]),
        "events": (keyed, ["event_key"]),
    }


def project(current: dict[str, DataFrame], batch: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, DataFrame]:
    """The warehouse after a batch: overwritten by key, first sightings keep the earliest time, events only added."""
    from millrace.operators.merge import insert_missing, merge

    out = {}
    for name, (df, keys) in batch.items():
        if name not in current:
            out[name] = df
        elif name == "events":
            out[name] = insert_missing(current[name], df, keys)
        else:
            rules = {c: "least" if c == "first_seen_at" else "overwrite" for c in df.columns if c not in keys}
            out[name] = merge(current[name], df, keys, rules)
    return out
