"""A workspace of state tables, and the commands over it.

Every command reads pinned versions, computes the next ones as set operations, and writes them under a
lease. Times and run ids are arguments, so a command that is run again gives the same result.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schema
from millrace.functions import url as U
from millrace.functions.measures import row_fingerprint, rows_fingerprint
from millrace.operators import dedup, diff, merge, quality, queue, repairs, summaries, trace
from millrace.plans import providers, reports
from millrace.session import written
from millrace.sources import captures as C
from millrace.sources import files
from millrace.sources.store import Append, Lease, TableStore
from millrace.streaming.ingest import ingest
from millrace.upkeep import Upkeep

_TS = T.TimestampType()
DOCTORS = schema.struct(**schema.texts("doctor_url", "doctor_name", "first_seen_page_url", "first_seen_location_url", "first_seen_specialty_url", "first_seen_specialty_name"), first_seen_at=_TS, last_seen_at=_TS)
SPECIALTIES = schema.struct(**schema.texts("specialty_url", "specialty_name", "specialty_slug", "entity_type"), is_active=T.BooleanType(), first_seen_at=_TS, last_seen_at=_TS)
TARGETS = schema.struct(**schema.texts("listing_url", "specialty_url", "specialty_slug", "state_group", "location"), is_active=T.BooleanType(), first_seen_at=_TS, last_seen_at=_TS)
TRACE = T.StructType([T.StructField(c, schema.APPEARANCE[c].dataType if c in schema.APPEARANCE.names else T.IntegerType() if c == "listing_page_no" else T.StringType()) for c in schema.TRACE_COLUMNS])
EVENTS = schema.struct(run_id=T.LongType(), **schema.texts("specialty_slug", "location_url", "doctor_url", "event_type", "old_value", "new_value"), event_at=_TS)
CANONICAL = schema.struct(doctor_url=T.StringType(), doctor_name=T.StringType(), is_active=T.BooleanType(), profile_data=T.StringType(), profile_sha256=T.StringType(), profile_updated_at=_TS, first_seen_at=_TS, last_seen_at=_TS, inactive_at=_TS)
SNAPSHOTS = schema.struct(**schema.texts("specialty_slug", "location_url"), n=T.IntegerType(), checked_at=_TS)
RUN_LOCATIONS = schema.struct(run_id=T.LongType(), **schema.texts("specialty_slug", "location_url", "status"), n_pages=T.LongType(), n_members=T.LongType(), fingerprint=T.StringType(), **dict.fromkeys(("n_added", "n_reactivated", "n_removed", "n_removal_pending"), T.LongType()))
JOBS = schema.struct(run_id=T.LongType(), doctor_url=T.StringType(), reason=T.StringType(), status=T.StringType(), attempts=T.IntegerType())
REFRESH = schema.struct(**schema.texts("specialty_slug", "location_url", "reason", "status"), queued_at=_TS)
RUNS = schema.struct(run_id=T.LongType(), status=T.StringType(), started_at=_TS, finished_at=_TS, error=T.StringType(), **dict.fromkeys(("completed", "failed", "pending", "n_added", "n_removed", "jobs_failed", "jobs_pending"), T.LongType()), collection_resolved=T.BooleanType())
SOURCES = schema.struct(**schema.texts("doctor_url", "page_url", "specialty_url", "specialty_name", "location_url"), seen_at=_TS)
LANDING_JOBS = schema.struct(**schema.texts("specialty_url", "specialty_name", "specialty_slug", "status"), queued_at=_TS)
OVERRIDES = schema.struct(**schema.texts("alias", "group_id", "doctor_url"), reviewed_at=_TS)
QUARANTINE = schema.struct(**schema.texts("url", "reason"), rejected_at=_TS)
PROGRESS = schema.struct(event_at=_TS, **schema.texts("command", "event", "counts"))
TABLES = {
    "pages": schema.PAGES, "doctors": DOCTORS, "specialties": SPECIALTIES, "targets": TARGETS, "trace": TRACE, "profiles": schema.PROFILES, "memberships": schema.MEMBERSHIPS, "events": EVENTS,
    "canonical": CANONICAL, "snapshots": SNAPSHOTS, "run_locations": RUN_LOCATIONS, "jobs": JOBS, "refresh_queue": REFRESH, "runs": RUNS, "doctor_sources": SOURCES, "landing_jobs": LANDING_JOBS, "overrides": OVERRIDES, "quarantine": QUARANTINE, "progress": PROGRESS,
}


class Workspace(Upkeep):
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), TableStore(spark, root)

    # ---- tables

    def init(self, *names: str) -> None:
        """Empty state tables, where there are none yet: all, or those that are named."""
        have = self.store.state()
        if missing := {name: self.spark.createDataFrame([], kind) for name, kind in TABLES.items() if name not in have and (not names or name in names)}:
            self.store.commit(missing)

    def read(self, name: str) -> DataFrame:
        return self.store.read(name)

    def _write(self, **tables: DataFrame | Append) -> None:
        """New versions of tables, or more rows of them, in one commit; all are computed from versions that stay readable."""

        def fit(name: str, df: DataFrame) -> DataFrame:
            return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[name].fields))

        with Lease(self.root):
            self.store.commit({n: Append(fit(n, t.df)) if isinstance(t, Append) else fit(n, t) for n, t in tables.items()})

    @staticmethod
    def _at(now: datetime.datetime) -> Column:
        return F.lit(now).cast("timestamp")

    # ---- collecting

    def seed(self, csv: str, now: datetime.datetime) -> int:
        """Locations to begin with; texts overwrite only if they aren't blank, statuses stay."""
        new = files.seed_pages(self.spark, csv).withColumn("discovered_at", self._at(now)).withColumn("retry_count", F.lit(0))
        texts = dict.fromkeys(("state_group", "location", "specialty_url", "specialty_name", "specialty_slug"), "overwrite_if_nonblank")
        self._write(pages=merge.merge(self.read("pages"), new, ["url"], texts))
        return new.count()

    def refresh_specialties(self, capture: DataFrame, now: datetime.datetime) -> DataFrame:
        """The catalog's entries; absent ones go inactive. ValueError if the capture isn't a whole catalog."""
        got = written(C.catalog(capture))
        if bad := got.filter("error IS NOT NULL").first():
            raise ValueError(bad.error)
        known = merge.soft_delete(self.read("specialties"), got.drop("url", "error"), ["specialty_url"], {}, self._at(now))
        # every active specialty's landing page is to be captured; one that is queued keeps its state
        jobs = known.filter("is_active AND entity_type = 'provider_specialty'").select("specialty_url", "specialty_name", "specialty_slug", F.lit("pending").alias("status"), self._at(now).alias("queued_at"))
        self._write(specialties=known, landing_jobs=merge.merge(self.read("landing_jobs"), jobs, ["specialty_url"], {"specialty_name": "overwrite", "specialty_slug": "overwrite"}))
        return self.read("specialties").orderBy(F.lower("specialty_name"), "specialty_url")

    def discover_targets(self, captured: DataFrame, now: datetime.datetime) -> DataFrame:
        """Locations of specialties, and their first pages; only the captured specialties' targets can go inactive."""
        got = C.landings(captured).filter("error IS NULL AND listing_url IS NOT NULL").dropDuplicates(["listing_url"])
        slugs = [r[0] for r in got.select("specialty_slug").distinct().collect()]
        targets = merge.soft_delete(self.read("targets"), got.select("listing_url", "specialty_url", "specialty_slug", "state_group", "location"), ["listing_url"], {}, self._at(now), F.col("o_specialty_slug").isin(*slugs))
        listing = F.col("listing_url")
        first = got.select(listing.alias("url"), U.base_location_url(listing).alias("base_location_url"), "state_group", "location", F.lit(1).alias("page_no"), F.lit("seed").alias("source"), F.lit("pending").alias("status"), "specialty_url", "specialty_slug", F.lit(0).alias("retry_count"), self._at(now).alias("discovered_at"))
        rules = dict.fromkeys(("state_group", "location", "specialty_url", "specialty_slug"), "overwrite")
        landed = got.select("specialty_url").distinct().withColumn("status", F.lit("done"))
        self._write(targets=targets, pages=merge.merge(self.read("pages"), first, ["url"], rules), landing_jobs=merge.merge(self.read("landing_jobs"), landed, ["specialty_url"], {"status": "overwrite"}, insert=False))
        return got.groupBy("specialty_slug").agg(F.count_distinct("state_group").alias("n_states"), F.count("*").alias("n_locations")).orderBy(F.desc("n_locations"), F.lower("specialty_slug"))

    def ingest_listings(self, captured: DataFrame, now: datetime.datetime, force: bool = False) -> DataFrame:
        """Parse captured listings: classes, statuses, trace, registry, further pages and profile jobs.

        captured: file, html. Returns the pages' results; pages that were traced are left alone unless forced.
        """
        pages = self.read("pages")
        todo = trace.unparsed(pages, captured, force)
        todo = todo.select("url", "state_group", "location", "specialty_url", "specialty_name", "specialty_slug", "retry_count")
        held = U.slugged(todo).join(captured.select(F.col("file").alias("_f"), "html"), F.col("_slug") == F.col("_f")).drop("_slug")
        results = written(trace.page_results(C.listings(held), self._at(now)))
        said = queue.page_transition(F.col("class"), F.coalesce("retry_count", F.lit(0)))
        rows = C.trace_rows(held.withColumnRenamed("_f", "file")).join(results.filter("class IN ('valid', 'valid_empty')").select(F.col("url").alias("listing_url")), "listing_url", "left_semi")
        lacking = trace.coverage(results, rows).filter("status = 'trace_partial'").select(F.col("listing_url").alias("_l"), F.lit(True).alias("_partial"))
        done = results.join(lacking, F.col("url") == F.col("_l"), "left").withColumn("_s", said)
        status = F.when(F.coalesce("_partial", F.lit(False)), "review").otherwise(F.col("_s.status"))
        marked = F.when(F.coalesce("_partial", F.lit(False)), "trace_partial").when(F.col("class").isin("valid", "valid_empty"), "parsed")
        update = done.select("url", status.alias("status"), F.col("_s.retry_count").alias("retry_count"), "provider_set_hash", "advertised_total", marked.alias("trace_status"), self._at(now).alias("saved_at"))
        rules = {"status": "overwrite", "retry_count": "overwrite", "provider_set_hash": "coalesce_new", "advertised_total": "coalesce_new", "trace_status": "overwrite", "saved_at": "overwrite"}
        more = results.select(F.explode("pagination_urls").alias("url"), "state_group", "location", "specialty_url", "specialty_name", "specialty_slug").dropDuplicates(["url"])
        found = more.select("*", U.base_location_url(F.col("url")).alias("base_location_url"), U.page_number(F.col("url")).alias("page_no"), F.lit("pagination").alias("source"), F.lit("pending").alias("status"), F.lit(0).alias("retry_count"), self._at(now).alias("discovered_at"))
        seen = trace.doctors(rows, self._at(now))
        bridge = repairs.sources(rows, self._at(now))
        jobs = seen.select("doctor_url", "doctor_name", F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), self._at(now).alias("discovered_at"))
        self._write(
            pages=merge.insert_missing(merge.merge(pages, update, ["url"], rules, insert=False), found, ["url"]),
            trace=trace.ingest(self.read("trace"), rows),
            doctors=merge.merge(self.read("doctors"), seen, ["doctor_url"], trace.DOCTOR_RULES),
            doctor_sources=merge.merge(self.read("doctor_sources"), bridge, ["doctor_url", "page_url"], {"location_url": "overwrite", "seen_at": "overwrite", "specialty_url": "overwrite_if_nonblank", "specialty_name": "overwrite_if_nonblank"}),
            profiles=merge.merge(self.read("profiles"), jobs, ["doctor_url"], {"doctor_name": "backfill_blank"}),
        )
        return results.select("url", "class", "reason", "n_doctors", "advertised_total")

    def reconcile(self, listings: DataFrame, profiles: DataFrame) -> None:
        """Files that have turned up count as saved."""
        self._write(
            pages=queue.reconcile(self.read("pages").withColumn("_slug", U.safe_slug(F.col("url"))), listings, "_slug").drop("_slug"),
            profiles=queue.reconcile(self.read("profiles").withColumn("_slug", U.safe_slug(F.col("doctor_url"))), profiles, "_slug").drop("_slug"),
        )

    def retry(self, statuses: list[str], table: str = "pages") -> None:
        self._write(**{table: queue.reset(self.read(table), statuses)})

    def activate_retries(self) -> None:
        self._write(pages=queue.activate_retries(self.read("pages")))

    def recover_claims(self, now: datetime.datetime, minutes: int = 10) -> None:
        self._write(profiles=queue.recover_stale(self.read("profiles"), self._at(now), minutes))

    def cleanup(self, captured: DataFrame) -> DataFrame:
        """Captures that may be deleted, as a list to act on."""
        return trace.cleanup(self.read("pages"), captured)

    def rejected(self, captured: DataFrame) -> DataFrame:
        """Captures that are verification or missing pages, with the reason; they belong in a table of their own, not in the profiles."""
        said = C.profile_signals(captured)
        s = lambda n: F.col(f"s.{n}")
        path = U.raw_path(F.coalesce(F.col("final_url"), F.lit(""))) if "final_url" in captured.columns else F.lit("")
        reason = F.coalesce(quality.profile_unavailable_reason(s("text"), path), quality.challenge_reason(s("text"), s("visible"), s("has_name"), s("has_provider"), s("has_frame")))
        return said.withColumn("reason", reason).filter("reason IS NOT NULL").drop("s", "error")

    # ---- outputs

    def status(self) -> dict[str, DataFrame]:
        return reports.status_snapshot(self.read("pages"), self.read("profiles"), self.read("trace"))

    def provider_rows(self, captured: DataFrame, source_zip: str = "office") -> DataFrame:
        """Rows of the saved profiles among captures of url and html."""
        mine = captured.join(self.read("profiles").select(F.col("doctor_url").alias("url")), "url", "left_semi").withColumn("doctor_url", F.col("url"))
        return providers.provider_rows(C.profiles(mine.select("doctor_url", "url", "html")), self.read("trace"), source_zip)

    def export(self, captured: DataFrame, allow_partial: bool = False, source_zip: str = "office") -> dict[str, DataFrame]:
        """Final rows, the datasets derived from them, ZIP inputs and a quality report."""
        providers.guard(self.read("pages"), self.read("profiles"), allow_partial)
        final = providers.final_rows(self.provider_rows(captured, source_zip))
        errors = C.profiles(captured.select(F.col("url").alias("doctor_url"), "url", "html")).filter("error IS NOT NULL").select("doctor_url", "error")
        return {"final_providers": final, "errors": errors, **providers.derive(final), **{f"zip_{k}": v for k, v in providers.zip_inputs(final).items()}, "column_qa": summaries.column_qa(files.as_cells(final, schema.FINAL_COLUMNS), schema.FINAL_COLUMNS)}

    # ---- change tracking

    def bootstrap(self, now: datetime.datetime) -> None:
        """Memberships from the trace: added or reactivated, without events and without removals."""
        now_ = self._at(now)
        have = self.read("memberships")
        new = self._members(self.read("trace"))
        out = diff.membership_diff(have, new, ["specialty_slug", "location_url"], "doctor_url", now_, complete=new.filter("false"))
        # nothing passes an empty gate, so old members stay; those in the trace are merged on their own
        fresh = new.select("specialty_slug", "location_url", "doctor_url", "name", F.lit(True).alias("is_active"), F.lit(0).alias("missing_streak"), now_.alias("first_seen_at"), now_.alias("last_seen_at"))
        rules = {"is_active": "overwrite", "missing_streak": "overwrite", "last_seen_at": "overwrite", "name": "backfill_blank"}
        merged = merge.merge(out.memberships, fresh, ["specialty_slug", "location_url", "doctor_url"], rules).withColumn("inactive_at", F.when(F.col("is_active"), F.lit(None)).otherwise(F.col("inactive_at")))
        self._write(memberships=merged)

    @staticmethod
    def _members(rows: DataFrame) -> DataFrame:
        named = rows.select(F.col("listing_specialty_slug").alias("specialty_slug"), U.base_location_url(F.col("listing_url")).alias("location_url"), "doctor_url", "doctor_name", "listing_page_no", "card_index")
        return dedup.earliest(named, ["specialty_slug", "location_url", "doctor_url"], ["listing_page_no", "card_index"], ["doctor_name"]).withColumnRenamed("doctor_name", "name")

    def daily(self, captured: DataFrame, run_id: int, now: datetime.datetime, confirmations: int = diff.CONFIRMATIONS) -> DataFrame:
        """One run over a batch of captured listings (url, html, specialty_slug): gate, diff, events, provider states.

        A target whose pages aren't complete is failed and changes nothing. Returns a row for each target.
        """
        at = self._at(now)
        target = ["specialty_slug", "location_url"]
        parsed = written(trace.page_results(C.listings(captured), at).withColumn("location_url", U.base_location_url(F.col("url"))).withColumn("page", U.page_number(F.col("url"))))
        gates = written(quality.contiguity_gate(parsed, target, "page", F.col("class").isin("valid", "valid_empty"), F.col("n_doctors")))
        passed = gates.filter("complete").select(*target)
        rows = C.trace_rows(captured).withColumn("location_url", U.base_location_url(F.col("listing_url"))).withColumnRenamed("listing_specialty_slug", "specialty_slug").join(passed, target, "left_semi").withColumnRenamed("specialty_slug", "listing_specialty_slug").drop("location_url")
        members = written(self._members(rows))
        moved = diff.membership_diff(self.read("memberships"), members, target, "doctor_url", at, confirmations, passed)
        events = moved.events.withColumn("run_id", F.lit(run_id))
        seen = members.groupBy("doctor_url").agg(F.min("name").alias("doctor_name")).select("doctor_url", "doctor_name", F.lit(True).alias("is_active"), at.alias("first_seen_at"), at.alias("last_seen_at"))
        canonical = merge.merge(self.read("canonical"), seen, ["doctor_url"], {"doctor_name": "overwrite_if_nonblank", "last_seen_at": "overwrite", "is_active": "overwrite"})
        counted = diff.targets_result(members, target, "doctor_url", events)
        result = gates.select(*target, "n_pages", F.when(F.col("complete"), "complete").otherwise("failed").alias("status")).join(counted, target, "left").withColumn("run_id", F.lit(run_id)).na.fill(0)
        batch = parsed.join(passed, target, "left_semi")
        captured_pages = batch.select("url", F.col("location_url").alias("base_location_url"), F.col("page").alias("page_no"), "specialty_slug", F.when(F.col("class") == "valid", "saved").otherwise(F.col("class")).alias("status"), F.when(F.col("page") == 1, "seed").otherwise("pagination").alias("source"), "advertised_total", "provider_set_hash", at.alias("saved_at"), at.alias("discovered_at"))
        rules = {"status": "overwrite", "advertised_total": "coalesce_new", "provider_set_hash": "coalesce_new", "saved_at": "overwrite"}
        pages = merge.merge(self.read("pages"), captured_pages, ["url"], rules)
        # pages of a complete target that were not captured again are retired, and their trace goes
        current = captured_pages.select("url").withColumn("_now", F.lit(True))
        bases = passed.select(F.col("location_url").alias("base_location_url")).distinct().withColumn("_gated", F.lit(True))
        pages = pages.join(current, "url", "left").join(bases, "base_location_url", "left").withColumn("status", F.when(F.coalesce("_gated", F.lit(False)) & F.col("_now").isNull(), "retired").otherwise(F.col("status"))).drop("_now", "_gated")
        kept = self.read("trace").join(pages.filter("status = 'retired'").select(F.col("url").alias("listing_url")), "listing_url", "left_anti")
        # a target that is run again in the same run, as when it is resumed, has its row replaced
        again = merge.replace_groups(self.read("run_locations"), result.select(*RUN_LOCATIONS.names), ["run_id", *target])
        started = self.spark.createDataFrame([(run_id, "running", now)], "run_id long, status string, started_at timestamp")
        self._write(
            memberships=moved.memberships,
            events=Append(events),
            canonical=diff.deactivate(canonical, moved.memberships, "doctor_url", at),
            run_locations=again,
            runs=self._finalized(merge.merge(self.read("runs"), started, ["run_id"], {"status": "overwrite"}), again, run_id, now),
            pages=pages,
            trace=trace.ingest(kept, rows),
        )
        return result

    def prepare_profile_jobs(self, run_id: int, now: datetime.datetime, refresh_days: int = 30) -> DataFrame:
        """Profiles to capture in a run, each with its reason."""
        active = self.read("memberships").filter("is_active").select("doctor_url").distinct()
        state = self.read("profiles").select("doctor_url", F.col("status").alias("p_status"))
        stored = self.read("canonical").select("doctor_url", "profile_sha256", "profile_updated_at")
        again = self.read("events").filter(F.col("run_id") == run_id).groupBy("doctor_url").agg(F.bool_or(F.col("event_type") == "reactivated").alias("back"))
        joined = active.join(state, "doctor_url", "left").join(stored, "doctor_url", "left").join(again, "doctor_url", "left")
        age = (F.unix_seconds(self._at(now)) - F.unix_seconds("profile_updated_at")) / 86400
        has = F.coalesce(F.col("profile_sha256"), F.lit("")) != ""
        reason = queue.profile_reason(F.col("p_status").isNotNull(), has, F.coalesce("back", F.lit(False)), F.coalesce(F.col("p_status") == "unavailable", F.lit(False)), F.coalesce(age, F.lit(float("inf"))), refresh_days)
        jobs = joined.select(F.lit(run_id).cast("long").alias("run_id"), "doctor_url", reason.alias("reason"), F.lit("pending").alias("status"), F.lit(0).alias("attempts")).filter("reason IS NOT NULL")
        self._write(jobs=merge.insert_missing(self.read("jobs"), jobs, ["run_id", "doctor_url"]))
        return jobs

    def store_profiles(self, captured: DataFrame, run_id: int, now: datetime.datetime) -> DataFrame:
        """Parsed profiles into the canonical table; a changed content hash is an event. Unnamed ones are left out."""
        at = self._at(now)
        rows = self.provider_rows(captured).filter(F.trim("full_name") != "")
        hashed = rows.groupBy("doctor_url").agg(F.min("full_name").alias("doctor_name"), rows_fingerprint(*schema.FINAL_COLUMNS).alias("profile_sha256")).join(providers.payloads(rows), "doctor_url")
        changes = written(diff.hash_changes(self.read("canonical"), hashed, "doctor_url", "profile_sha256"))
        new = changes.select("doctor_url", "doctor_name", "profile_data", "profile_sha256", at.alias("profile_updated_at"), F.lit(True).alias("is_active"), at.alias("first_seen_at"), at.alias("last_seen_at"))
        events = changes.filter("event_type IS NOT NULL").select(F.lit(run_id).cast("long").alias("run_id"), F.lit("").alias("specialty_slug"), F.lit("").alias("location_url"), "doctor_url", "event_type", "old_value", F.col("profile_sha256").alias("new_value"), at.alias("event_at"))
        done = changes.select("doctor_url", F.lit("saved").alias("status"), at.alias("saved_at"))
        self._write(
            canonical=merge.merge(self.read("canonical"), new, ["doctor_url"], {"doctor_name": "overwrite_if_nonblank", "profile_data": "overwrite", "profile_sha256": "overwrite", "profile_updated_at": "overwrite"}),
            events=Append(events),
            profiles=merge.merge(self.read("profiles"), done, ["doctor_url"], {"status": "overwrite", "saved_at": "overwrite"}),
            jobs=self._jobs_done(changes.select("doctor_url"), run_id),
        )
        return changes

    def _jobs_done(self, finished: DataFrame, run_id: int) -> DataFrame:
        hit = finished.distinct().withColumn("_done", F.lit(True))
        return self.read("jobs").join(hit, "doctor_url", "left").withColumn("status", F.when(F.col("_done") & (F.col("run_id") == run_id), "done").otherwise(F.col("status"))).drop("_done")

    def migrate_profiles(self, csv: str, now: datetime.datetime) -> dict[str, int]:
        """Profiles of an older export into canonical rows that have none; counts by outcome."""
        rows = files.read_text_csv(self.spark, csv, ["profile_url", "full_name"])
        url = F.when(F.trim("profile_url") != "", U.normalize_url(F.col("profile_url"))).otherwise("")
        named = rows.withColumn("doctor_url", F.when(F.trim("full_name") != "", url).otherwise("")).withColumn("_h", row_fingerprint(*rows.columns))
        # a provider's rows, one a location, make one payload; rows without a URL or a name are counted one by one
        blank = named.filter("doctor_url = ''").select("doctor_url", "full_name", F.lit("").alias("profile_data"), "_h")
        whole = providers.payloads(providers.typed(named.filter("doctor_url <> ''")), "_h")
        whole = named.filter("doctor_url <> ''").groupBy("doctor_url").agg(F.min("full_name").alias("full_name"), F.sha2(F.array_join(F.array_sort(F.collect_set("_h")), ""), 256).alias("_h")).join(whole, "doctor_url")
        judged = written(merge.classify_import(whole.unionByName(blank), self.read("canonical"), "doctor_url", "profile_sha256"))
        new = judged.filter("outcome = 'import'").select("doctor_url", F.col("full_name").alias("doctor_name"), "profile_data", F.col("_h").alias("profile_sha256"), self._at(now).alias("profile_updated_at"))
        self._write(canonical=merge.merge(self.read("canonical"), new, ["doctor_url"], {"doctor_name": "backfill_blank", "profile_data": "overwrite", "profile_sha256": "overwrite", "profile_updated_at": "overwrite"}, insert=False))
        return {r.outcome: r["count"] for r in judged.groupBy("outcome").count().collect()}

    def check_counts(self, counts: DataFrame) -> DataFrame:
        """Advertised counts (specialty_slug, location_url, n) against the latest snapshots; nothing is kept."""
        keys = ["specialty_slug", "location_url"]
        latest = dedup.keep_first(self.read("snapshots"), keys, [F.desc("checked_at"), F.desc("n")])
        waiting = self.read("refresh_queue").filter("status IN ('pending', 'processing') AND reason = 'count_changed'")
        return diff.count_changes(latest, counts, keys, waiting)

    def daemon(self, folder: str, checkpoint: str, seconds: int | None) -> None:
        """Take in captured listings as they arrive, each file once; None: what is there now, then stop."""
        def take(batch: DataFrame, _: int) -> None:
            at = batch.agg(F.max("captured_at")).first()[0]
            if at is not None:
                self.ingest_listings(batch.select("file", "html"), at)

        ingest(self.spark, folder, checkpoint, take, seconds).awaitTermination()

    def snapshot_counts(self, counts: DataFrame, now: datetime.datetime) -> DataFrame:
        """Check advertised counts against the latest snapshots; every check is a snapshot, changes are queued once."""
        keys = ["specialty_slug", "location_url"]
        judged = written(self.check_counts(counts))
        jobs = judged.filter("verdict = 'changed'").select(*keys, F.lit("count_changed").alias("reason"), F.lit("pending").alias("status"), self._at(now).alias("queued_at"))
        # first pages show the count that their target advertises now
        shown = counts.select(F.col("location_url").alias("url"), F.col("n").cast("int").alias("advertised_total")).dropDuplicates(["url"])
        self._write(
            snapshots=Append(counts.select(*keys, F.col("n").cast("int").alias("n"), self._at(now).alias("checked_at"))),
            refresh_queue=Append(jobs),
            pages=merge.merge(self.read("pages"), shown, ["url"], {"advertised_total": "overwrite"}, insert=False),
        )
        return judged

    def sync_status(self, limit: int = 10) -> dict[str, DataFrame]:
        runs = self.read("run_locations").groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("targets"), F.count_if(F.col("status") == "complete").alias("complete"))
        runs = runs.join(self.read("runs").select(F.col("run_id").alias("id"), "status", "collection_resolved"), "id", "left")
        return reports.sync_status(runs, self.read("memberships"), self.read("canonical"), limit)
