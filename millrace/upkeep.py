"""Commands of a workspace beside collecting and the daily run: deliveries, reports, imports and repairs.

Repairs only say what they would change unless `apply` is given.
"""

from __future__ import annotations

import datetime
import json
import shutil

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import url as U
from millrace.operators import merge, queue, repairs, summaries, trace
from millrace.operators.buckets import BucketedTable
from millrace.plans import providers, reports
from millrace.session import written
from millrace.sources import captures as C
from millrace.sources import files
from millrace.sources.store import Append
from millrace.streaming.progress import Counted, Event, counted


class Upkeep:
    """Mixed into Workspace, whose tables, `_write` and `_at` it uses."""

    # ---- deliveries

    def stored_rows(self) -> DataFrame:
        """Published rows of the stored profiles, with what is wrong with a payload as `error`."""
        return providers.from_payloads(self.read("canonical").filter(F.coalesce("profile_data", F.lit("")) != ""))

    def review(self, path: str, now: datetime.datetime) -> DataFrame:
        """Reviewed groups of URLs of one provider: the newest stands for the others where all agree; returns all groups."""
        aliases = files.read_reviews(self.spark, path)
        stored = self.stored_rows().filter("error IS NULL")
        office = F.concat_ws("|", "location_id", "address_line_1", "city", "state", "postal_code")
        who = stored.groupBy("doctor_url").agg(F.min("provider_id").alias("provider_id"), F.min("npi").alias("npi"), F.collect_set(office).alias("offices"))
        who = who.join(self.read("canonical").select("doctor_url", F.col("profile_updated_at").alias("saved_at")), "doctor_url")
        judged = written(providers.overrides(aliases, who))
        agreed = judged.filter("agreed").select("group_id", "doctor_url")
        rows = aliases.withColumnRenamed("doctor_url", "alias").join(agreed, "group_id").withColumn("reviewed_at", self._at(now))
        self._write(overrides=merge.merge(self.read("overrides"), rows, ["alias"], {"doctor_url": "overwrite", "group_id": "overwrite", "reviewed_at": "overwrite"}))
        return judged

    def export_delivery(self, folder: str, captured: DataFrame | None = None, archive: bool = True) -> dict[str, bool]:
        """Per specialty, under ready/ or needs-review/: a CSV and JSON pair, exceptions, column filling and a manifest; then one ZIP.

        Rows come from the stored profiles, or from captures where given. Returns which specialties are ready.
        """
        t = self.read("trace")
        cohort = providers.reviewed(t.select(F.col("listing_specialty_slug").alias("specialty_slug"), "doctor_url").distinct(), self.read("overrides"))
        open_pages = self.read("pages").filter(~F.col("status").isin(*queue.DONE)).select("specialty_slug", "url")
        rows = self.provider_rows(captured).withColumn("error", F.lit(None).cast("string")) if captured is not None else self.stored_rows()
        rows = written(rows)
        finished = self.read("profiles").filter("status IN ('saved', 'unavailable')").select("doctor_url")
        waiting = cohort.join(finished, "doctor_url", "left_anti").withColumn("reason", F.lit("profile is not collected"))
        bad = cohort.join(rows.filter("error IS NOT NULL").select("doctor_url", F.col("error").alias("reason")).distinct(), "doctor_url")
        review = written(waiting.unionByName(bad).select("specialty_slug", "doctor_url", "reason"))
        out = providers.delivery(cohort, rows.filter("error IS NULL").drop("error"), open_pages, review)
        kept = written(out["rows"])
        summary = {r.specialty_slug: r for r in out["summary"].collect()}
        for slug, s in summary.items():
            where = f"{folder}/{'ready' if s.ready else 'needs-review'}/{slug or 'none'}"
            mine = kept.filter(F.col("specialty_slug") == slug)
            n = files.write_pair(mine, schema.FINAL_COLUMNS, where, "providers")
            files.write_csv(summaries.column_qa(files.as_cells(mine, schema.FINAL_COLUMNS), schema.FINAL_COLUMNS), ["column_name", "n_filled", "pct_filled"], f"{where}/column_qa.csv")
            doubtful = review.filter(F.col("specialty_slug") == slug)
            pages = open_pages.filter(F.col("specialty_slug") == slug).select("specialty_slug", F.col("url").alias("doctor_url"), F.lit("page is open").alias("reason"))
            files.write_csv(doubtful.unionByName(pages).orderBy("reason", "doctor_url"), ["specialty_slug", "doctor_url", "reason"], f"{where}/exceptions.csv")
            counts = {"rows": n, "profiles": s.n_profiles, "open_pages": s.n_open_pages, "conflicts": s.n_conflicts, "review": s.n_review}
            files.write_bytes(f"{where}/manifest.json", files.manifest(self.spark, where, **counts))
        if archive:
            files.write_zip(folder, f"{folder.rstrip('/')}.zip")
        return {slug: s.ready for slug, s in summary.items()}

    def derive(self, path: str) -> dict[str, DataFrame]:
        """The derived datasets of a published CSV file."""
        return providers.derive(providers.typed(files.read_text_csv(self.spark, path, ["full_name", "profile_url"])))

    def zip_input(self, path: str) -> dict[str, DataFrame]:
        """ZIP codes by state from a published CSV file, and a workbook's bytes can be made of them by `zip_workbook`."""
        return providers.zip_inputs(files.read_text_csv(self.spark, path, ["state", "postal_code"]))

    def zip_workbook(self, path: str, uri: str) -> None:
        """The ZIP codes as a workbook: a column for each state, at most as many rows as there are ZIP codes in one."""
        got = self.zip_input(path)
        sheet = lambda df: [list(df.columns), *([None if v is None else v if isinstance(v, int) else str(v) for v in r] for r in df.collect())]
        files.write_bytes(uri, files.xlsx_bytes({"zip_input": sheet(got["wide"]), "counts": sheet(got["counts"]), "conflicts": sheet(got["conflicts"])}))

    def publish(self, run_uuid: str, folder: str, buckets: int = 64) -> dict[str, DataFrame]:
        """Merge the workspace's state into a warehouse of bucketed tables; a database's is `sources.jdbc.publish` on the same batch.

        Tables are merged in the order that foreign keys ask for; a publication that was interrupted is run again.
        """
        out = {}
        for name, (df, keys) in self.projection(run_uuid).items():
            table = BucketedTable(self.spark, f"{folder.rstrip('/')}/{name}", keys, buckets)
            if not table.exists():
                table.create(df)
            elif name == "events":
                table.insert_missing(df)
            else:
                table.upsert(df, {c: "least" if c == "first_seen_at" else "overwrite" for c in df.columns if c not in keys})
            out[name] = table.read()
        return out

    def projection(self, run_uuid: str) -> dict[str, tuple[DataFrame, list[str]]]:
        """The five warehouse tables with their keys, in the order that foreign keys ask for."""
        own = lambda df: df.withColumn("run_uuid", F.lit(run_uuid))
        number = F.xxhash64("run_id", "specialty_slug", "location_url", "doctor_url", "event_type")
        return providers.projection(own(self.read("runs").orderBy(F.desc("run_id")).limit(1)), own(self.read("run_locations")), self.read("canonical").drop("profile_data"), self.read("memberships"), self.read("events").withColumn("id", number), run_uuid)

    # ---- runs

    def finalize_run(self, run_id: int, now: datetime.datetime, error: str | None = None) -> DataFrame:
        """A run's counts, status and whether all that could be collected was."""
        self._write(runs=self._finalized(self.read("runs"), self.read("run_locations"), run_id, now, error))
        return self.read("runs").filter(F.col("run_id") == run_id)

    def _finalized(self, runs: DataFrame, locations: DataFrame, run_id: int, now: datetime.datetime, error: str | None = None) -> DataFrame:
        """runs with what the targets' results and the jobs say of one of them."""
        one = runs.filter(F.col("run_id") == run_id).select("run_id", F.lit(error).cast("string").alias("error"))
        done = reports.finalize(one, locations.na.fill(0), self.read("jobs")).withColumn("finished_at", self._at(now))
        rules = dict.fromkeys(("status", "finished_at", "error", "completed", "failed", "pending", "n_added", "n_removed", "jobs_failed", "jobs_pending", "collection_resolved"), "overwrite")
        return merge.merge(runs, done, ["run_id"], rules, insert=False)

    def reconcile_run(self, run_id: int, apply: bool = False) -> DataFrame:
        """What an interrupted run reached; with apply its status says so. Nothing is declared complete here."""
        base = self.read("runs")
        found = written(reports.reconcile(base.filter(F.col("run_id") == run_id).select("run_id", "status"), self.read("run_locations")))
        if apply:
            self._write(runs=merge.merge(base, found.select("run_id", F.col("proposed").alias("status")), ["run_id"], {"status": "overwrite"}, insert=False))
        return found

    def interrupt(self, run_id: int, now: datetime.datetime) -> None:
        """Mark a run that was broken off."""
        hit = F.col("run_id") == run_id
        self._write(runs=self.read("runs").withColumn("status", F.when(hit & (F.col("status") == "running"), "interrupted").otherwise(F.col("status"))).withColumn("finished_at", F.when(hit, self._at(now)).otherwise(F.col("finished_at"))))

    def resume(self, captured: DataFrame, run_id: int, now: datetime.datetime) -> DataFrame:
        """Go on with a run: only captures of targets that it has not completed. ValueError if there is a newer one."""
        of = captured.withColumn("location_url", U.base_location_url(F.col("url")))
        todo = repairs.remaining_targets(of.select("specialty_slug", "location_url").distinct(), self.read("run_locations"), run_id)
        return self.daily(of.join(todo, ["specialty_slug", "location_url"], "left_semi").drop("location_url"), run_id, now)

    def open_run(self) -> int | None:
        """The latest run with jobs that are still open."""
        return repairs.open_run(self.read("run_locations"), self.read("jobs"))

    def normalize_jobs(self, run_id: int, recheck: int = 0) -> DataFrame:
        """A run's profile jobs before work: what is gone or stored is settled, what failed is tried again."""
        jobs = self.read("jobs")
        fixed = repairs.normalize_jobs(jobs.filter(F.col("run_id") == run_id), self.read("profiles"), self.read("canonical"), recheck)
        self._write(jobs=jobs.filter(F.col("run_id") != run_id).unionByName(fixed.select(*jobs.columns)))
        return self.read("jobs").filter(F.col("run_id") == run_id)

    def update_targets(self) -> DataFrame:
        """Where to look for changes."""
        declared = self.read("targets").join(self.read("specialties").select("specialty_url", "specialty_name"), "specialty_url", "left")
        return providers.update_targets(declared, self.read("pages"))

    # ---- reports

    def perf_report(self, pattern: str, stages: list[str], command: str | None = None) -> DataFrame:
        """Performance of runs from metrics files."""
        m = files.read_metrics(self.spark, pattern, command)
        number = [F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in ("total_seconds", "elapsed", *stages)]
        return reports.performance(m.select(F.col("file").alias("run"), "status", *number), stages)

    def runners_perf(self, pattern: str, stages: list[str]) -> DataFrame:
        """All runners together, by the last row of each one's metrics file."""
        last = files.latest_per_file(files.read_metrics(self.spark, pattern))
        number = [F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in ("n", "pages_per_minute", *stages)]
        return reports.combined(last.select(*number), stages)

    def specialty_runtime(self, pattern: str, slug: str | None = None) -> DataFrame:
        """Per specialty: work done and open, rate and projected time, from the runtime log."""
        t = files.read_runtime(self.spark, pattern, slug)
        out = reports.specialty_runtime(self.read("pages"), self.read("trace"), self.read("profiles"), t)
        return out.filter(F.col("specialty_slug") == slug) if slug else out

    def progress(self, command: str, event: str, now: datetime.datetime, **counts: int) -> None:
        """Note how a command goes on: a row of the progress table."""
        row = self.spark.createDataFrame([(now, command, event, json.dumps(counts, sort_keys=True))], "event_at timestamp, command string, event string, counts string")
        self._write(progress=Append(row))

    @contextmanager
    def watched(self, command: str, now: datetime.datetime) -> Iterator[Counted]:
        """Frames that are watched inside are counted by Spark as they are used; the events go to the progress table in one commit."""
        events: list[Event] = []
        try:
            with counted(command, events.append) as work:
                yield work
        finally:
            rows = [(now, command, e["event"], json.dumps({k: v for k, v in e.items() if k not in ("command", "event")}, sort_keys=True)) for e in events]
            self._write(progress=Append(self.spark.createDataFrame(rows, "event_at timestamp, command string, event string, counts string")))

    def page_outputs(self) -> dict[str, DataFrame]:
        """Page queue, provider links, location summary and profile queue."""
        return providers.page_outputs(self.read("pages"), self.read("doctors"), self.read("doctor_sources"), self.read("profiles"))

    def refresh_targets(self) -> DataFrame:
        """Targets whose advertised counts changed, oldest first, as the queue has them."""
        return self.read("refresh_queue").filter("status IN ('pending', 'processing')").orderBy("queued_at", "specialty_slug", "location_url")

    def log(self, uri: str, columns: list[str], rows: list[list[str]]) -> None:
        """Append to a small CSV log (captures, redirects, runtimes), whose header may be older."""
        files.append_upgraded(self.spark, uri, columns, rows)

    def guard_space(self, least: int = 3 << 30) -> None:
        """ValueError if the workspace's disk has less free space; object stores have no such limit."""
        if "://" not in self.root and shutil.disk_usage(self.root).free < least:
            raise ValueError(f"less than {least} bytes are free at {self.root}")

    # ---- imports

    def import_local_profiles(self, captured: DataFrame, run_id: int, now: datetime.datetime, apply: bool = False) -> dict[str, int]:
        """Store profiles whose captures are there already. captured: file, html, captured_at. Counts by outcome."""
        active = self.read("memberships").filter("is_active").select("doctor_url").distinct()
        found = C.profile_captures(active, captured.select("file", "captured_at"))
        said = written(repairs.local_import(self.read("memberships"), self.read("profiles"), self.read("canonical"), found))
        if apply:
            ready = said.filter("outcome = 'import'").join(captured.select("file", "html"), "file").select(F.col("doctor_url").alias("url"), "html")
            self.store_profiles(ready, run_id, now)
        return {r.outcome: r["count"] for r in said.groupBy("outcome").count().collect()}

    def import_legacy(self, database: str, folders: list[str], now: datetime.datetime) -> dict[str, int]:
        """An older workspace: pages and profiles of its database that aren't here yet, and captures, each from the first folder that has it."""
        pages = files.import_sqlite(self.spark, database, "pages")
        have = [c for c in schema.PAGES.names if c in pages.columns]
        cast = [F.col(c).cast(schema.PAGES[c].dataType).alias(c) for c in have]
        fresh = pages.select(*cast).filter(F.trim("url") != "").withColumn("url", U.normalize_url(F.col("url"))).dropDuplicates(["url"])
        if "base_location_url" not in have:
            fresh = fresh.withColumn("base_location_url", U.base_location_url(F.col("url")))
        before = self.read("pages").count()
        self._write(pages=merge.insert_missing(self.read("pages"), fresh, ["url"]))
        held = files.legacy_captures([C.read_captures(self.spark, f) for f in folders]) if folders else None
        return {"pages": self.read("pages").count() - before, "captures": held.count() if held is not None else 0}

    # ---- repairs

    def _pages_changed(self, changed: DataFrame) -> None:
        rules = {c: "overwrite" for c in changed.columns if c != "url"}
        self._write(pages=merge.merge(self.read("pages"), changed, ["url"], rules, insert=False))

    def ensure_pages(self, urls: DataFrame, now: datetime.datetime) -> DataFrame:
        """Make pages of URLs that aren't any yet."""
        new = written(repairs.ensure_pages(self.read("pages"), urls, self._at(now)))
        self._write(pages=merge.insert_missing(self.read("pages"), new, ["url"]))
        return new

    def retry_zero_listings(self, captured: DataFrame, now: datetime.datetime, apply: bool = False) -> DataFrame:
        """Saved pages whose capture is gone or holds no provider, with what to do with them. captured: file, html."""
        pages = self.read("pages")
        held = U.slugged(pages.select("url")).join(captured.select(F.col("file").alias("_f"), "html"), F.col("_slug") == F.col("_f")).drop("_f", "_slug")
        results = trace.page_results(C.listings(held), self._at(now))
        found = written(repairs.audit_empty(pages, results, captured.select("file")))
        if apply:
            self._pages_changed(found.select("url", "status", "retry_count"))
        return found

    def repair_trace_partials(self, captured: DataFrame, now: datetime.datetime, apply: bool = False) -> DataFrame:
        """Pages whose trace lacks providers that their capture shows: traced anew."""
        partial = self.read("pages").filter("trace_status = 'trace_partial'").select("url", "specialty_slug")
        held = U.slugged(partial).join(captured.select(F.col("file").alias("_f"), "html"), F.col("_slug") == F.col("_f")).drop("_slug").withColumnRenamed("_f", "file")
        rows = written(C.trace_rows(held))
        state = written(trace.coverage(C.listings(held.select("url", "html")), rows))
        if apply:
            fixed = state.filter("status = 'parsed'").select(F.col("listing_url").alias("url"))
            mended = rows.join(fixed.withColumnRenamed("url", "listing_url"), "listing_url", "left_semi")
            update = merge.merge(self.read("pages"), fixed.withColumn("trace_status", F.lit("parsed")).withColumn("status", F.lit("saved")), ["url"], {"trace_status": "overwrite", "status": "overwrite"}, insert=False)
            self._write(trace=trace.ingest(self.read("trace"), mended), pages=update)
        return state

    def mark_parsed(self, captured: DataFrame) -> None:
        """Pages that are traced and whose capture is gone count as parsed."""
        self._write(pages=repairs.mark_parsed(self.read("pages"), self.read("trace"), captured).select(*schema.PAGES.names))

    def repair_profile_challenges(self, captured: DataFrame, now: datetime.datetime, apply: bool = False) -> DataFrame:
        """Saved profiles whose capture is a verification or missing page: to be collected again, or gone; the captures go to quarantine."""
        bad = written(self.rejected(captured.join(self.read("profiles").filter("status = 'saved'").select(F.col("doctor_url").alias("url")), "url", "left_semi")).select("url", "reason"))
        if apply:
            self._write(profiles=repairs.repaired_challenges(self.read("profiles"), bad), quarantine=Append(bad.withColumn("rejected_at", self._at(now))))
        return bad

    def repair_profile_redirects(self, captured: DataFrame, apply: bool = False) -> DataFrame:
        """Waiting profiles whose capture came under the URL that they redirect to. captured: url, file."""
        found = written(C.redirects(self.read("profiles").filter("status <> 'saved'").select("doctor_url"), captured))
        if apply:
            self._write(profiles=repairs.repaired_redirects(self.read("profiles"), found))
        return found

    def repair_listing_unavailable(self, captured: DataFrame, now: datetime.datetime, apply: bool = False) -> DataFrame:
        """Pages that are still open although their capture says that they are gone. The state before stays as an earlier commit."""
        self.guard_space(0)
        pages = self.read("pages").filter(~F.col("status").isin(*queue.DONE)).select("url")
        held = U.slugged(pages).join(captured.select(F.col("file").alias("_f"), "html"), F.col("_slug") == F.col("_f")).drop("_f", "_slug")
        gone = written(trace.page_results(C.listings(held), self._at(now)).filter("class = 'unavailable'").select("url", "reason"))
        if apply:
            self._pages_changed(gone.select("url", F.lit("unavailable").alias("status")))
        return gone

    def quarantine(self, captured: DataFrame, now: datetime.datetime) -> DataFrame:
        """Note rejected captures with their reasons in a table of their own; a capture may be rejected more than once."""
        bad = self.rejected(captured).select("url", "reason").withColumn("rejected_at", self._at(now))
        self._write(quarantine=Append(bad))
        return self.read("quarantine")

    def delete_parsed(self, folder: str, captured: DataFrame, apply: bool = False) -> dict[str, int]:
        """Raw captures of pages whose trace is committed: their number and bytes; with apply they are deleted by the tasks."""
        gone = written(self.cleanup(captured))
        n, size = gone.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        if apply:
            def run(batches):
                for batch in batches:
                    for name in batch.column(0).to_pylist():
                        fs, path = files.filesystem(f"{folder.rstrip('/')}/{name}")
                        if fs.get_file_info(path).is_file:
                            fs.delete_file(path)
                    yield batch
            gone.select("file").mapInArrow(run, "file string").count()
        return {"files": n, "bytes": size}

    def smoke(self, html: str, url: str) -> tuple[bytes, dict[str, object]]:
        """One captured profile as a CSV file of its rows, and what was found of it."""
        one = self.spark.createDataFrame([(url, url, html)], "doctor_url string, url string, html string")
        parsed = C.profiles(one)
        rows = providers.provider_rows(parsed, self.read("trace"))
        cells = [list(r) for r in files.as_cells(rows, schema.FINAL_COLUMNS).collect()]
        p = parsed.select("error", "profile.state_found", "profile.provider_found", F.size("profile.locations").alias("n_locations")).first()
        return files.csv_bytes(cells, schema.FINAL_COLUMNS), p.asDict()
