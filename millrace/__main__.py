"""Command line: `python -m millrace --workspace FOLDER COMMAND ...`.

Exit codes: 0 done, 1 an error, 2 not complete or in need of review, 130 interrupted.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.api import Workspace
from millrace.session import ship
from millrace.sources import captures, files


def _when(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="millrace", description=__doc__.splitlines()[0])
    out.add_argument("--workspace", default=".")
    out.add_argument("--now", type=_when, default=None, help="the time of the command, ISO 8601; now by default")
    sub = out.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, flags: tuple[str, ...] = (), **options: type) -> None:
        p = sub.add_parser(name)
        for a in arguments:
            p.add_argument(a)
        for f in flags:
            p.add_argument(f"--{f}", action="store_true")
        for o, kind in options.items():
            p.add_argument(f"--{o.replace('_', '-')}", type=kind)

    for name in ("init", "status", "updater-status", "updater-profiles", "updater-queue", "retry"):
        command(name)
    command("seed", "csv")
    for name in ("specialties", "discover-targets", "updater-daily", "updater-snapshot"):
        command(name, "captures", run_id=int)
    command("trace", "captures", flags=("force",))
    command("reconcile", "listings", "profiles")
    for name in ("cleanup-listing-html", "repair-trace-partials", "retry-zero-listings", "repair-profile-challenges", "repair-profile-redirects", "repair-listing-unavailable"):
        command(name, "captures", flags=("apply",))
    command("export", "captures", "out", flags=("allow-partial",), source_zip=str)
    command("export-pages", "out")
    command("updater-check", "captures")
    command("updater-daemon", "captures", "checkpoint", flags=("once",), seconds=int)
    command("interrupt", "run_id")
    command("export-delivery", "out", captures=str)
    command("derive", "csv", "out")
    command("zip-input", "csv", "out")
    command("perf-report", "metrics", only=str)
    command("runners-perf", "metrics")
    command("specialty-runtime", "log", slug=str)
    command("updater-bootstrap")
    command("import-local-profiles", "captures", flags=("apply",), run_id=int)
    command("reconcile-run", "run_id", flags=("apply",))
    command("migrate-profiles", "csv")
    command("publish", "warehouse", "run_uuid")
    command("smoke", "capture", "url")
    command("import-legacy", "database", "folder")
    command("review", "json")
    return out


def _urls(w: Workspace, folder: str) -> DataFrame:
    """Captures of a folder with the URL of the page or profile that each is of."""
    from millrace.functions import url as U

    held = captures.read_captures(w.spark, folder)
    known = w.read("pages").select("url", "specialty_slug").unionByName(w.read("profiles").select(F.col("doctor_url").alias("url"), F.lit("").alias("specialty_slug")))
    return held.join(known.withColumn("_slug", U.safe_slug(F.col("url"))), F.col("file") == F.col("_slug")).drop("_slug")


def _show(out) -> None:
    """A result for people: a table of a few rows, or counts."""
    for name, df in (out if isinstance(out, dict) else {"": out}).items():
        if isinstance(df, DataFrame):
            print(name)
            df.show(50, truncate=80)
        elif df is not None:
            print(name, df)


def run(w: Workspace, a: argparse.Namespace) -> int:
    now = a.now or datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    c, spark = a.command, w.spark
    if c == "init":
        w.init()
    elif c == "status":
        _show(w.status())
    elif c == "updater-status":
        _show(w.sync_status())
    elif c == "updater-profiles":
        _show({"jobs": w.normalize_jobs(w.open_run() or 0)})
    elif c == "updater-queue":
        _show({"queue": w.refresh_targets()})
    elif c == "updater-check":
        # what a snapshot would say, without keeping it
        counts = captures.verified_counts(_urls(w, a.captures).select("url", "html", "specialty_slug"))
        judged = w.check_counts(counts.filter("count IS NOT NULL").select("specialty_slug", F.col("url").alias("location_url"), F.col("count").alias("n")))
        _show(judged)
        return 0 if judged.filter("verdict = 'changed'").limit(1).count() == 0 else 2
    elif c == "updater-daemon":
        w.daemon(a.captures, a.checkpoint, None if a.once else a.seconds or 60)
    elif c == "interrupt":
        w.interrupt(int(a.run_id), now)
    elif c == "export-pages":
        for name, df in w.page_outputs().items():
            files.write_csv(df, df.columns, f"{a.out}/{name}.csv")
    elif c == "retry":
        w.activate_retries()
    elif c == "seed":
        _show({"pages": w.seed(a.csv, now)})
    elif c == "specialties":
        page = captures.latest_capture(captures.read_captures(spark, a.captures)).withColumn("url", F.lit("https://www.example.org/specialty"))
        _show(w.refresh_specialties(page.select("url", "html"), now))
    elif c == "discover-targets":
        from millrace.functions import url as U

        held = captures.read_captures(spark, a.captures).join(w.read("landing_jobs").select(F.col("specialty_url").alias("url"), U.safe_slug(F.col("specialty_url")).alias("_slug")), F.col("file") == F.col("_slug"))
        _show(w.discover_targets(held.select("url", "html"), now))
    elif c == "updater-daily":
        result = w.daily(_urls(w, a.captures), a.run_id or int(now.timestamp()), now)
        _show(result)
        return 0 if result.filter("status <> 'complete'").limit(1).count() == 0 else 2
    elif c == "updater-snapshot":
        counts = captures.verified_counts(_urls(w, a.captures).select("url", "html", "specialty_slug"))
        _show(w.snapshot_counts(counts.filter("count IS NOT NULL").select("specialty_slug", F.col("url").alias("location_url"), F.col("count").alias("n")), now))
    elif c == "trace":
        _show(w.ingest_listings(captures.read_captures(spark, a.captures).select("file", "html"), now, a.force))
    elif c == "reconcile":
        w.reconcile(captures.read_captures(spark, a.listings).select("file"), captures.read_captures(spark, a.profiles).select("file"))
    elif c == "cleanup-listing-html":
        _show(w.delete_parsed(a.captures, captures.read_captures(spark, a.captures).select("file", "bytes"), a.apply))
    elif c == "repair-trace-partials":
        _show(w.repair_trace_partials(captures.read_captures(spark, a.captures), now, a.apply))
    elif c == "retry-zero-listings":
        _show(w.retry_zero_listings(captures.read_captures(spark, a.captures), now, a.apply))
    elif c == "repair-profile-challenges":
        _show(w.repair_profile_challenges(_urls(w, a.captures).select("url", "html"), now, a.apply))
    elif c == "repair-profile-redirects":
        _show(w.repair_profile_redirects(_urls(w, a.captures).select("url", "file"), a.apply))
    elif c == "repair-listing-unavailable":
        _show(w.repair_listing_unavailable(captures.read_captures(spark, a.captures), now, a.apply))
    elif c == "export":
        from millrace import schema

        out = w.export(_urls(w, a.captures).select("url", "html"), a.allow_partial, a.source_zip or "office")
        files.write_pair(out["final_providers"], schema.FINAL_COLUMNS, a.out, "final_providers")
        for name, df in out.items():
            if name != "final_providers":
                files.write_csv(df, df.columns, f"{a.out}/{name}.csv")
        return 0 if out["errors"].limit(1).count() == 0 else 2
    elif c == "export-delivery":
        ready = w.export_delivery(a.out, _urls(w, a.captures).select("url", "html") if a.captures else None)
        _show(ready)
        return 0 if ready and all(ready.values()) else 2
    elif c == "derive":
        for name, df in w.derive(a.csv).items():
            files.write_csv(df, df.columns, f"{a.out}/{name}.csv")
    elif c == "zip-input":
        w.zip_workbook(a.csv, a.out)
    elif c == "perf-report":
        _show(w.perf_report(a.metrics, [], a.only))
    elif c == "runners-perf":
        _show(w.runners_perf(a.metrics, []))
    elif c == "specialty-runtime":
        _show(w.specialty_runtime(a.log, a.slug))
    elif c == "updater-bootstrap":
        w.bootstrap(now)
    elif c == "import-local-profiles":
        _show(w.import_local_profiles(captures.read_captures(spark, a.captures), a.run_id or 0, now, a.apply))
    elif c == "reconcile-run":
        _show(w.reconcile_run(int(a.run_id), a.apply))
    elif c == "migrate-profiles":
        _show(w.migrate_profiles(a.csv, now))
    elif c == "publish":
        _show({n: df.count() for n, df in w.publish(a.run_uuid, a.warehouse).items()})
    elif c == "smoke":
        data, found = w.smoke(files.read_bytes(a.capture).decode("utf-8", "replace"), a.url)
        sys.stdout.write(data.decode("utf-8-sig"))
        _show(found)
        return 0 if found["provider_found"] else 2
    elif c == "import-legacy":
        _show(w.import_legacy(a.database, [a.folder], now))
    elif c == "review":
        _show(w.review(a.json, now))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return run(Workspace(spark or ship(SparkSession.builder.getOrCreate()), a.workspace), a)
    except KeyboardInterrupt:
        return 130
    except Exception as x:
        print(f"{type(x).__name__}: {x}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
