"""Upkeep operators on a handful of rows."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import url as U
from millrace.operators import repairs, trace
from millrace.plans import providers, reports

O = "https://www.example.org"  # noqa: E741
def now():
    return F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp")


def df(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def got(frame, *cols):
    return {tuple(r) for r in frame.select(*cols).collect()}


def test_new_pages_inherit_from_their_base(spark):
    pages = df(spark, "url string, base_location_url string, page_no int, state_group string, location string, specialty_url string, specialty_name string, specialty_slug string", (f"{O}/a/b-1pm", f"{O}/a/b-1pm", 1, "XY", "B", "", "", "a"))
    urls = df(spark, "url string", (f"{O}/a/b-1pm/2/",), (f"{O}/a/b-1pm",), (f"{O}/c/d-2pm",))
    assert got(repairs.ensure_pages(pages, urls, now()), "url", "page_no", "location", "source") == {(f"{O}/a/b-1pm/2", 2, "B", "pagination"), (f"{O}/c/d-2pm", 1, "", "seed")}


def test_marks_and_audits(spark):
    pages = df(spark, "url string, status string, trace_status string, retry_count int", (f"{O}/p1", "saved", None, 0), (f"{O}/p2", "saved", None, 2), (f"{O}/p3", "saved", None, 0))
    trace = df(spark, "listing_url string", (f"{O}/p1",), (f"{O}/p3",))
    held = df(spark, "url string", (f"{O}/p3",)).select(U.safe_slug(F.col("url")).alias("file"))
    assert got(repairs.mark_parsed(pages, trace, held), "url", "trace_status") == {(f"{O}/p1", "parsed"), (f"{O}/p2", None), (f"{O}/p3", None)}
    results = df(spark, "url string, class string", (f"{O}/p3", "valid_empty"))
    assert got(repairs.audit_empty(pages, results, held), "url", "finding", "status") == {(f"{O}/p1", "missing_capture", "retry_pending"), (f"{O}/p2", "exhausted", "review"), (f"{O}/p3", "valid_empty", "valid_empty")}


def test_jobs_before_work(spark):
    jobs = df(spark, "doctor_url string, reason string, status string", ("a", "missing_profile", "pending"), ("b", "stale_profile", "failed"), ("c", "missing_profile", "pending"), ("d", "missing_profile", "pending"))
    profiles = df(spark, "doctor_url string, status string, saved_at timestamp", ("c", "unavailable", None), ("d", "unavailable", datetime.datetime(2024, 1, 1)))
    stored = df(spark, "doctor_url string, profile_sha256 string", ("a", "h"), ("b", "h"))
    assert got(repairs.normalize_jobs(jobs, profiles, stored, 1), "doctor_url", "status") == {("a", "done"), ("b", "pending"), ("c", "pending"), ("d", "unavailable")}


def test_resume_and_selection(spark):
    targets = df(spark, "specialty_slug string, location_url string, specialty_name string", ("s", "1", "S"), ("s", "2", "S"), ("t", "2", "T"))
    done = df(spark, "run_id long, specialty_slug string, location_url string, status string", (5, "s", "1", "complete"), (5, "s", "2", "failed"))
    assert got(repairs.remaining_targets(targets, done, 5), "specialty_slug", "location_url") == {("s", "2"), ("t", "2")}
    with pytest.raises(ValueError):
        repairs.remaining_targets(targets, done, 4)
    assert repairs.open_run(done, df(spark, "run_id long, status string", (5, "done"))) is None and repairs.open_run(done, df(spark, "run_id long, status string", (5, "failed"))) == 5
    snapshots = df(spark, "location_url string", ("2",))
    assert got(repairs.select_targets(targets, snapshots, [" T "]), "location_url") == {("2",)}
    assert got(repairs.select_targets(targets, snapshots, [], True, 5), "specialty_slug", "location_url") == {("s", "2")}


def test_local_import_outcomes(spark):
    members = df(spark, "doctor_url string, is_active boolean", *((d, d != "x") for d in "abcdex"))
    profiles = df(spark, "doctor_url string, status string", ("a", "saved"), ("b", "saved"), ("c", "unavailable"), ("d", "pending"))
    files = df(spark, "doctor_url string, file string", ("a", "f"), ("b", None))
    stored = df(spark, "doctor_url string, profile_sha256 string", ("e", "h"))
    assert got(repairs.local_import(members, profiles, stored, files), "doctor_url", "outcome") == {("a", "import"), ("b", "missing_file"), ("c", "unavailable"), ("d", "not_saved")}


def test_repairs_of_profiles(spark):
    profiles = df(spark, "doctor_url string, status string, file string, last_error string", ("a", "pending", None, None), ("b", "saved", "g", None), ("c", "saved", "h", None))
    fixed = repairs.repaired_redirects(profiles, df(spark, "requested string, file string", ("a", "f"), ("b", "z")))
    assert got(fixed, "doctor_url", "status", "file") == {("a", "saved", "f"), ("b", "saved", "g"), ("c", "saved", "h")}
    bad = df(spark, "url string, reason string", ("b", "challenge frame"), ("c", "profile returned /404"))
    assert got(repairs.repaired_challenges(profiles, bad), "doctor_url", "status") == {("a", "pending"), ("b", "pending"), ("c", "unavailable")}


def test_stored_profiles_expand(spark):
    row = lambda **x: json.dumps([x])
    places = [{"location_id": "l2", "postal_code": "1", "is_virtual_location": False}, {"location_id": "l3", "postal_code": "2"}]
    stored = df(
        spark, "doctor_url string, profile_data string",
        ("a", row(full_name="Ann", location_id="l1", is_virtual_location=True, hospital_affiliations=["H"])), ("b", row(full_name="Bob", locations=places)), ("c", "[]"),
        ("d", row(full_name=" ", location_id="l")), ("e", row(full_name="Eve", locations=[])), ("f", "{broken"),
    )
    out = providers.from_payloads(stored)
    want = {("a", 0, "l1", True, None), ("b", 0, "l2", False, None), ("b", 1, "l3", None, None), ("c", 0, None, None, "empty profile"), ("d", 0, "l", None, "unnamed provider"), ("e", 0, None, None, "no locations"), ("f", 0, None, None, "unreadable profile")}
    assert got(out, "doctor_url", "loc_seq", "location_id", "is_virtual_location", "error") == want and out.columns[2:-1] == schema.FINAL_COLUMNS


def test_payloads_come_back(spark):
    rows = providers.typed(df(spark, "doctor_url string, loc_seq int, full_name string, location_id string, is_virtual_location string, hospital_affiliations string, num_locations string", ("a", 1, "Ann", "l2", "", "[]", "2"), ("a", 0, "Ann", "l1", "True", '["H"]', "2")))
    back = providers.from_payloads(providers.payloads(rows))
    keep = ["doctor_url", "loc_seq", *schema.FINAL_COLUMNS]
    assert sorted(map(repr, rows.select(*keep).collect())) == sorted(map(repr, back.select(*keep).collect())) and back.filter("error IS NOT NULL").count() == 0


def test_reviewed_aliases(spark):
    cohort = df(spark, "specialty_slug string, doctor_url string", ("s", "old"), ("s", "new"), ("s", "else"))
    assert got(providers.reviewed(cohort, df(spark, "alias string, doctor_url string", ("old", "new"), ("new", "new"))), "doctor_url") == {("new",), ("else",)}


def test_projection_keeps_earliest_times_and_events_once(spark):
    t = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    provs = lambda d: df(spark, "doctor_url string, first_seen_at timestamp, n int", ("a", t[d], d))
    run = df(spark, "run_uuid string", ("u",))
    loc = df(spark, "run_uuid string, specialty_slug string, location_url string", ("u", "s", "l"))
    mem = df(spark, "specialty_slug string, location_url string, doctor_url string, first_seen_at timestamp", ("s", "l", "a", t[1]))
    ev = df(spark, "id long, event_type string", (1, "added"))
    first = providers.project({}, providers.projection(run, loc, provs(0), mem, ev, "u"))
    again = providers.project(first, providers.projection(run, loc, provs(1), mem, ev, "u"))
    assert got(again["providers"], "first_seen_at", "n") == {(t[0], 1)} and again["events"].count() == 1 and got(again["events"], "event_key") == {("u:1",)}


def test_reports(spark):
    runs = df(spark, "run_id long, error string", (1, ""), (2, "boom"))
    where = df(spark, "run_id long, status string, n_added long, n_removed long", (1, "complete", 2, 1), (1, "pending", 0, 0))
    jobs = df(spark, "run_id long, status string", (1, "done"))
    assert got(reports.finalize(runs, where, jobs), "run_id", "status", "collection_resolved") == {(1, "partial", False), (2, "failed", True)}
    pages = df(spark, "specialty_slug string, status string", ("s", "saved"), ("s", "unavailable"), ("t", "pending"))
    seen = df(spark, "listing_specialty_slug string, doctor_url string", ("s", "a"), ("s", "b"))
    took = df(spark, "specialty_slug string, seconds double, processed long", ("t", 30.0, 1))
    out = reports.specialty_runtime(pages, seen, df(spark, "doctor_url string, status string", ("a", "saved")), took)
    assert got(out, "specialty_slug", "providers", "saved_profiles", "resolved", "complete", "projected_seconds") == {("s", 2, 1, True, False, None), ("t", 0, 0, False, False, 30.0)}
    timed = df(spark, "run string, status string, total_seconds double, elapsed double, parse double", ("r1", "saved", 2.0, 2.0, 1.0), ("r2", "saved", 2.0, 2.0, None))
    perf = reports.performance(timed, ["parse"])
    assert reports.combined(perf.select("n", "pages_per_minute", F.col("avg_parse").alias("parse")), ["parse"]).first().pages_per_minute == 60.0


def test_captures_are_joined_by_a_column(spark):
    """A slug is worked out once a page, not at every comparison of the join's sort."""
    url = "https://www.example.org/dentists/t-1pm"
    pages = spark.createDataFrame([(url, "saved", None, 0), (url + "/2", "saved", "parsed", 0)], "url string, status string, trace_status string, retry_count int")
    held = U.slugged(pages).select(F.col("_slug").alias("file"))
    results = pages.select("url", F.lit("valid").alias("class"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (trace.unparsed(pages, held), repairs.mark_parsed(pages, pages.select(F.col("url").alias("listing_url")), held), repairs.audit_empty(pages, results, held)):
            joins = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in x]
            assert joins and not any("regexp" in x for x in joins) and "_slug" not in df.columns
        assert [r.url for r in trace.unparsed(pages, held).collect()] == [url]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
