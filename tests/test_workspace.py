"""A workspace from seed to delivery, and two generations of a daily run, on invented pages."""

import datetime
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import main
from millrace.api import Workspace
from millrace.functions import url as U
from tests.test_pages import LISTING, ORIGIN, PAGE, PROFILE_STATE, card, state_script

T1, T2, T3 = (datetime.datetime(2024, 1, d) for d in (1, 2, 3))


def slug(spark, url):
    return spark.createDataFrame([(url,)], "u string").select(U.safe_slug(F.col("u"))).first()[0]


def files(spark, **html):
    return spark.createDataFrame([(slug(spark, u), h) for u, h in html.items()], "file string, html string").withColumn("bytes", F.length("html").cast("long"))


def batch(spark, *pages):
    return spark.createDataFrame([(PAGE if n == 1 else f"{PAGE}/{n}", "".join(card(f"/dentist/{d}", d) for d in ds) or "<p>No results found</p>", "dentists") for n, ds in pages], "url string, html string, specialty_slug string")


def test_seed_ingest_export(spark, tmp_path):
    w = Workspace(spark, str(tmp_path / "w"))
    w.init()
    w.init()
    (tmp_path / "seed.csv").write_text(f"url,state_group,location,specialty_slug\n{PAGE},XY,Springfield,dentists\n")
    assert w.seed(str(tmp_path / "seed.csv"), T1) == 1 and w.seed(str(tmp_path / "seed.csv"), T2) == 1
    assert w.read("pages").count() == 1
    profile = card("/doctor/grace-hopper-md-5", "Grace Hopper")
    held = files(spark, **{PAGE: LISTING + profile, PAGE + "/2": profile, PAGE + "/3": "<p>shell</p>"})
    assert [r["class"] for r in w.ingest_listings(held, T1).collect()] == ["valid"]
    got = {r.url: r.status for r in w.read("pages").collect()}
    assert got == {PAGE: "saved", PAGE + "/2": "pending", PAGE + "/3": "pending"}
    assert {r["class"] for r in w.ingest_listings(held, T2).collect()} == {"valid", "retry_zero"}
    rows = {r.url: (r.status, r.retry_count, r.specialty_slug) for r in w.read("pages").collect()}
    assert rows[PAGE + "/3"] == ("retry_pending", 1, "dentists") and rows[PAGE + "/2"][0] == "saved"
    assert w.read("trace").count() == 4 and w.read("doctors").count() == 3 == w.read("profiles").count()
    assert {r.file for r in w.cleanup(held).collect()} == {slug(spark, PAGE), slug(spark, PAGE + "/2")}
    captured = spark.createDataFrame([(ORIGIN + "/doctor/grace-hopper-md-5", state_script(PROFILE_STATE))], "url string, html string")
    with pytest.raises(ValueError):
        w.export(captured)
    out = w.export(captured, allow_partial=True)
    assert out["final_providers"].count() == 2 and out["unique_providers"].count() == 1 and out["column_qa"].count() == 35
    assert out["errors"].count() == 0
    assert w.export_delivery(str(tmp_path / "out"), captured) == {"dentists": False}
    assert w.store_profiles(captured, 1, T1).first().event_type == "profile_added" and w.store_profiles(captured, 2, T2).first().event_type is None
    assert w.status()["trace"].first().providers == 3


def test_two_generations(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    first = w.daily(batch(spark, (1, ["ann-1"]), (2, ["bob-2"])), 1, T1, confirmations=1).first()
    assert (first.status, first.n_added, first.n_pages) == ("complete", 2, 2)
    lost = w.daily(batch(spark, (2, ["ann-1"])), 2, T2, confirmations=1).first()
    assert (lost.status, lost.n_removed) == ("failed", 0) and w.read("memberships").filter("is_active").count() == 2
    second = w.daily(batch(spark, (1, ["ann-1"])), 3, T3, confirmations=1).first()
    assert (second.status, second.n_removed, second.n_added) == ("complete", 1, 0)
    assert {r.doctor_url.rsplit("/", 1)[1]: r.is_active for r in w.read("canonical").collect()} == {"ann-1": True, "bob-2": False}
    assert {r.url: r.status for r in w.read("pages").collect()} == {PAGE: "saved", PAGE + "/2": "retired"} and w.read("trace").count() == 1
    assert sorted(r.event_type for r in w.read("events").collect()) == ["added", "added", "removed"]
    jobs = w.prepare_profile_jobs(3, T3)
    assert [(r.doctor_url.rsplit("/", 1)[1], r.reason) for r in jobs.collect()] == [("ann-1", "missing_profile")]
    assert w.sync_status()["runs"].count() == 3


def test_bootstrap_migrate_and_counts(spark, tmp_path):
    w = Workspace(spark, str(tmp_path / "w"))
    w.init()
    w.daily(batch(spark, (1, ["ann-1", "bob-2"])), 1, T1)
    w.bootstrap(T2)
    assert w.read("memberships").count() == 2 and w.read("events").count() == 2
    (tmp_path / "old.csv").write_text(f"profile_url,full_name\n{ORIGIN}/dentist/ann-1,Ann\n{ORIGIN}/dentist/zoe-9,Zoe\n,Nobody\n")
    assert w.migrate_profiles(str(tmp_path / "old.csv"), T2) == {"import": 1, "unmatched": 1, "invalid": 1}
    assert w.migrate_profiles(str(tmp_path / "old.csv"), T3)["already_present"] == 1
    count = lambda n: spark.createDataFrame([("dentists", PAGE, n)], "specialty_slug string, location_url string, n int")
    assert [w.snapshot_counts(count(n), t).first().verdict for n, t in ((5, T1), (5, T2), (6, T2.replace(hour=1)), (7, T3))] == ["unchanged", "unchanged", "changed", "already_queued"]


def test_catalog_refresh_and_targets(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    page = lambda *names: spark.createDataFrame([(ORIGIN + "/specialty", "<h2>Browse All Specialties</h2><ul>" + "".join(f'<li><a href="/{n}">{n}</a></li>' for n in names) + "</ul>")], "url string, html string")
    base = [f"kind-{k}" for k in range(10)]
    w.refresh_specialties(page(*base), T1)
    got = {r.specialty_slug: (r.is_active, r.first_seen_at) for r in w.refresh_specialties(page(*base[1:], "new-kind"), T2).collect()}
    assert got["kind-0"] == (False, T1) and got["kind-1"] == (True, T1) and got["new-kind"] == (True, T2)
    with pytest.raises(ValueError):
        w.refresh_specialties(page("only"), T3)
    land = spark.createDataFrame([(ORIGIN + "/dentists", '<a href="/dentists/a-1pm">A</a><a href="/dentists/b-2pm">B</a>')], "url string, html string")
    assert w.discover_targets(land, T1).first().n_locations == 2 and w.read("pages").filter("status = 'pending'").count() == 2


def test_rejected_captures(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    df = spark.createDataFrame([("a", "<p>Verify you are human</p>"), ("b", '<h1 data-test="provider-name">Ann</h1> unusual activity'), ("c", "Not found. Redirecting to /404"), ("d", '<iframe src="https://x.captcha-delivery.com/c"></iframe>')], "url string, html string")
    assert {r.url: r.reason for r in w.rejected(df).collect()} == {"a": "human-verification message", "c": "profile returned /404", "d": "challenge frame"}


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """A workspace with one listing traced in a daily run, and its one profile stored."""
    root = tmp_path_factory.mktemp("delivered")
    w = Workspace(spark, str(root / "w"))
    w.init()
    w.daily(spark.createDataFrame([(PAGE, card("/doctor/grace-hopper-md-5", "Grace Hopper"), "dentists")], "url string, html string, specialty_slug string"), 1, T1)
    w.store_profiles(spark.createDataFrame([(ORIGIN + "/doctor/grace-hopper-md-5", "x")], "url string, html string").filter("false"), 1, T1)
    return w, root


def test_delivery_from_stored_profiles(spark, delivered):
    w, root = delivered
    url = ORIGIN + "/doctor/grace-hopper-md-5"
    assert w.export_delivery(str(root / "early")) == {"dentists": False}
    early = root / "early" / "needs-review" / "dentists"
    assert "profile is not collected" in "".join(p.read_text() for p in (early / "exceptions.csv").glob("*.csv"))
    profiles = spark.createDataFrame([(url, "Grace Hopper", "pending")], "doctor_url string, doctor_name string, status string")
    w._write(profiles=profiles)
    captured = spark.createDataFrame([(url, state_script(PROFILE_STATE))], "url string, html string")
    assert w.store_profiles(captured, 1, T2).first().event_type == "profile_added"
    assert w.stored_rows().count() == 2 and w.stored_rows().filter("error IS NOT NULL").count() == 0
    assert w.export_delivery(str(root / "out")) == {"dentists": True}
    folder = root / "out" / "ready" / "dentists"
    listed = json.loads((folder / "manifest.json").read_text())
    assert listed["summary"]["rows"] == 2 and {f["name"].split("/")[0] for f in listed["files"]} == {"providers.csv", "providers.json", "column_qa.csv", "exceptions.csv"}
    with zipfile.ZipFile(root / "out.zip") as z:
        assert z.testzip() is None and "ready/dentists/manifest.json" in z.namelist()
    data, found = w.smoke(state_script(PROFILE_STATE), url)
    assert found == {"error": None, "state_found": True, "provider_found": True, "n_locations": 2} and data.decode("utf-8-sig").count("\n") == 3


def test_runs_are_finalized_and_reconciled(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    w.daily(batch(spark, (2, ["ann-1"])), 1, T1)
    run = w.read("runs").first()
    assert (run.status, run.completed, run.failed, run.collection_resolved) == ("failed", 0, 1, True)
    assert w.reconcile_run(1).first().proposed == "failed" and w.read("runs").first().status == "failed"
    resumed = w.resume(batch(spark, (1, ["ann-1"])), 1, T2)
    assert resumed.first().status == "complete" and w.read("runs").first().status == "complete" and w.read("run_locations").count() == 1
    assert w.resume(batch(spark, (1, ["ann-1"])), 1, T2).count() == 0
    w.daily(batch(spark, (1, ["ann-1"])), 2, T3)
    with pytest.raises(ValueError):
        w.resume(batch(spark, (1, ["ann-1"])), 1, T3)
    jobs = w.prepare_profile_jobs(2, T3)
    assert jobs.count() == 1 and w.open_run() == 2
    assert w.finalize_run(2, T3).first().collection_resolved is False and w.normalize_jobs(2).first().status == "pending"


def test_repairs_and_cleaning_up(spark, tmp_path):
    w = Workspace(spark, str(tmp_path / "w"))
    w.init()
    folder = tmp_path / "html"
    folder.mkdir()
    pages_ = {PAGE: LISTING, PAGE + "/2": "<p>Not found. Redirecting to /404</p>", PAGE + "/3": "<p>shell</p>"}
    for u, html in pages_.items():
        (folder / slug(spark, u)).write_text(html)
    (tmp_path / "seed.csv").write_text("url,specialty_slug\n" + "".join(f"{u},dentists\n" for u in pages_))
    cli = lambda *a: main(["--workspace", str(tmp_path / "w"), "--now", "2024-01-01", *a], spark)
    assert cli("seed", str(tmp_path / "seed.csv")) == 0 and cli("trace", str(folder)) == 0
    status = lambda: {r.url[len(PAGE):]: r.status for r in w.read("pages").collect()}
    assert status()[""] == "saved" and status()["/3"] == "retry_pending"
    assert w.read("doctor_sources").count() == w.read("doctors").count() == 2
    assert cli("cleanup-listing-html", str(folder)) == 0 and len(list(folder.iterdir())) == 3
    assert cli("cleanup-listing-html", str(folder), "--apply") == 0 and not (folder / slug(spark, PAGE)).exists()
    # the page's capture went after its trace was committed; an audit finds nothing wrong with the others
    assert cli("retry-zero-listings", str(folder)) == 0
    w.mark_parsed(spark.createDataFrame([], "file string"))
    assert w.quarantine(spark.createDataFrame([("u", "<p>Verify you are human</p>")], "url string, html string"), T1).count() == 1
    w.progress("trace", "done", T1, pages=3)
    assert json.loads(w.read("progress").first().counts) == {"pages": 3}
    assert cli("export-delivery", str(tmp_path / "out")) == 2 and cli("seed", str(tmp_path / "missing.csv")) == 1
    with pytest.raises(ValueError):
        w.guard_space(1 << 60)
    (tmp_path / "log.csv").write_text("specialty_slug,seconds,processed\ndentists,60,2\nother,5,1\n")
    assert w.specialty_runtime(str(tmp_path / "log.csv"), "dentists").first().rate == 2.0


def test_publications_merge_into_bucketed_tables(spark, tmp_path):
    """The second publication rewrites what changed, keeps the earliest sightings, and adds events once."""
    w = Workspace(spark, str(tmp_path / "w"))
    w.init()
    w.daily(batch(spark, (1, ["ann-1", "bob-2"])), 1, T1, confirmations=1)
    first = w.publish("u1", str(tmp_path / "house"), 8)
    assert first["providers"].count() == 2 and first["events"].count() == 2
    w.daily(batch(spark, (1, ["ann-1", "cy-3"])), 2, T2, confirmations=1)
    again = w.publish("u2", str(tmp_path / "house"), 8)
    got = {r.doctor_url.rsplit("/", 1)[1]: (r.is_active, r.first_seen_at) for r in again["providers"].collect()}
    assert got == {"ann-1": (True, T1), "bob-2": (False, T1), "cy-3": (True, T2)}
    n = again["events"].count()
    assert w.publish("u2", str(tmp_path / "house"), 8)["events"].count() == n and again["runs"].count() == 2
    assert main(["--workspace", str(tmp_path / "w"), "publish", str(tmp_path / "house"), "u2"], spark) == 0


def test_a_daily_run_is_one_commit(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    before = w.store.commit_number()
    w.daily(batch(spark, (1, ["ann-1"])), 1, T1)
    assert w.store.commit_number() == before + 1
    run = w.read("runs").first()
    assert (run.run_id, run.status, run.completed, run.finished_at) == (1, "complete", 1, T1)


def test_watched_commands_leave_their_counts(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    with w.watched("export", T1) as work:
        work.watch(spark.range(42), "rows").count()
    with pytest.raises(RuntimeError), w.watched("export", T2):
        raise RuntimeError
    said = [(r.event, json.loads(r.counts).get("rows"), json.loads(r.counts).get("error")) for r in w.read("progress").orderBy("event_at", F.desc("event")).collect()]
    assert sorted(said, key=str) == sorted([("start", None, None), ("batch", 42, None), ("done", 42, None), ("start", None, None), ("failed", None, "RuntimeError")], key=str)


def test_checks_queue_and_daemon(spark, tmp_path, capsys):
    """A check keeps nothing; a snapshot queues what changed; the daemon takes each file once, also after a restart."""
    root, held = str(tmp_path / "w"), tmp_path / "held"
    w = Workspace(spark, root)
    w.init()
    (tmp_path / "seed.csv").write_text(f"url,state_group,location,specialty_slug\n{PAGE},XY,Springfield,dentists\n")
    w.seed(str(tmp_path / "seed.csv"), T1)
    held.mkdir()
    name = slug(spark, PAGE)
    (held / name).write_text(LISTING)
    run = lambda *a: main(["--workspace", root, "--now", "2024-01-05T00:00:00", *a], spark)
    assert run("updater-check", str(held)) == 0 and w.read("snapshots").count() == 0
    assert run("updater-snapshot", str(held)) == 0 and w.read("snapshots").count() == 1
    (held / name).write_text(LISTING.replace("12 verified", "14 verified"))
    assert run("updater-check", str(held)) == 2 and w.read("refresh_queue").count() == 0
    assert run("updater-snapshot", str(held)) == 0 and [r.location_url for r in w.refresh_targets().collect()] == [PAGE]
    capsys.readouterr()
    assert run("updater-queue") == 0 and "count_changed" in capsys.readouterr().out
    assert run("updater-daemon", str(held), str(tmp_path / "c"), "--once") == 0 and w.read("trace").count() == 2
    commits = w.store.commit_number()
    assert run("updater-daemon", str(held), str(tmp_path / "c"), "--once") == 0 and w.store.commit_number() == commits
    assert run("export-pages", str(tmp_path / "pages")) == 0
    queue_rows = (tmp_path / "pages" / "page_queue.csv").glob("part-*.csv")
    assert sum(len(p.read_text().splitlines()) - 1 for p in queue_rows) == w.read("pages").count() == 3


def test_interrupted_runs_are_marked(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    w.init()
    w._write(runs=spark.createDataFrame([(5, "running", T1), (4, "complete", T1)], "run_id long, status string, started_at timestamp"))
    assert main(["--workspace", str(tmp_path), "--now", "2024-01-05T00:00:00", "interrupt", "5"], spark) == 0
    assert {r.run_id: r.status for r in w.read("runs").collect()} == {5: "interrupted", 4: "complete"}
