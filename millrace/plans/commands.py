"""Whole commands of a workspace over pages made from the driver's tables, and the parts that only they use, each with its SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.api import Workspace
from millrace.functions import values
from millrace.operators import quality, queue
from millrace.plans.registry import query, read
from millrace.plans.sites import ORIGIN, Q, S, _key, _page_queue, _say, listing_pages, profile_pages, suppliers
from millrace.session import scratch
from millrace.sources import captures

T1, T2 = datetime.datetime(2024, 6, 1), datetime.datetime(2024, 6, 2)


def _workspace(spark: SparkSession, *tables: str) -> Workspace:
    """A new workspace with the tables that a command uses."""
    w = Workspace(spark, scratch(spark, "workspace"))
    w.init(*tables)
    return w


# ---- parts


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pending' WHEN o_orderpriority = '3-MEDIUM' THEN 'saved' ELSE 'pending' END AS status FROM orders WHERE o_orderpriority <> '5-LOW'")
def reset_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed out, blocked and reviewed jobs that wait again; what is saved stays."""
    p = F.col("o_orderpriority")
    status = F.when(p == "1-URGENT", "timeout").when(p == "2-HIGH", "blocked").when(p == "3-MEDIUM", "saved").otherwise("review")
    jobs = read(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'").select("o_orderkey", status.alias("status"))
    return queue.reset(jobs, ["timeout", "blocked", "review"])


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 'done' WHEN user_id % 4 < 2 THEN 'pending' ELSE 'failed' END AS status, (user_id % 4 + 1)::INTEGER AS attempts FROM events")
def counted_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile jobs after one more attempt: done, tried again, or given up."""
    tried = queue.attempt(F.lit("pending"), (F.col("user_id") % 4).cast("int"), F.col("event_type") == "click")
    return read(spark, sf_dir, "events").select("event_id", tried.alias("s")).select("event_id", "s.status", "s.attempts")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Customer-' || lpad(c_custkey::VARCHAR, 3, '0') || '_x' WHEN 1 THEN 'a-b' ELSE 'runner' END AS token FROM customer")
def runner_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of runners as file names: other signs become hyphens, no name is `runner`."""
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.concat(F.lit(" Customer/"), F.lpad(k.cast("string"), 3, "0"), F.lit("_x "))).when(k % 3 == 1, "a b").otherwise("  ")
    return read(spark, sf_dir, "customer").select("c_custkey", values.runner_token(name).alias("token"))


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'explicit /404 redirect' WHEN 1 THEN 'explicit 404 error page' END AS reason FROM documents
""")
def unavailable_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that are gone for good: by a redirect's text, or by title and two sentences; a restriction marker vetoes either."""
    k, text = F.col("doc_id") % 5, F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", " "))
    said = F.when(k.isin(0, 2), "not found. redirecting to /404").when(k.isin(1, 3), "well, this is unexpected. this page may no longer be available").otherwise("not found. redirecting to /404x")
    veto = F.when(k == 2, " just a moment").when(k == 3, " captcha").otherwise("")
    page = F.concat(text, F.lit(" "), said, veto)
    return read(spark, sf_dir, "documents").select("doc_id", quality.unavailable_reason(page, F.when(k == 4, "405 error").otherwise("a 404 error x")).alias("reason"))


@query("""
SELECT 'https://www.example.org/dentist/supplier-' || s_suppkey AS doctor_url, s_name AS full_name, CASE WHEN s_suppkey % 2 = 0 THEN (1000 + s_suppkey % 9000)::VARCHAR ELSE '' END AS review_count, 'Town' AS city, CASE s_suppkey % 3 WHEN 0 THEN 'OH' ELSE 'IA' END AS state, lpad((s_suppkey % 100000)::VARCHAR, 5, '0') AS postal_code FROM supplier
""")
def profiles_without_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles read from their visible text: names, review counts, and a place from marked items or from `City, ST ZIP`."""
    k = F.col("s_suppkey")
    zip_ = F.lpad((k % 100000).cast("string"), 5, "0")
    item = lambda n, v: _say(f'<span itemprop="{n}">', v, "</span>")
    place = F.when(k % 3 == 0, _say(item("addressLocality", F.lit("Town")), item("addressRegion", F.lit("OH")), item("postalCode", zip_))).otherwise(_say("<p>Office 12:</p><div>Town, IA ", zip_, "</div>"))
    count = (1000 + k % 9000).cast("string")
    reviews = F.when(k % 2 == 0, _say("<p>See all ", F.substring(count, 1, 1), ",", F.substring(count, 2, 3), " reviews</p>")).otherwise("")
    html = _say('<html><body><h1 data-test="provider-name">', F.col("s_name"), "</h1>", place, reviews, "</body></html>")
    address = _say(ORIGIN + "/dentist/supplier-", _key("s_suppkey"))
    p = captures.profiles(read(spark, sf_dir, "supplier").select(address.alias("doctor_url"), address.alias("url"), html.alias("html")))
    first = F.get("profile.locations", F.lit(0))
    return p.select("doctor_url", "profile.full_name", "profile.review_count", *(first[c].alias(c) for c in ("city", "state", "postal_code")))


@query("SELECT 'specialty--' || max(o_orderkey) || '.html' AS file, max(o_orderdate)::TIMESTAMP AS captured_at FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'O') AND o_orderstatus = 'O' GROUP BY o_orderdate")
def latest_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest capture whose name begins with a prefix; of those of one time the last name."""
    o = read(spark, sf_dir, "orders")
    # names are compared as texts, so numbers are made of one length for that, and short again
    name = F.concat(F.when(F.col("o_orderstatus") == "O", "specialty--").otherwise("listing--"), F.lpad(_key("o_orderkey"), 12, "0"), F.lit(".html"))
    got = captures.latest_capture(o.select(name.alias("file"), F.col("o_orderdate").cast("timestamp_ntz").alias("captured_at")), "specialty--")
    return got.select(F.regexp_replace("file", "--0*(?=[0-9])", "--").alias("file"), "captured_at")


# ---- commands


@query(f"SELECT base AS base_location_url, count(*) AS n_pages, count(*) FILTER (status = 'saved') AS saved_pages, count(DISTINCT k % 7) AS n_providers FROM ({Q}) GROUP BY base")
def exported_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location summary of the page outputs of a workspace."""
    w = _workspace(spark, "pages", "doctors", "doctor_sources", "profiles")
    pages = _page_queue(spark, sf_dir).withColumn("specialty_url", F.lit("u"))
    sources = read(spark, sf_dir, "orders").select(_say("d", (F.col("o_orderkey") % 7).cast("string")).alias("doctor_url"), _say("p", _key("o_orderkey")).alias("page_url"), F.lit("u").alias("specialty_url"), _say(ORIGIN + "/dentists/town", F.floor(F.col("o_orderkey") / 40).cast("string"), "-", F.floor(F.col("o_orderkey") / 40).cast("string"), "pm").alias("location_url"))
    w._write(pages=pages, doctor_sources=sources)
    return w.page_outputs()["location_summary"].select("base_location_url", "n_pages", "saved_pages", "n_providers")


@query("SELECT 'd' || (o_custkey % 50) AS doctor_url, count(*) AS pages_seen, count(DISTINCT o_orderpriority) AS specialties_seen FROM orders GROUP BY 1")
def exported_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The providers' links of the page outputs: pages and specialties in which each was seen."""
    w = _workspace(spark, "pages", "doctors", "doctor_sources", "profiles")
    o = read(spark, sf_dir, "orders").withColumn("doctor_url", _say("d", (F.col("o_custkey") % 50).cast("string")))
    w._write(doctors=o.select("doctor_url").distinct(), doctor_sources=o.select("doctor_url", _say("p", _key("o_orderkey")).alias("page_url"), F.col("o_orderpriority").alias("specialty_url")))
    return w.page_outputs()["doctor_links"].select("doctor_url", "pages_seen", "specialties_seen")


@query("SELECT 'https://www.example.org/kind-' || n_nationkey AS specialty_url, CASE WHEN n_nationkey % 7 = 1 THEN 'done' ELSE 'pending' END AS status, 'Kind ' || n_name AS specialty_name FROM nation WHERE n_nationkey % 5 <> 0")
def landing_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing pages to capture after a refresh of the catalog: one a specialty that isn't a facility; those that are queued keep their state."""
    n = read(spark, sf_dir, "nation")
    link = _say('<li><a href="/kind-', _key("n_nationkey"), '">Kind ', F.col("n_name"), F.when(F.col("n_nationkey") % 5 == 0, " Clinics").otherwise(""), "</a></li>")
    items = n.agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("items"))
    w = _workspace(spark, "specialties", "landing_jobs")
    w._write(landing_jobs=n.filter("n_nationkey % 7 = 1 AND n_nationkey % 5 <> 0").select(_say(ORIGIN + "/kind-", _key("n_nationkey")).alias("specialty_url"), F.lit("old name").alias("specialty_name"), F.lit("done").alias("status")))
    w.refresh_specialties(items.select(F.lit(ORIGIN + "/specialty").alias("url"), _say("<h2>Browse All Specialties</h2><ul>", F.col("items"), "</ul>").alias("html")), T1)
    return w.read("landing_jobs").select("specialty_url", "status", "specialty_name")


@query(f"SELECT page AS url, (count(*) + CASE WHEN t % 2 = 0 THEN 1 ELSE 0 END)::INTEGER AS advertised_total, t % 2 = 0 AS queued FROM ({S}) GROUP BY page, t")
def refreshed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First pages after two checks of their targets' counts, of which the second finds half of them changed; changed ones are queued."""
    w, listing = _workspace(spark, "pages", "snapshots", "refresh_queue"), listing_pages(spark, sf_dir)
    town = F.regexp_extract("url", r"town(\d+)-", 1).cast("long") % 2
    w._write(pages=listing.select("url", "specialty_slug", F.col("url").alias("base_location_url"), F.lit(1).alias("page_no")))
    counts = captures.verified_counts(listing.select("url", "html", "specialty_slug")).select("specialty_slug", F.col("url").alias("location_url"), F.col("count").alias("n"))
    w.snapshot_counts(counts, T1)
    w.snapshot_counts(counts.withColumn("url", F.col("location_url")).withColumn("n", F.col("n") + F.when(town == 0, 1).otherwise(0)).drop("url"), T2)
    waiting = w.read("refresh_queue").select(F.col("location_url").alias("url"), F.lit(True).alias("_q"))
    return w.read("pages").join(waiting, "url", "left").select("url", "advertised_total", F.coalesce("_q", F.lit(False)).alias("queued"))


@query(f"""
SELECT page AS url, 'saved' AS status, count(*) AS n_traced FROM ({S}) GROUP BY page
UNION ALL SELECT page || '/2', CASE WHEN t % 2 = 0 THEN 'retired' ELSE 'saved' END, CASE WHEN t % 2 = 0 THEN 0 ELSE count(*) END FROM ({S}) GROUP BY page, t
""")
def retired_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs: the second finds half of the targets with one page less; those pages are retired and their trace goes."""
    w, first = _workspace(spark, "pages", "trace", "memberships", "events", "canonical", "run_locations", "runs", "jobs"), listing_pages(spark, sf_dir).select("url", "html", "specialty_slug")
    second = first.withColumn("url", _say(F.col("url"), "/2"))
    even = F.regexp_extract("url", r"town(\d+)-", 1).cast("long") % 2 == 0
    w.daily(first.unionByName(second), 1, T1)
    w.daily(first.unionByName(second.filter(~even)), 2, T2)
    traced = w.read("trace").groupBy(F.col("listing_url").alias("url")).agg(F.count("*").alias("n_traced"))
    return w.read("pages").join(traced, "url", "left").select("url", "status", F.coalesce("n_traced", F.lit(0)).alias("n_traced"))


@query(f"SELECT lkey AS provider_location_key, url AS profile_url FROM (SELECT *, CASE WHEN j = 0 THEN 'p' || k || '|' || n ELSE 'p' || k || '|l' || k || '-' || j END AS lkey FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS j FROM ({S})))")
def exported_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final rows of a workspace's export, whose guard finds nothing open."""
    w, held = _workspace(spark, "pages", "trace", "profiles"), profile_pages(spark, sf_dir)
    rows = captures.trace_rows(listing_pages(spark, sf_dir))
    w._write(trace=rows, profiles=held.select("doctor_url", F.lit("saved").alias("status")))
    return w.export(held.select(F.col("doctor_url").alias("url"), "html"))["final_providers"].select("provider_location_key", "profile_url")


@query(f"SELECT DISTINCT slug, true AS ready FROM ({S})")
def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which specialties a delivery from stored profiles finds ready."""
    w, held = _workspace(spark, "pages", "trace", "profiles", "canonical", "events", "jobs", "overrides"), profile_pages(spark, sf_dir)
    rows = captures.trace_rows(listing_pages(spark, sf_dir))
    own = suppliers(spark, sf_dir).select(_say(ORIGIN + "/dentist/supplier-", _key("k")).alias("doctor_url"))
    w._write(trace=rows, profiles=own.withColumn("status", F.lit("saved")), canonical=own.withColumn("is_active", F.lit(True)))
    w.store_profiles(held.select(F.col("doctor_url").alias("url"), "html"), 1, T1)
    ready = w.export_delivery(scratch(spark, "delivered"), archive=False)
    return spark.createDataFrame(sorted(ready.items()), "slug string, ready boolean")
