"""Merges, change tracking and work queues over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import diff, merge, queue
from millrace.plans.registry import query, read

NOW = "TIMESTAMP '2024-02-01'"


def now() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


# ---- merges: customers known so far, and what a batch of orders says about them

OLD = "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, c_mktsegment AS seg, c_acctbal AS first_seen FROM customer WHERE c_mktsegment <> 'BUILDING'"
NEW = "SELECT o_custkey AS k, 'N' || CAST(min(o_orderkey) AS VARCHAR) AS name, CASE WHEN min(o_orderkey) % 2 = 0 THEN '' ELSE 'SEG' END AS seg, min(o_totalprice) / 100 AS first_seen FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1"


def old(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"), name.alias("name"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("first_seen"))


def new(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("m"), (F.min("o_totalprice") / 100).alias("first_seen"))
    return got.select("k", F.concat(F.lit("N"), F.col("m").cast("string")).alias("name"), F.when(F.col("m") % 2 == 0, "").otherwise("SEG").alias("seg"), "first_seen")


@query(f"""
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN n.name WHEN n.k IS NULL OR o.name <> '' THEN o.name ELSE n.name END AS name,
       CASE WHEN o.k IS NULL OR (n.k IS NOT NULL AND n.seg <> '') THEN n.seg ELSE o.seg END AS seg FROM ({OLD}) o FULL JOIN ({NEW}) n ON o.k = n.k
""")
def merge_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge(old(spark, sf_dir), new(spark, sf_dir), ["k"], {"name": "backfill_blank", "seg": "overwrite_if_nonblank"}).select("k", "name", "seg")


@query(f"SELECT coalesce(o.k, n.k) AS k, coalesce(n.name, o.name) AS name, round(least(o.first_seen, n.first_seen), 4) AS first_seen FROM ({OLD}) o FULL JOIN ({NEW}) n ON o.k = n.k")
def merge_least_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge(old(spark, sf_dir), new(spark, sf_dir), ["k"], {"name": "overwrite", "first_seen": "least"}).select("k", "name", F.round("first_seen", 4).alias("first_seen"))


@query(f"SELECT k, name FROM ({OLD}) UNION ALL SELECT k, name FROM ({NEW}) WHERE k NOT IN (SELECT k FROM ({OLD}))")
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_missing(old(spark, sf_dir), new(spark, sf_dir), ["k"]).select("k", "name")


@query(f"""
SELECT coalesce(o.k, n.k) AS k, coalesce(n.name, o.name) AS name, n.k IS NOT NULL AS is_active, coalesce(o.first_seen_at, {NOW}) AS first_seen_at, CASE WHEN n.k IS NOT NULL THEN {NOW} ELSE o.first_seen_at END AS last_seen_at
FROM (SELECT k, name, TIMESTAMP '2023-01-01' AS first_seen_at FROM ({OLD})) o FULL JOIN ({NEW}) n ON o.k = n.k
""")
def soft_delete_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    then = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    have = old(spark, sf_dir).select("k", "name", F.lit(True).alias("is_active"), then.alias("first_seen_at"), then.alias("last_seen_at"))
    return merge.soft_delete(have, new(spark, sf_dir).select("k", "name"), ["k"], {}, now())


@query(f"""
SELECT n.k, CASE WHEN coalesce(o.name, '') = '' THEN 'profile_added' WHEN o.name <> n.name THEN 'profile_changed' END AS event_type, coalesce(o.name, '') AS old_value FROM ({NEW}) n LEFT JOIN (SELECT k, CASE WHEN k % 5 = 0 THEN 'N1' ELSE name END AS name FROM ({OLD})) o ON o.k = n.k
""")
def hash_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = old(spark, sf_dir).withColumn("name", F.when(F.col("k") % 5 == 0, "N1").otherwise(F.col("name")))
    return diff.hash_changes(have, new(spark, sf_dir), "k", "name").select("k", "event_type", "old_value")


# ---- memberships: users seen for an event type, week by week

SEEN = "SELECT DISTINCT event_type AS target, user_id FROM events WHERE ts >= TIMESTAMP '{}' AND ts < TIMESTAMP '{}'"
WEEKS = [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-22")]


def seen(spark: SparkSession, sf_dir: str, week: int) -> DataFrame:
    a, b = WEEKS[week]
    events = read(spark, sf_dir, "events").filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
    return events.select(F.col("event_type").alias("target"), "user_id", F.lit("").alias("name")).distinct()


def start(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    none = F.lit(None).cast("timestamp_ntz")
    away = F.col("user_id") % 10 == 0
    return seen(spark, sf_dir, 0).select("target", "user_id", (~away).alias("is_active"), F.when(away, 2).otherwise(0).alias("missing_streak"), a.alias("first_seen_at"), a.alias("last_seen_at"), F.when(away, a).otherwise(none).alias("inactive_at"), "name")


def run(spark: SparkSession, sf_dir: str, have: DataFrame, week: int) -> diff.Diff:
    at = F.lit(f"{WEEKS[week][1]} 00:00:00").cast("timestamp_ntz")
    # one target's crawl is incomplete in the second week and must change nothing
    got = seen(spark, sf_dir, week)
    gate = got.select("target").distinct().filter("target <> 'error'") if week == 1 else None
    return diff.membership_diff(have, got, ["target"], "user_id", at, complete=gate)


START = f"SELECT target, user_id, user_id % 10 <> 0 AS active, CASE WHEN user_id % 10 = 0 THEN 2 ELSE 0 END AS streak FROM ({SEEN.format(*WEEKS[0])})"


def _diff_sql(have: str, week: int, gated: str) -> str:
    return f"""SELECT coalesce(o.target, n.target) AS target, coalesce(o.user_id, n.user_id) AS user_id,
       CASE WHEN n.user_id IS NOT NULL THEN true WHEN o.active AND g AND o.streak + 1 >= 2 THEN false ELSE o.active END AS active,
       CASE WHEN n.user_id IS NOT NULL THEN 0 WHEN o.active AND g THEN o.streak + 1 ELSE o.streak END AS streak,
       CASE WHEN n.user_id IS NOT NULL AND o.user_id IS NULL THEN 'added' WHEN n.user_id IS NOT NULL AND NOT o.active THEN 'reactivated' WHEN n.user_id IS NULL AND o.active AND g AND o.streak + 1 >= 2 THEN 'removed' WHEN n.user_id IS NULL AND o.active AND g THEN 'removal_pending' END AS event
FROM (SELECT *, {gated} AS g FROM ({have})) o FULL JOIN (SELECT * FROM ({SEEN.format(*WEEKS[week])}) WHERE {gated}) n ON o.target = n.target AND o.user_id = n.user_id"""


ONE = _diff_sql(START, 1, "target <> 'error'")
TWO = _diff_sql(f"SELECT target, user_id, active, streak FROM ({ONE})", 2, "true")


@query(f"SELECT target, user_id, event AS event_type FROM ({ONE}) WHERE event IS NOT NULL")
def membership_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, start(spark, sf_dir), 1).events.select("target", "user_id", "event_type")


@query(f"SELECT target, user_id, active AS is_active, CAST(streak AS INTEGER) AS missing_streak FROM ({TWO})")
def membership_diff_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, run(spark, sf_dir, start(spark, sf_dir), 1).memberships, 2).memberships.select("target", "user_id", "is_active", "missing_streak")


@query(f"SELECT target, count(*) FILTER (event = 'added') AS n_added, count(*) FILTER (event = 'reactivated') AS n_reactivated, count(*) FILTER (event = 'removed') AS n_removed, count(*) FILTER (event = 'removal_pending') AS n_removal_pending FROM ({TWO}) GROUP BY 1")
def membership_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = run(spark, sf_dir, run(spark, sf_dir, start(spark, sf_dir), 1).memberships, 2)
    return diff.targets_result(seen(spark, sf_dir, 2), ["target"], "user_id", second.events).drop("n_members", "fingerprint")


@query(f"SELECT user_id, bool_or(active) AS is_active, NOT bool_or(active) AS stamped FROM ({TWO}) GROUP BY 1")
def provider_deactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = run(spark, sf_dir, run(spark, sf_dir, start(spark, sf_dir), 1).memberships, 2).memberships
    providers = members.select("user_id").distinct().withColumn("is_active", F.lit(True)).withColumn("inactive_at", F.lit(None).cast("timestamp_ntz"))
    return diff.deactivate(providers, members, "user_id", now()).select("user_id", "is_active", F.col("inactive_at").isNotNull().alias("stamped"))


# ---- counts and queues


@query("""
WITH m AS (SELECT o_custkey AS k, date_trunc('year', o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2),
a AS (SELECT k, n FROM m WHERE y < TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY k ORDER BY y DESC) = 1), b AS (SELECT k, n FROM m WHERE y = TIMESTAMP '1998-01-01')
SELECT b.k, b.n, a.n AS previous, CASE WHEN a.n IS NULL OR a.n = b.n THEN 'unchanged' WHEN b.n > 2 THEN 'already_queued' ELSE 'changed' END AS verdict FROM b LEFT JOIN a ON a.k = b.k
""")
def count_change_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.dedup import keep_first

    yearly = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    latest = keep_first(yearly.filter("y < 1998"), ["k"], [F.desc("y")])
    jobs = yearly.filter("y = 1998 AND n > 2").select("k")
    return diff.count_changes(latest, yearly.filter("y = 1998").drop("y"), ["k"], jobs).select("k", "n", "previous", "verdict")


@query("""
SELECT event_id, CASE c WHEN 'valid' THEN 'saved' WHEN 'valid_empty' THEN 'valid_empty' WHEN 'unavailable' THEN 'unavailable' WHEN 'restriction_like' THEN 'blocked' ELSE CASE WHEN r < 2 THEN 'retry_pending' ELSE 'review' END END AS status,
       CAST(CASE WHEN c IN ('valid', 'valid_empty') THEN 0 WHEN c = 'retry_zero' AND r < 2 THEN r + 1 ELSE r END AS INTEGER) AS retry_count
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'valid' WHEN 1 THEN 'valid_empty' WHEN 2 THEN 'unavailable' WHEN 3 THEN 'restriction_like' ELSE 'retry_zero' END AS c, user_id % 4 AS r FROM events)
""")
def retry_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 5
    kind = F.when(k == 0, "valid").when(k == 1, "valid_empty").when(k == 2, "unavailable").when(k == 3, "restriction_like").otherwise("retry_zero")
    said = queue.page_transition(kind, F.col("user_id") % 4)
    return read(spark, sf_dir, "events").select("event_id", said.alias("s")).select("event_id", "s.status", "s.retry_count")


@query("SELECT count(*) AS n_jobs, count(*) AS n_assigned, count(*) FILTER (o_orderstatus = 'O') > 0 AS any_job, CAST(8 AS BIGINT) AS n_workers FROM orders WHERE o_orderstatus = 'O'")
def claim_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "pending").otherwise("saved").alias("status"))
    dealt = queue.assign(jobs, ["o_orderkey"], 8)
    return dealt.agg(F.count("*").alias("n_jobs"), F.count_distinct("o_orderkey").alias("n_assigned"), (F.count("*") > 0).alias("any_job"), F.count_distinct("worker").alias("n_workers"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 AND ts < TIMESTAMP '2024-02-01' - INTERVAL 10 DAY THEN 'pending' WHEN event_id % 2 = 0 THEN 'opening' ELSE 'saved' END AS status FROM events")
def stale_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "opening").otherwise("saved").alias("status"), F.col("ts").alias("claimed_at"))
    return queue.recover_stale(jobs, now(), 10 * 24 * 60).select("event_id", "status")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 7 = 0 THEN 'missing_profile' WHEN o_orderkey % 5 = 0 THEN 'unparsed_profile' WHEN o_orderkey % 3 = 0 THEN 'reactivated' WHEN o_orderkey % 60 >= 30 THEN 'stale_profile' END AS reason FROM orders
""")
def profile_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", queue.profile_reason(k % 7 != 0, k % 5 != 0, k % 3 == 0, F.col("o_orderstatus") == "P", k % 60, 30).alias("reason"))


@query("""
WITH r AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 250000) AS pending FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN done = 0 AND (failed > 0 OR o_custkey % 10 = 0) THEN 'failed' WHEN failed > 0 OR pending > 0 THEN 'partial' ELSE 'complete' END AS status FROM r
""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    runs = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(s == "F").alias("done"), F.count_if(s == "P").alias("failed"), F.count_if((s == "O") & (F.col("o_totalprice") > 250000)).alias("pending"))
    error = F.when(F.col("o_custkey") % 10 == 0, "boom").otherwise("")
    return runs.select("o_custkey", queue.run_status(F.col("done"), F.col("failed"), F.col("pending"), error).alias("status"))


@query("SELECT CASE WHEN count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') > 0 THEN 'seed' ELSE 'pagination' END AS phase FROM orders")
def work_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "seed").otherwise("pagination")
    status = F.when(F.col("o_orderstatus") == "O", "pending").otherwise("saved")
    return queue.phase(read(spark, sf_dir, "orders").select(source.alias("source"), status.alias("status")))
