"""Changes that cost what they touch, databases, mergeable summaries, payloads of any shape, and fair schedules, each with its SQL."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import variants as V
from millrace.operators import queue, sketches
from millrace.operators.buckets import BucketedTable
from millrace.plans.registry import query, read
from millrace.session import scratch
from millrace.sources import captures, files, jdbc

BUCKETS = 16

# ---- bucketed tables: customers, and orders that arrive status by status

RULES = {"name": "overwrite_if_nonblank", "first_seen": "least", "orders": "overwrite"}
BATCH = "SELECT o_custkey AS k, CASE WHEN min(o_orderkey) % 2 = 0 THEN '' ELSE 'N' || min(o_orderkey) END AS name, min(o_orderdate) AS first_seen, count(*) AS orders FROM orders WHERE o_orderstatus = '{}' GROUP BY 1"
STATUSES = ("F", "O", "P")


def _batch(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)
    first = F.min("o_orderkey")
    name = F.when(first % 2 == 0, "").otherwise(F.concat(F.lit("N"), first.cast("string")))
    return o.groupBy(F.col("o_custkey").alias("k")).agg(name.alias("name"), F.min("o_orderdate").alias("first_seen"), F.count("*").alias("orders"))


@query(f"""
SELECT k, arg_max(name, batch) FILTER (name <> '' OR first) AS name, min(first_seen) AS first_seen, arg_max(orders, batch) AS orders FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY batch) = 1 AS first FROM (
    SELECT 0 AS batch, c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, NULL AS first_seen, 0 AS orders FROM customer
    UNION ALL SELECT 1, * FROM ({BATCH.format("F")}) UNION ALL SELECT 2, * FROM ({BATCH.format("O")}) UNION ALL SELECT 3, * FROM ({BATCH.format("P")}))) GROUP BY k
""")
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after three batches of orders, each merged into the buckets that it meets."""
    table = BucketedTable(spark, scratch(spark, "buckets"), ["k"], BUCKETS)
    c = read(spark, sf_dir, "customer")
    first = _batch(spark, sf_dir, "F")
    table.create(c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("name"), F.lit(None).cast(first.schema["first_seen"].dataType).alias("first_seen"), F.lit(0).cast("long").alias("orders")))
    for status in STATUSES:
        table.upsert(_batch(spark, sf_dir, status), RULES)
    return table.read()


@query("SELECT o_custkey AS g, o_orderkey AS v FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_custkey, o_orderkey FROM orders o WHERE o_orderpriority <> '1-URGENT' AND NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_custkey = o.o_custkey AND u.o_orderpriority = '1-URGENT')")
def bucketed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders, replaced as a whole by the urgent ones where there are any."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("v"), "o_orderpriority")
    table = BucketedTable(spark, scratch(spark, "groups"), ["g"], BUCKETS)
    table.create(o.filter("o_orderpriority <> '1-URGENT'").drop("o_orderpriority"))
    table.replace_groups(o.filter("o_orderpriority = '1-URGENT'").drop("o_orderpriority"))
    return table.read()


# ---- databases


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_name END AS name, least(c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE c_custkey END) AS first_seen_at, c_acctbal AS balance FROM customer")
def jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers published to a database, half of them again, and read back by ranges of the key.

    The database is an embedded one on the driver's disk; executors of other processes meet it by files.
    """
    home = tempfile.mkdtemp(prefix="derby-")
    atexit.register(shutil.rmtree, home, ignore_errors=True)
    db = jdbc.Database(f"jdbc:derby:{home}/db;create=true")
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_custkey").alias("first_seen_at"), F.col("c_acctbal").alias("balance"))
    jdbc.publish({"customers": (c, ["k"])}, db)
    again = c.filter("k % 2 = 0").select("k", F.lit("new").alias("name"), F.lit(5).cast("long").alias("first_seen_at"), "balance")
    jdbc.publish({"customers": (again, ["k"])}, db)
    return jdbc.read_table(spark, db, "customers", "k")


# ---- summaries that merge


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of users and values, a row for each day and type, as they would be stored."""
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("run"), "user_id", "value")
    stored, path = sketches.sketches(e, ["day", "run"], "user_id", "value"), scratch(spark, "sketches")
    stored.write.parquet(path)
    return spark.read.parquet(path)


@query("SELECT event_type AS run, count(value) AS n, count(DISTINCT user_id) AS n_users, true AS close FROM events GROUP BY 1")
def sketch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of each type from the days' sketches, told with the exact count and whether it is within the stated error."""
    e = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run")).agg(F.count_distinct("user_id").alias("n_users"))
    got = sketches.report(_daily(spark, sf_dir), ["run"])
    close = F.abs(F.col("n_distinct") - F.col("n_users")) <= sketches.count_error() * F.col("n_users") + 0.5
    return got.join(e, "run").select("run", "n", "n_users", close.alias("close"))


@query("SELECT event_type AS run, count(value) AS n, true AS close_50, true AS close_95 FROM events GROUP BY 1")
def sketch_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each type from the days' sketches: whether the rows below and up to each leave its rank within the stated error."""
    got = sketches.report(_daily(spark, sf_dir), ["run"])
    e = read(spark, sf_dir, "events").filter("value IS NOT NULL").join(F.broadcast(got), F.col("event_type") == F.col("run"))
    ranks = e.groupBy("run", "n").agg(*(F.sum((F.col("value") < F.col(f"p{p}")).cast("long")).alias(f"under_{p}") for p in (50, 95)), *(F.sum((F.col("value") <= F.col(f"p{p}")).cast("long")).alias(f"upto_{p}") for p in (50, 95)))

    def close(p: int):
        slack = sketches.rank_error() * F.col("n") + 1
        return ((F.col(f"under_{p}") <= p / 100 * F.col("n") + slack) & (F.col(f"upto_{p}") >= p / 100 * F.col("n") - slack)).alias(f"close_{p}")

    return ranks.select("run", "n", close(50), close(95))


# ---- payloads of any shape


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties as payloads of several shapes: an object, an array, a text quoted once more, and what isn't JSON."""
    own = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.lit(', "at": [1, {"zip": "0'), (F.col("user_id") % 10).cast("string"), F.lit('"}], "none": null}'))
    k = F.col("event_id") % 4
    quoted = F.concat(F.lit('"'), F.replace(own, F.lit('"'), F.lit('\\"')), F.lit('"'))
    text = F.when(k == 0, own).when(k == 1, F.concat(F.lit("["), own, F.lit(", 7]"))).when(k == 2, quoted).otherwise(F.concat(F.lit("{"), own))
    return read(spark, sf_dir, "events").select("event_id", V.payload(text).alias("v"))


_KEY = "regexp_extract(props, '\"k\": *([0-9]+)', 1)"


@query(f"""
SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'array' WHEN 3 THEN NULL ELSE 'object' END AS shape, CASE WHEN event_id % 4 < 3 THEN event_id END AS id, CASE WHEN event_id % 4 < 3 THEN {_KEY}::BIGINT END AS k, CASE WHEN event_id % 4 IN (0, 2) THEN '0' || (user_id % 10) END AS zip, NULL::BIGINT AS wrong FROM events
""")
def variant_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of payloads whose shape isn't known before; a path that isn't there, or of another type, is null."""
    v, first = F.col("v"), F.coalesce(V.field(F.col("v"), "$[0].id", "bigint"), V.field(F.col("v"), "$.id", "bigint"))
    k = F.coalesce(V.field(v, "$[0].props.k", "bigint"), V.field(v, "$.props.k", "bigint"))
    return _payloads(spark, sf_dir).select("event_id", V.shape(v).alias("shape"), first.alias("id"), k.alias("k"), V.field(v, "$.at[1].zip").alias("zip"), V.field(v, "$.at", "bigint").alias("wrong"))


_PATHS = "SELECT event_id, CASE WHEN event_id % 4 = 1 THEN '$[0]' ELSE '$' END AS root, user_id, props FROM events WHERE event_id % 4 < 3"


@query(f"""
SELECT event_id, root || '.id' AS path, event_id::VARCHAR AS text FROM ({_PATHS}) UNION ALL SELECT event_id, root || '.props.k', {_KEY} FROM ({_PATHS}) UNION ALL SELECT event_id, root || '.at[0]', '1' FROM ({_PATHS})
UNION ALL SELECT event_id, root || '.at[1].zip', '0' || (user_id % 10) FROM ({_PATHS}) UNION ALL SELECT event_id, root || '.none', 'null' FROM ({_PATHS}) UNION ALL SELECT event_id, '$[1]', '7' FROM events WHERE event_id % 4 = 1
""")
def variant_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every plain value inside the payloads, with the path to it."""
    return V.leaves(_payloads(spark, sf_dir), ["event_id"], "v")


@query("SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 2 WHEN event_id % 4 = 3 THEN 0 ELSE 4 END AS n FROM events")
def variant_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many elements or fields each payload has; payloads without any stay."""
    return V.elements(_payloads(spark, sf_dir), "v", outer=True).groupBy("event_id").agg(F.count("pos").alias("n"))


# ---- files and schedules


@query("SELECT c_custkey::VARCHAR AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS seq FROM customer")
def text_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in one file, which is read in many splits."""
    path = scratch(spark, "places")
    read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name").repartition(1).sortWithinPartitions("k").write.csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        placed = files.in_place(spark.read.schema("k string, name string").csv(path), "seq").select("k", "seq")
        out = scratch(spark, "placed")
        placed.write.parquet(out)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return spark.read.parquet(out)


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS round, o_custkey <= 700 AS later FROM orders WHERE o_orderstatus = 'O'")
def fair_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders in rounds that take one of each customer, customers after number 700 first."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_orderstatus") == "O", "pending").otherwise("saved").alias("status"))
    return queue.rounds(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], (700,)).select("o_orderkey", F.col("round").cast("long").alias("round"), "later")


@query("SELECT p_partkey AS k, 'part-' || p_partkey || '.html' AS file, p_name AS html FROM part WHERE p_partkey IN (SELECT max(p_partkey) FROM part UNION ALL SELECT min(p_partkey) FROM part)")
def captures_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of two names from an index of all."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat(F.lit("part-"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("file"), F.col("p_name").alias("html"))
    path = scratch(spark, "index")
    captures.write_index(p, path, 8)
    low, high = p.agg(F.min("k"), F.max("k")).first()
    return captures.looked_up(spark, path, [f"part-{low}.html", f"part-{high}.html"])
