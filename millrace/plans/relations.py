"""Joins, aggregates, rankings and set operations over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import measures
from millrace.operators import dedup, merge, quality, summaries
from millrace.plans.registry import query, read

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'saved' WHEN 'O' THEN 'pending' ELSE 'review' END"


def status() -> Column:
    return F.when(F.col("o_orderstatus") == "F", "saved").when(F.col("o_orderstatus") == "O", "pending").otherwise("review")


# ---- joins


@query("SELECT c_custkey, count(o_orderkey) AS n_orders, count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS n_priorities FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def left_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.count_distinct(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("n_priorities"))


@query(f"""
WITH pages AS (SELECT o_custkey AS k, {STATUS} AS status, o_orderkey, o_totalprice, o_orderpriority FROM orders),
a AS (SELECT k, max(o_totalprice) AS top, arg_max(o_orderpriority, o_totalprice * 1000000 + o_orderkey / 1000000.0) AS top_priority, count(*) AS n_pages,
             count(*) FILTER (status = 'saved') AS n_saved, count(*) FILTER (status = 'pending') AS n_pending, count(*) FILTER (status = 'review') AS n_review FROM pages GROUP BY k),
b AS (SELECT o_custkey AS k, count(DISTINCT l_suppkey) AS n_suppliers FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT a.k, a.top, top_priority, n_pages, n_saved, n_pending, n_review, coalesce(n_suppliers, 0) AS n_suppliers FROM a LEFT JOIN b USING (k)
""")
def two_agg_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    pages = orders.select(F.col("o_custkey").alias("k"), status().alias("status"), "o_orderkey", "o_totalprice", "o_orderpriority")
    left = pages.groupBy("k").agg(
        F.max("o_totalprice").alias("top"),
        F.max_by("o_orderpriority", F.struct("o_totalprice", "o_orderkey")).alias("top_priority"),
        F.count("*").alias("n_pages"),
        *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("saved", "pending", "review")),
    )
    right = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("k")).agg(F.count_distinct("l_suppkey").alias("n_suppliers"))
    return left.join(right, "k", "left").na.fill(0, ["n_suppliers"])


@query("SELECT o_orderkey, count(*) AS n_lines, min(l_linenumber) AS first_line FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' GROUP BY o_orderkey")
def inner_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return orders.join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.count("*").alias("n_lines"), F.min("l_linenumber").alias("first_line"))


@query("SELECT c_custkey, coalesce(max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END), 0) = 1 AS urgent FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def left_max_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return read(spark, sf_dir, "customer").join(flags, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("urgent", F.lit(False)).alias("urgent"))


@query("SELECT DISTINCT c_custkey, n_name FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 1 WHERE o_orderkey IS NULL OR n_name IS NULL")
def missing_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").filter("n_regionkey <> 1")
    joined = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.filter("o_orderkey IS NULL OR n_name IS NULL").select("c_custkey", "n_name").distinct()


@query("SELECT coalesce(o_orderstatus, 'missing') AS status, count(DISTINCT c_custkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 GROUP BY 1")
def left_default_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    dear = read(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    joined = read(spark, sf_dir, "customer").join(dear, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy(F.coalesce("o_orderstatus", F.lit("missing")).alias("status")).agg(F.count_distinct("c_custkey").alias("n"))


@query("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'P')")
def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return read(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'P')")
def anti_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return read(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def in_list_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    return read(spark, sf_dir, "orders").join(wanted, F.col("o_custkey") == F.col("k"), "left_semi").select("o_orderkey", "o_custkey")


@query("""
WITH f AS (SELECT p_partkey, 'Part-' || p_brand || '-' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR) AS final FROM part),
k AS (SELECT lower(regexp_replace(final, '-[0-9]+$', '')) AS key, count(*) AS n, min(final) AS matched FROM f GROUP BY 1),
r AS (SELECT DISTINCT 'PART-' || p_brand || '-' || CAST(p_size AS VARCHAR) AS requested FROM part)
SELECT requested, matched AS matched_final FROM r JOIN k ON lower(requested) = key WHERE n = 1
""")
def pattern_to_equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    final = part.select(F.concat(F.lit("Part-"), "p_brand", F.lit("-"), size, F.lit("-"), F.col("p_partkey").cast("string")).alias("final"))
    asked = part.select(F.concat(F.lit("PART-"), "p_brand", F.lit("-"), size).alias("requested")).distinct()
    key = F.lower(F.regexp_replace("final", "-[0-9]+$", ""))
    return summaries.unique_match(asked, final, F.lower("requested"), key, "final").select("requested", "matched_final")


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus, ';' ORDER BY o_orderkey) AS payload FROM orders GROUP BY o_custkey")
def nested_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))
    text = F.transform(rows, lambda r: F.concat_ws(":", r["o_orderkey"].cast("string"), r["o_orderstatus"]))
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(text, ";").alias("payload"))


@query("""
WITH r AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS k FROM customer),
cur AS (SELECT CAST(o_custkey AS VARCHAR) AS k, CASE WHEN count(*) > 10 THEN 'h' ELSE '' END AS stored FROM orders GROUP BY 1)
SELECT CASE WHEN r.k = '' THEN 'invalid' WHEN cur.k IS NULL THEN 'unmatched' WHEN stored <> '' THEN 'already_present' ELSE 'import' END AS outcome, count(*) AS n
FROM r LEFT JOIN cur ON r.k = cur.k GROUP BY 1
""")
def classify_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("c_custkey") % 50 == 0, "").otherwise(F.col("c_custkey").cast("string"))
    rows = read(spark, sf_dir, "customer").select(key.alias("k"))
    current = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("k")).agg(F.when(F.count("*") > 10, "h").otherwise("").alias("stored"))
    return merge.classify_import(rows, current, "k", "stored").groupBy("outcome").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey, coalesce(r_name, n_name, 'key ' || CAST(s_nationkey AS VARCHAR)) AS place FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 1 LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'AFRICA'
""")
def chained_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation").filter("n_regionkey <> 1"), read(spark, sf_dir, "region").filter("r_name <> 'AFRICA'")
    joined = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("s_suppkey", F.coalesce("r_name", "n_name", F.concat(F.lit("key "), F.col("s_nationkey").cast("string"))).alias("place"))


# ---- aggregates


@query("SELECT o_orderpriority, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.status_counts(read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"), ["o_orderpriority"])


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"n_F\", count(*) FILTER (o_orderstatus = 'O') AS \"n_O\", count(*) FILTER (o_orderstatus = 'P') AS \"n_P\" FROM orders GROUP BY 1")
def status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.status_columns(read(spark, sf_dir, "orders"), ["o_orderpriority"], ["F", "O", "P"], "o_orderstatus")


@query("SELECT nullif(event_type, 'click') AS kind, user_id % 10 AS bucket, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1, 2")
def observations_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(F.nullif("event_type", F.lit("click")).alias("kind"), (F.col("user_id") % 10).alias("bucket")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


@query("SELECT p_brand, count(DISTINCT p_type) AS n_types, count(DISTINCT p_size) AS n_sizes, count(*) AS n FROM part GROUP BY 1")
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(F.count_distinct("p_type").alias("n_types"), F.count_distinct("p_size").alias("n_sizes"), F.count("*").alias("n"))


@query("SELECT l_partkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, count(DISTINCT l_returnflag) AS n_flags FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def conflict_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.array_sort(F.collect_set("l_returnflag"))
    return read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.array_join(flags, ",").alias("flags"), F.size(flags).cast("long").alias("n_flags")).filter("n_flags > 1")


@query("SELECT s_nationkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def counts_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey").agg(F.count_distinct("l_partkey").alias("n_parts"))


@query("SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_done, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 7 END), 0) AS BIGINT) AS pages FROM orders GROUP BY 1")
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(done).alias("n_done"), F.coalesce(F.sum(F.when(done, F.col("o_orderkey") % 7)), F.lit(0)).alias("pages"))


@query("SELECT count(*) FILTER (c_acctbal >= 0) AS n_active, count(*) FILTER (c_acctbal < 0) AS n_inactive FROM customer")
def active_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").agg(F.count_if(F.col("c_acctbal") >= 0).alias("n_active"), F.count_if(F.col("c_acctbal") < 0).alias("n_inactive"))


@query("""
WITH c AS (SELECT count(*) AS n, count(c_name) AS c_name, count(nullif(c_mktsegment, 'BUILDING')) AS c_mktsegment, count(CASE WHEN c_custkey % 3 > 0 THEN 1 END) AS listed FROM customer)
SELECT column_name, n_filled, round_even(n_filled * 100.0 / n, 1)::DOUBLE AS pct_filled FROM (SELECT n, unnest(['c_name', 'c_mktsegment', 'listed']) AS column_name, unnest([c_name, c_mktsegment, listed]) AS n_filled FROM c)
""")
def column_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer").select("c_name", F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 3 == 0, "[]").otherwise("[1]").alias("listed"))
    return summaries.column_qa(df, ["c_name", "c_mktsegment", "listed"])


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = summaries.latency_summary(read(spark, sf_dir, "events"), ["event_type"], "value")
    return out.select("event_type", "n", *(F.round(c, 6).alias(c) for c in ("mean", "p50", "p95")))


@query("SELECT event_type, round(avg(value), 6) AS mean, list_sort(list(value))[CAST(round_even((count(*) - 1) * 0.95, 0) AS BIGINT) + 1] AS p95_nearest FROM events GROUP BY 1")
def nearest_rank_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.timing_summary(read(spark, sf_dir, "events"), ["event_type"], "value").select("event_type", F.round("mean", 6).alias("mean"), "p95_nearest")


RUNS = "SELECT user_id % 20 AS run, sum(value) AS seconds, count(*) AS done FROM events GROUP BY 1"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("run")).agg(F.sum("value").alias("seconds"), F.count("*").alias("done"))


@query(f"""
WITH r AS (SELECT run, done * 60 / seconds AS rate FROM ({RUNS}) WHERE seconds > 0 ORDER BY run DESC LIMIT 5)
SELECT count(*) AS n_runs, round(median(rate), 6) AS rate, round(1000 * 60 / median(rate), 4) AS eta_seconds FROM r
""")
def median_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = runs(spark, sf_dir).withColumn("rate", measures.per_minute(F.col("done"), F.col("seconds")))
    return summaries.median_eta(rated, "run", "rate", 1000).select("n_runs", F.round("rate", 6).alias("rate"), F.round("eta_seconds", 4).alias("eta_seconds"))


@query("SELECT event_type, round(sum(value * greatest(1, user_id % 5)) / sum(greatest(1, user_id % 5)), 6) AS mean FROM events GROUP BY 1")
def weighted_stage_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.round(summaries.weighted_mean(F.col("value"), F.col("user_id") % 5), 6).alias("mean"))


@query(f"SELECT run, done, round(done * 60 / seconds, 6) AS rate, round(100 * 60 / (done * 60 / seconds), 4) AS projected_seconds FROM ({RUNS})")
def runtime_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = summaries.runtime_projection(runs(spark, sf_dir), ["run"], "seconds", "done", F.lit(100))
    return out.select("run", "done", F.round("rate", 6).alias("rate"), F.round("projected_seconds", 4).alias("projected_seconds"))


@query("SELECT l_suppkey, count(*) AS n_occurrences, count(DISTINCT l_orderkey) AS n_pages, arg_min(nullif(l_returnflag, 'N'), (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) FILTER (l_returnflag <> 'N') AS first_flag FROM lineitem GROUP BY 1")
def appearance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = read(spark, sf_dir, "lineitem").withColumn("first_flag", F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag")))
    return summaries.occurrence_summary(trace, "l_suppkey", "l_orderkey", ["l_orderkey", "l_linenumber", "l_partkey"], ["first_flag"])


# ---- gates and evidence


@query("""
WITH m AS (SELECT l_orderkey, max(l_linenumber) AS max_page FROM lineitem GROUP BY 1)
SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_pages, max_page, count(DISTINCT l_linenumber) = max_page AND min(l_linenumber) = 1 AND bool_and(l_discount < 0.1) AND bool_and(l_linenumber = max_page OR l_quantity > 1) AND max_page <= 500 AS complete
FROM lineitem JOIN m USING (l_orderkey) GROUP BY l_orderkey, max_page
""")
def contiguity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contiguity_gate(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", F.col("l_discount") < 0.1, F.col("l_quantity") - 1)


@query("SELECT l_orderkey, CAST(g AS INTEGER) AS l_linenumber FROM (SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS g FROM lineitem GROUP BY 1) WHERE (l_orderkey, g) NOT IN (SELECT l_orderkey, l_linenumber FROM lineitem)")
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_pages(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("SELECT l_orderkey, CASE WHEN min(l_discount > 0.02) = max(l_discount > 0.02) THEN min(l_discount > 0.02) END AS unanimous FROM lineitem GROUP BY 1")
def unanimous_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(quality.unanimous(F.col("l_discount") > 0.02).alias("unanimous"))


@query("""
WITH e AS (SELECT user_id, bool_or(event_type = 'purchase') AS p, bool_or(event_type = 'error') AS q, bool_or(value < 0.05) AS low FROM events GROUP BY 1)
SELECT user_id, CASE WHEN p OR q THEN true END AS accepts, CASE WHEN p OR q THEN true WHEN low THEN false END AS telemedicine,
       CASE WHEN p AND q THEN 'purchase=true; error=true' WHEN p THEN 'purchase=true' WHEN q THEN 'error=true' WHEN low THEN 'value=false' ELSE '' END AS evidence FROM e
""")
def evidence_any_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    seen = read(spark, sf_dir, "events").groupBy("user_id").agg(
        quality.any_true(kind == "purchase", kind == "error").alias("accepts"), F.bool_or(kind == "purchase").alias("p"), F.bool_or(kind == "error").alias("q"), F.bool_or(F.col("value") < 0.05).alias("low")
    )
    said = quality.telemedicine({"purchase=true": F.col("p"), "error=true": F.col("q")}, {"value=false": F.col("low")})
    return seen.withColumn("s", said).select("user_id", "accepts", F.col("s.value").alias("telemedicine"), "s.evidence")


@query("""
WITH e AS (SELECT l_orderkey, CASE WHEN min(f) = max(f) THEN min(f) END AS listing, count(DISTINCT f) > 1 AS conflict FROM (SELECT l_orderkey, CASE WHEN l_linenumber < 4 THEN l_tax > 0.03 END AS f FROM lineitem) GROUP BY 1),
o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN NULL ELSE false END AS bookable, o_orderkey % 5 = 0 AS preview, o_orderkey % 2 = 0 AS market FROM orders)
SELECT o_orderkey, CASE WHEN listing IS NOT NULL THEN listing WHEN bookable IS NOT NULL THEN bookable WHEN preview THEN false WHEN NOT market THEN false END AS value,
       CASE WHEN listing IS NOT NULL THEN 'listing' WHEN bookable IS NOT NULL AND conflict THEN 'bookable_after_listing_conflict' WHEN bookable IS NOT NULL THEN 'bookable' WHEN preview THEN 'preview' WHEN NOT market THEN 'marketplace' ELSE 'unresolved' END AS source
FROM o LEFT JOIN e ON o_orderkey = l_orderkey
""")
def appointment_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_linenumber") < 4, F.col("l_tax") > 0.03)
    seen = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(quality.unanimous(flag).alias("listing"), (F.count_distinct(flag) > 1).alias("conflict"))
    bookable = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(False)
    joined = read(spark, sf_dir, "orders").join(seen, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    said = quality.appointments(F.col("listing"), F.coalesce("conflict", F.lit(False)), bookable, F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 2 == 0)
    return joined.select("o_orderkey", said.alias("s")).select("o_orderkey", "s.value", "s.source")


@query("""
WITH e AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders), f AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber > 1)
SELECT o_custkey, count(*) AS n_expected, count(*) FILTER (l_orderkey IS NULL) AS n_missing, CASE WHEN count(*) FILTER (l_orderkey IS NULL) = 0 THEN 'parsed' ELSE 'trace_partial' END AS status
FROM e LEFT JOIN f ON o_orderkey = l_orderkey GROUP BY 1
""")
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    traced = read(spark, sf_dir, "lineitem").filter("l_linenumber > 1").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return quality.coverage(orders, orders.join(traced, "o_orderkey", "left_semi"), ["o_custkey"], "o_orderkey")


@query("""
SELECT page_id, CASE WHEN n > 6 THEN 'valid' WHEN n = 5 THEN 'valid_empty' WHEN t LIKE '%no results found%' THEN 'valid_empty' WHEN t LIKE '%captcha%' THEN 'restriction_like' ELSE 'retry_zero' END AS class
FROM (SELECT page_id, lower(html) || CASE page_id % 4 WHEN 0 THEN ' no results found' WHEN 1 THEN ' captcha' ELSE '' END AS t, len(regexp_extract_all(html, '<p>')) AS n FROM pages)
""")
def capture_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    text = F.concat(F.lower("html"), F.when(k == 0, " no results found").when(k == 1, " captcha").otherwise(""))
    n = F.regexp_count("html", F.lit("<p>"))
    pages = read(spark, sf_dir, "pages").select("page_id", text.alias("t"), n.alias("n"))
    said = quality.listing_class(F.col("t"), F.lit(""), F.lit(""), F.greatest(F.col("n") - 6, F.lit(0)), F.when(F.col("n") == 5, 0))
    return pages.withColumn("c", said).select("page_id", F.col("c.class").alias("class"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 5 = 3 THEN 'JavaScript/ad-block verification page' WHEN doc_id % 5 = 0 THEN 'human-verification message' WHEN doc_id % 5 = 1 THEN 'challenge frame' END AS reason FROM documents
""")
def challenge_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    text = F.concat(F.lower("text"), F.when(k == 0, " are you a human").when(k == 3, " enable JS and disable your ad-blocker").when(k == 4, " unusual activity").otherwise(""))
    said = quality.challenge_reason(text, text, k == 4, k == 4, k == 1)
    return read(spark, sf_dir, "documents").select("doc_id", said.alias("reason"))


@query("""
SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') >= 1 AND count(*) FILTER (o_orderstatus = 'O') = 0 AND count(*) FILTER (o_totalprice < 2000) = 0 AND count(*) FILTER (o_orderpriority = '1-URGENT') = 0 AS ready FROM orders GROUP BY 1
""")
def delivery_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda c: F.count_if(c)
    gate = quality.delivery_gate(count(F.col("o_orderstatus") == "F"), count(F.col("o_orderstatus") == "O"), count(F.col("o_totalprice") < 2000), count(F.col("o_orderpriority") == "1-URGENT"))
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(gate.alias("ready"))


# ---- ranking and history


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(read(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


IDENTITY = "CASE WHEN o_orderkey % 3 = 0 THEN 'provider::' || CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 3 = 1 THEN 'npi::' || CAST(o_custkey AS VARCHAR) ELSE 'url::' || CAST(o_orderkey AS VARCHAR) END"


@query(f"SELECT identity, o_orderkey FROM (SELECT {IDENTITY} AS identity, o_orderkey, o_orderstatus = 'F' AS has FROM orders) QUALIFY row_number() OVER (PARTITION BY identity ORDER BY has DESC, o_orderkey) = 1")
def unique_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, cust = F.col("o_orderkey") % 3, F.col("o_custkey").cast("string")
    who = dedup.identity(F.when(k == 0, cust).otherwise(" "), F.when(k == 1, cust), F.col("o_orderkey").cast("string"))
    return dedup.keep_first(read(spark, sf_dir, "orders").withColumn("identity", who), ["identity"], [F.desc(F.col("o_orderstatus") == "F"), "o_orderkey"]).select("identity", "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey) = 1")
def earliest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.earliest(read(spark, sf_dir, "lineitem"), ["l_partkey"], ["l_linenumber", "l_orderkey"], ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) FILTER (h <> f) AS n_conflicts FROM (
  SELECT l_orderkey, l_linenumber % 3 AS l_linenumber, l_returnflag AS h, first_value(l_returnflag) OVER (PARTITION BY l_orderkey, l_linenumber % 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS f FROM lineitem) GROUP BY 1, 2
""")
def dup_conflict_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumn("k", F.col("l_linenumber") % 3)
    out = dedup.conflicts(df, ["l_orderkey", "k"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("l_returnflag"))
    return out.select("l_orderkey", F.col("k").alias("l_linenumber"), "n_conflicts")


@query("SELECT event_type, event_id, CAST(rn AS INTEGER) AS rn FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 3")
def tail_n_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.last_runs(read(spark, sf_dir, "events"), "event_id", 3, ["event_type"]).select("event_type", "event_id", "rn")


@query("SELECT user_id, event_id, lag(event_type) OVER w AS previous, coalesce(lag(event_type) OVER w <> event_type, false) AS changed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def lag_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.changed(read(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_type").select("user_id", "event_id", "previous", "changed")


@query("""
WITH e AS (SELECT user_id, event_id, event_type IN ('click', 'view') AS present FROM events),
i AS (SELECT *, sum(present::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, event_id, CAST(sum((NOT present)::INT) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS missing_streak FROM i
""".replace("user_id", "user_id"))
def absence_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "events").withColumn("present", F.col("event_type").isin("click", "view"))
    return dedup.absence_streaks(df, ["user_id"], "event_id", "present").select("user_id", "event_id", "missing_streak")


@query("""
SELECT CAST(rn AS INTEGER) AS rn, max(CASE WHEN n_regionkey = 0 THEN n_name END) AS "0", max(CASE WHEN n_regionkey = 1 THEN n_name END) AS "1", max(CASE WHEN n_regionkey = 2 THEN n_name END) AS "2", max(CASE WHEN n_regionkey = 3 THEN n_name END) AS "3", max(CASE WHEN n_regionkey = 4 THEN n_name END) AS "4"
FROM (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS rn FROM (SELECT DISTINCT n_regionkey, n_name FROM nation)) GROUP BY 1
""")
def ragged_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").withColumn("n_regionkey", F.col("n_regionkey").cast("string"))
    return dedup.ragged_pivot(nation, "n_regionkey", "n_name", ["0", "1", "2", "3", "4"])


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY n NULLS LAST, lower(c_name) DESC, c_custkey) AS INTEGER) AS place FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal / 1000) AS BIGINT) END AS n FROM customer) QUALIFY place <= 50")
def topk_mixed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer").withColumn("n", F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 1000)))
    order = [F.asc_nulls_last("n"), F.desc(F.lower("c_name")), F.asc("c_custkey")]
    # a limit in order first: 50 rows a task at most, then their places
    return df.orderBy(*order).limit(50).withColumn("place", F.row_number().over(Window.orderBy(*order))).select("c_custkey", "place")


# ---- set operations


@query("""
SELECT k, src FROM (SELECT o_custkey AS k, 'orders' AS src, 0 AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 UNION ALL SELECT c_custkey, 'customer', 1 FROM customer) QUALIFY row_number() OVER (PARTITION BY k ORDER BY p) = 1
""")
def union_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"), F.lit("orders").alias("src")).distinct()
    return merge.union_priority([first, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("src"))], ["k"])


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(read(spark, sf_dir, "orders").select("o_custkey"))


@query("SELECT l_suppkey AS k FROM lineitem INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k")).intersect(read(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_suppkey"))


@query("""
WITH a AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1)
SELECT a.k, a.s = b.s AS same FROM a JOIN b USING (k)
""")
def set_equal_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    sets = lambda df, n: df.groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_set("l_returnflag")).alias(n))
    return sets(lines, "a").join(sets(lines.filter("l_linenumber <= 2"), "b"), "k").select("k", (F.col("a") == F.col("b")).alias("same"))


@query("""
WITH old AS (SELECT l_orderkey, l_partkey, 'old' AS v FROM lineitem), new AS (SELECT l_orderkey, l_partkey, 'new' AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' AND l_linenumber > 1)
SELECT l_orderkey, v, count(*) AS n FROM (SELECT * FROM old WHERE l_orderkey NOT IN (SELECT l_orderkey FROM new) UNION ALL SELECT * FROM new) GROUP BY 1, 2
""")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    again = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    old = lines.drop("l_linenumber").withColumn("v", F.lit("old"))
    new = lines.filter("l_linenumber > 1").join(again, "l_orderkey", "left_semi").drop("l_linenumber").withColumn("v", F.lit("new"))
    return merge.replace_groups(old, new, ["l_orderkey"]).groupBy("l_orderkey", "v").agg(F.count("*").alias("n"))
