"""Tables written by the sinks and read back by the sources, in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.plans.registry import query, read
from millrace.session import scratch
from millrace.sources import files
from millrace.sources.store import Append, TableStore, first_write
from millrace.streaming import ingest


def _csv(df: DataFrame, tag: str) -> str:
    """df as a folder of CSV files; its path."""
    path = scratch(df.sparkSession, tag)
    files.write_csv(df, df.columns, path)
    return path


@query("SELECT c_custkey::VARCHAR AS k, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'a \"b\", c' || chr(10) || c_mktsegment END AS note, CASE c_custkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '' END AS flag, '[\"' || c_mktsegment || '\"]' AS items FROM customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, blanks, quotes, line breaks, flags and nested values through a CSV file; everything comes back as text."""
    c = read(spark, sf_dir, "customer")
    note = F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit('a "b", c\n'), "c_mktsegment"))
    flag = F.when(F.col("c_custkey") % 3 == 0, True).when(F.col("c_custkey") % 3 == 1, False)
    df = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), note.alias("note"), flag.alias("flag"), F.array("c_mktsegment").alias("items"))
    return files.read_text_csv(spark, _csv(df, "csv"), ["k"])


@query("SELECT c_custkey AS k, c_mktsegment AS segment, [c_name, 'x'] AS names FROM customer")
def pair_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV and JSON pair, compared with each other as it is written; nested values stay nested in JSON."""
    df = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.array("c_name", F.lit("x")).alias("names"))
    folder = scratch(spark, "pair")
    files.write_pair(df, df.columns, folder, "rows")
    return spark.read.schema(df.schema).json(f"{folder}/rows.json")


@query("SELECT 'https://www.example.org/dentists/town-' || c_custkey || 'pm' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '/' || (c_custkey % 4 + 1) END AS url, 'https://www.example.org/dentists/town-' || c_custkey || 'pm' AS base_location_url, (CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE c_custkey % 4 + 1 END)::INTEGER AS page_no, c_mktsegment AS state_group, '' AS location FROM customer WHERE c_custkey % 5 > 0")
def seed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed locations; rows without an address are dropped, queries and blanks around texts go."""
    k = F.col("c_custkey")
    base = F.concat(F.lit("https://www.example.org/dentists/town-"), k.cast("string"), F.lit("pm"))
    url = F.when(k % 5 == 0, " ").otherwise(F.concat(base, F.when(k % 4 > 0, F.concat(F.lit("/"), (k % 4 + 1).cast("string"))).otherwise(""), F.lit("?from=seed")))
    df = read(spark, sf_dir, "customer").select(url.alias("url"), F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("state_group"))
    return files.seed_pages(spark, _csv(df, "seed")).select("url", "base_location_url", "page_no", "state_group", "location")


@query("SELECT 'https://www.example.org/doctor/d-' || (o_custkey % 50) AS url, count(DISTINCT o_orderpriority) AS n_files FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def manifest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile captures that manifests list, with the number of their files; failed ones and pages of other types don't count."""
    o = read(spark, sf_dir, "orders")
    url = F.concat(F.lit("https://www.example.org/doctor/d-"), (F.col("o_custkey") % 50).cast("string"), F.lit("/?a=1"))
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "saved").otherwise("existing")
    df = o.select(url.alias("url"), status.alias("status"), F.lit("profile").alias("page_type"), F.col("o_orderpriority").alias("file"))
    return files.read_manifests(spark, _csv(df, "manifest")).select("url", F.size("files").cast("long").alias("n_files"))


@query("SELECT 'r' || (o_custkey % 10) AS specialty_slug, sum(o_orderkey % 60)::DOUBLE AS seconds, count(*) AS processed FROM orders WHERE o_custkey % 10 = 3 GROUP BY 1")
def runtime_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runtime log of one specialty."""
    df = read(spark, sf_dir, "orders").select(F.concat(F.lit("r"), (F.col("o_custkey") % 10).cast("string")).alias("specialty_slug"), (F.col("o_orderkey") % 60).alias("seconds"), F.lit(1).alias("processed"))
    log = files.read_runtime(spark, _csv(df, "runtime"), "r3")
    return log.groupBy("specialty_slug").agg(F.sum("seconds").alias("seconds"), F.sum("processed").alias("processed"))


@query("SELECT 'g' || (c_custkey // 4) AS group_id, 'u' || c_custkey AS doctor_url FROM customer")
def reviews_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed groups of URLs from JSON files of an array each, one row an alias."""
    c = read(spark, sf_dir, "customer").withColumn("u", F.concat(F.lit("u"), F.col("c_custkey").cast("string")))
    groups = c.groupBy(F.floor(F.col("c_custkey") / 4).alias("g")).agg(F.collect_list("u").alias("urls")).select("g", F.concat(F.lit("g"), F.col("g").cast("string")).alias("group_id"), "urls")
    arrays = groups.groupBy(F.floor(F.col("g") / 500).alias("file")).agg(F.to_json(F.collect_list(F.struct("group_id", "urls"))).alias("value"))
    path = scratch(spark, "reviews")
    arrays.write.partitionBy("file").text(path)
    return files.read_reviews(spark, f"{path}/file=*")


@query("SELECT o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS before FROM orders GROUP BY 1")
def store_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, appended to and read as of both versions."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    store = TableStore(spark, scratch(spark, "store"))
    store.commit({"t": o.filter("k % 2 = 0"), "other": o.limit(0)})
    store.commit({"t": Append(o.filter("k % 2 = 1"))})
    count = lambda df, name: df.groupBy("status").agg(F.count("*").alias(name))
    return count(store.read("t"), "n").join(count(store.read("t", 1), "before"), "status", "left").na.fill(0)


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def stream_first_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's rows merged so that the first of each key stays; the stream is drained twice, which changes nothing."""
    store = TableStore(spark, scratch(spark, "first"))
    for attempt in ("a", "b"):
        events = ingest.event_stream(spark, sf_dir, "events.parquet", read(spark, sf_dir, "events").schema)
        merged = first_write(store, "t", ["user_id"], ["event_id"])
        first = lambda batch, n, merged=merged: merged(batch.select("user_id", "event_id"), n)
        events.writeStream.foreachBatch(first).option("checkpointLocation", scratch(spark, f"first-{attempt}")).trigger(availableNow=True).start().awaitTermination()
    return store.read("t")


@query("SELECT c_mktsegment AS folder, c_custkey AS k FROM customer")
def partitioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by a column, which readers prune by."""
    c = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("folder"), F.col("c_custkey").alias("k"))
    path = scratch(spark, "parts")
    c.write.partitionBy("folder").parquet(path)
    return spark.read.parquet(path).select("folder", "k")


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE 0 END AS balance, least(c_custkey % 7, 3) AS first_seen FROM customer")
def warehouse_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse table after a batch: values overwritten, first sightings at their earliest."""
    c = read(spark, sf_dir, "customer")
    old = c.select(F.col("c_custkey").alias("k"), F.lit(0.0).alias("balance"), (F.col("c_custkey") % 7).alias("first_seen"))
    new = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).otherwise(0.0).alias("balance"), F.lit(3).cast("long").alias("first_seen"))
    return merge.merge(old, new, ["k"], {"balance": "overwrite", "first_seen": "least"})
