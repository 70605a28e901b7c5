"""Scalar functions as queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import measures, url, values
from millrace.plans.registry import query, read

PATH = r"regexp_replace(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/+$', '')"
HOST = "regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
NORMAL = f"(lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {HOST} || CASE WHEN {PATH} = '' THEN '/' ELSE {PATH} END)"
#: The URLs of pages, and variants that exercise the algebra.
URLS = "SELECT page_id, url AS u FROM pages UNION ALL SELECT page_id + 1000000, regexp_replace(url, '[?#].*$', '') || '/' || CAST(page_id % 7 AS VARCHAR) FROM pages UNION ALL SELECT page_id + 2000000, regexp_extract(url, '^([a-z]+://[^/]+)', 1) FROM pages UNION ALL SELECT page_id + 3000000, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/doctor/slug-' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 3 = 0 THEN 'pm' ELSE '' END FROM pages"


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    u, number = F.col("url"), F.col("page_id")
    site = F.regexp_extract(u, "^([a-z]+://[^/]+)", 1)
    tail = F.when(number % 3 == 0, "pm").otherwise("")
    return (
        pages.select("page_id", u.alias("u"))
        .unionByName(pages.select((number + 1000000).alias("page_id"), F.concat(F.regexp_replace(u, "[?#].*$", ""), F.lit("/"), (number % 7).cast("string")).alias("u")))
        .unionByName(pages.select((number + 2000000).alias("page_id"), site.alias("u")))
        .unionByName(pages.select((number + 3000000).alias("page_id"), F.concat(site, F.lit("/doctor/slug-"), number.cast("string"), tail).alias("u")))
    )


@query(f"SELECT page_id, {NORMAL} AS normalized FROM ({URLS})")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls(spark, sf_dir).select("page_id", url.normalize_url(F.col("u")).alias("normalized"))


@query(f"""
SELECT page_id, regexp_replace(n, '/[0-9]+$', '') AS base_url,
       CASE WHEN page = '' THEN 1 ELSE CAST(page AS INTEGER) END AS page_no
FROM (SELECT page_id, CASE WHEN {PATH} = '' THEN rtrim({NORMAL}, '/') ELSE {NORMAL} END AS n,
             regexp_extract(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/([0-9]+)/?$', 1) AS page FROM ({URLS}))
""")
def url_base_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls(spark, sf_dir).select("page_id", url.base_location_url(F.col("u")).alias("base_url"), url.page_number(F.col("u")).alias("page_no"))


@query(f"""
SELECT page_id, trim(regexp_replace(replace(CASE WHEN trim({PATH}, '/') = '' THEN 'home' ELSE trim({PATH}, '/') END, '/', '__'), '[^A-Za-z0-9._-]+', '_', 'g'), '_')
       || '--' || substr(sha1({NORMAL}), 1, 8) || '.html' AS slug
FROM ({URLS})
""")
def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls(spark, sf_dir).select("page_id", url.safe_slug(F.col("u")).alias("slug"))


ROUTES = ", ".join(f"'{r}'" for r in url.NON_PROFILE_ROUTES)
SEGMENTS = f"list_filter(string_split({PATH}, '/'), lambda x: x <> '')"


@query(f"""
WITH s AS (SELECT page_id, {SEGMENTS} AS seg, lower({HOST}) AS host FROM ({URLS})),
t AS (SELECT *, len(seg) AS n, coalesce(seg[1], '') AS a, coalesce(seg[2], '') AS b, coalesce(seg[3], '') AS c FROM s),
p AS (SELECT *, (n = 2 AND host IN ('m.example.org', 'www.example.org', 'example.org') AND NOT regexp_matches(b, '-[0-9]+pm$', 'i') AND lower(a) NOT IN ({ROUTES})) AS is_profile FROM t)
SELECT page_id, CASE WHEN n = 1 AND a = 'specialty' THEN 'specialty_index' WHEN is_profile THEN 'profile' WHEN n = 1 THEN 'specialty_landing'
            WHEN (n = 2 OR n = 3 AND regexp_matches(c, '^[0-9]+$')) AND regexp_matches(b, '-[0-9]+pm$') THEN 'listing' ELSE 'unsupported' END AS page_type
FROM p
""")
def url_page_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = url.Site(hosts=("m.example.org", "www.example.org", "example.org"))
    return urls(spark, sf_dir).select("page_id", url.page_type(F.col("u"), site).alias("page_type"))


@query(f"SELECT page_id, regexp_extract(u, '-([0-9]+)$', 1) AS trailing_id FROM ({URLS})")
def url_trailing_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls(spark, sf_dir).select("page_id", url.trailing_id(F.col("u")).alias("trailing_id"))


@query("""
SELECT page_id, '/p/' || CAST(page_id AS VARCHAR) AS link,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/p/' || CAST(page_id AS VARCHAR) AS target,
       regexp_extract(url, '^([a-z]+)', 1) || '://cdn.example.net/x' AS other_host, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/b/c' || page_id AS climbed,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || coalesce(nullif(regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), '[^/]*/$', ''), ''), '/') || 'd' AS sibling
FROM pages
""")
def url_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.concat(F.lit("/p/"), F.col("page_id").cast("string"))
    pages = read(spark, sf_dir, "pages")
    return pages.select(
        "page_id", link.alias("link"), url.absolute_url(F.concat(link, F.lit("/?q=1#f")), F.col("url")).alias("target"), url.absolute_url(F.lit("//cdn.example.net/x/"), F.col("url")).alias("other_host"),
        url.absolute_url(F.concat(F.lit("/a/../../b/./x/../c"), F.col("page_id").cast("string"), F.lit("/?q=../..")), F.col("url")).alias("climbed"), url.absolute_url(F.lit("./.././e/../d"), F.col("url")).alias("sibling"))


@query("""
SELECT flag, count(*) AS n, count(value) AS n_known, count(*) FILTER (value) AS n_true FROM (
  SELECT l_returnflag AS flag, CASE lower(trim(CASE l_returnflag WHEN 'A' THEN ' YES ' WHEN 'N' THEN 'n' ELSE 'maybe' END)) WHEN 'yes' THEN true WHEN 'n' THEN false END AS value FROM lineitem
  UNION ALL SELECT 'q' || CAST(quality AS VARCHAR), quality = 1 FROM labels)
GROUP BY flag
""")
def tri_state_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("l_returnflag") == "A", " YES ").when(F.col("l_returnflag") == "N", "n").otherwise("maybe")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), values.tri_bool(said).alias("value"))
    labels = read(spark, sf_dir, "labels").select(F.concat(F.lit("q"), F.col("quality").cast("string")).alias("flag"), values.tri_number(F.col("quality")).alias("value"))
    return lines.unionByName(labels).groupBy("flag").agg(F.count("*").alias("n"), F.count("value").alias("n_known"), F.count_if("value").alias("n_true"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN true WHEN c_custkey % 5 = 1 THEN false END AS wide, CASE WHEN c_custkey % 5 IN (0) THEN true END AS narrow
FROM customer
""")
def export_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    said = F.when(k == 0, "Yes").when(k == 1, "N").when(k == 2, "1.0").when(k == 3, "").otherwise(F.lit(None))
    return read(spark, sf_dir, "customer").select("c_custkey", values.tri_bool(said).alias("wide"), values.export_bool(said).alias("narrow"))


@query("""
SELECT s_suppkey, coalesce(nullif(CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE NULL END, ''), nullif(CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END, ''), nullif(CAST(s_suppkey * 0 AS VARCHAR), ''), '') AS first_value FROM supplier
""")
def first_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    first = values.first_nonempty(F.when(k % 3 == 0, ""), F.when(k % 2 == 0, F.col("s_name")).otherwise(""), k * 0)
    return read(spark, sf_dir, "supplier").select("s_suppkey", first.alias("first_value"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\x{85}\p{Z}\x1c-\x1f]+', ' ', 'g')) AS collapsed FROM documents")
def text_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", values.collapse(F.col("text")).alias("collapsed"))


@query("""
WITH n AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Dr. ' WHEN 1 THEN 'mrs.  ' ELSE '' END || replace(c_name, '#', ' ') || CASE WHEN c_custkey % 3 = 0 THEN ', MD, PhD' ELSE '' END AS full_name FROM customer),
r AS (SELECT *, regexp_extract(full_name, '^(?i)(Dr\\.|Mr\\.|Ms\\.|Mrs\\.)\\s+', 1) AS prenominal, regexp_replace(full_name, '^(?i)(Dr\\.|Mr\\.|Ms\\.|Mrs\\.)\\s+', '') AS rest FROM n),
t AS (SELECT *, list_filter(string_split(trim(split_part(rest, ',', 1)), ' '), lambda x: x <> '') AS tok FROM r)
SELECT c_custkey, prenominal, tok[1] AS first_name, CASE WHEN len(tok) > 1 THEN tok[len(tok)] ELSE '' END AS last_name,
       CASE WHEN contains(rest, ',') THEN trim(substr(rest, strpos(rest, ',') + 1)) ELSE '' END AS postnominal FROM t
""".replace("\\\\", "\\"))
def name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    full = F.concat(F.when(k % 4 == 0, "Dr. ").when(k % 4 == 1, "mrs.  ").otherwise(""), F.regexp_replace("c_name", "#", " "), F.when(k % 3 == 0, ", MD, PhD").otherwise(""))
    return read(spark, sf_dir, "customer").select("c_custkey", values.split_name(full).alias("s")).select("c_custkey", "s.prenominal", "s.first_name", "s.last_name", "s.postnominal")


@query("SELECT s_suppkey, 'Dr. ' || s_name || CASE WHEN s_suppkey % 2 = 0 THEN ', DDS' ELSE '' END AS full_name, CASE WHEN s_suppkey % 2 = 0 THEN 'https://img.example.org/a' ELSE 'http://img.example.org/a' END AS photo FROM supplier")
def name_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("s_suppkey") % 2 == 0
    photo = F.when(even, "//img.example.org/a").otherwise(" http://img.example.org/a ")
    return read(spark, sf_dir, "supplier").select("s_suppkey", values.assemble_name(F.lit("Dr."), F.col("s_name"), F.when(even, ", DDS")).alias("full_name"), values.photo_url(photo).alias("photo"))


@query("""
SELECT p_partkey, CASE WHEN regexp_matches(lower(label), 'facility|facilities|clinic|clinics|urgent care') THEN 'facility_or_clinic' ELSE 'provider_specialty' END AS entity_type,
       lower(trim(label, ' .,;:')) AS specialty
FROM (SELECT p_partkey, p_brand || CASE p_partkey % 4 WHEN 0 THEN ' Clinics.' WHEN 1 THEN ' URGENT CARE,' ELSE ' ;' END AS label FROM part)
""")
def category_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    label = F.concat("p_brand", F.when(k == 0, " Clinics.").when(k == 1, "  URGENT  CARE,").otherwise(" ;"))
    return read(spark, sf_dir, "part").select("p_partkey", values.entity_type(label).alias("entity_type"), values.normalize_specialty(label).alias("specialty"))


ZIPS = "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN CAST(c_custkey AS VARCHAR) || '.0' WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '1') || '-1234' WHEN 2 THEN CAST(c_custkey % 1000 AS VARCHAR) WHEN 3 THEN 'Springfield XY ' || lpad(CAST(c_custkey AS VARCHAR), 5, '7') WHEN 4 THEN '00000' ELSE '1234567' END AS z FROM customer"


@query(f"""
WITH r AS (SELECT c_custkey, regexp_replace(trim(z), '^([0-9]+)\\.0+$', '\\1') AS z FROM ({ZIPS}))
SELECT c_custkey, nullif(CASE WHEN regexp_matches(z, '^[0-9]{{1,5}}$') THEN lpad(z, 5, '0') ELSE nullif(regexp_extract(z, '(^|[^0-9])([0-9]{{5}})(-[0-9]{{4}})?([^0-9]|$)', 2), '') END, '00000') AS zip FROM r
""")
def zip_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("c_custkey"), F.col("c_custkey").cast("string")
    z = F.when(k % 6 == 0, F.concat(t, F.lit(".0"))).when(k % 6 == 1, F.concat(F.lpad(t, 5, "1"), F.lit("-1234"))).when(k % 6 == 2, (k % 1000).cast("string"))
    z = z.when(k % 6 == 3, F.concat(F.lit("Springfield XY "), F.lpad(t, 5, "7"))).when(k % 6 == 4, "00000").otherwise("1234567")
    return read(spark, sf_dir, "customer").select("c_custkey", values.normalize_zip(z).alias("zip"))


@query("SELECT n_nationkey, CASE WHEN regexp_matches(upper(trim(s)), '^[A-Z]{2}$') THEN upper(trim(s)) END AS state FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN ' ' || lower(substr(n_name, 1, 2)) || ' ' WHEN n_nationkey % 3 = 1 THEN n_name ELSE '1A' END AS s FROM nation)")
def state_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 3
    s = F.when(k == 0, F.concat(F.lit(" "), F.lower(F.substring("n_name", 1, 2)), F.lit(" "))).when(k == 1, F.col("n_name")).otherwise("1A")
    return read(spark, sf_dir, "nation").select("n_nationkey", values.normalize_state(s).alias("state"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""
SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: list_position(w, p[1]) = p[2]), lambda p: p[1]), ' ') AS names
FROM (SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents)
""")
def array_distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z]+", " "), " ")
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(values.distinct_texts(words), " ").alias("names"))


@query("SELECT o_custkey, sha256(string_agg(DISTINCT CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY CAST(o_orderkey AS VARCHAR))) AS fingerprint FROM orders GROUP BY o_custkey")
def set_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(measures.set_fingerprint(F.col("o_orderkey").cast("string")).alias("fingerprint"))


@query("""
SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_partkey":' || CAST(p_partkey AS VARCHAR) || ',"p_size":' || CAST(p_size AS VARCHAR) || '}') AS fingerprint FROM part
""")
def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", measures.row_fingerprint("p_partkey", "p_size", "p_brand").alias("fingerprint"))


@query("""
SELECT event_id, floor(CAST(greatest(0, epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts)) AS DOUBLE) / 86400000000.0) AS age, ts < TIMESTAMP '2024-03-01' - INTERVAL 30 DAY AS stale FROM events
""")
def age_days_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, t = F.lit("2024-03-01 00:00:00").cast("timestamp"), F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select("event_id", F.floor(measures.age_days(t, F.lit(None).cast("timestamp"), now)).cast("double").alias("age"), measures.is_stale(t, now, 30 * 24 * 60).alias("stale"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE epoch(date_trunc('second', ts))::BIGINT END AS seconds FROM events")
def iso_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    said = F.when(k == 0, iso).when(k == 1, F.concat(iso, F.lit("+00:00"))).otherwise("yesterday")
    return read(spark, sf_dir, "events").select("event_id", F.unix_seconds(measures.parse_timestamp(said)).alias("seconds"))
