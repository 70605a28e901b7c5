"""Captured pages as DataFrames, and parsers over them.

A capture is a row (url, html, ...). Parsers run in Python on Arrow batches, one document at a time;
project and filter before them and drop html after them. A page that can't be parsed becomes a row with
`error`; it never fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schema
from millrace.functions import url as U
from millrace.functions import values as V
from millrace.sources import pages

#: A catalog of fewer entries can't be whole.
CATALOG_LEAST = 10
LINK = schema.struct(place=T.IntegerType(), listed=T.BooleanType(), above=T.BooleanType(), **schema.texts("href", "name"))
HEADER = schema.struct(rank=T.IntegerType(), place=T.IntegerType(), text=T.StringType())
#: How listings state their count, strictest wording first.
COUNTS = [
    r"(?i)\b([0-9][0-9,]*)\s+verified\s+(.+?)\s+in\s+(.+?)\s*$",
    r"(?i)\b([0-9][0-9,]*)\s+verified\s+(.+?)\s+in\s+([A-Za-z0-9 .'\-]+,\s*[A-Z]{2})\b",
    r"(?i)\b([0-9][0-9,]*)\s+verified\s+(.+?)\s+in\s+(.+?)(?=\s+(?:Sort by|Book|Find|Search|Filter|Availability|Patients|All filters)\b|$)",
]


def read_captures(spark: SparkSession, folder: str, page_type: str | None = None) -> DataFrame:
    """Files of a folder as file, html, bytes, captured_at; one row a file."""
    df = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").text(folder)
    meta = F.col("_metadata")
    out = df.select(meta["file_name"].alias("file"), F.col("value").alias("html"), meta["file_size"].alias("bytes"), meta["file_modification_time"].alias("captured_at"))
    return out.withColumn("page_type", F.lit(page_type)) if page_type else out


def _cell(kind: T.DataType) -> Callable[[Any], Any]:
    return (lambda v: v) if not isinstance(kind, T.BinaryType) else bytes


def parsed(df: DataFrame, fn: Callable[[str, str], Any], kind: T.StructType, out: str, html: str = "html", url: str = "url") -> DataFrame:
    """df without its html, with `out` (a struct of a kind, or an array of them) and `error`."""
    from pyspark.sql.pandas.types import to_arrow_type

    many = T.ArrayType(kind)
    arrow = to_arrow_type(many)
    kept = [f for f in df.schema.fields if f.name not in (html, out, "error")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                column = lambda n, batch=batch: batch.column(batch.schema.get_field_index(n))
                results, errors = [], []
                for text, address in zip(column(html).to_pylist(), column(url).to_pylist()):
                    try:
                        got = fn(text or "", address or "")
                        results.append(got if isinstance(got, list) else [] if got is None else [got])
                        errors.append(None)
                    except Exception as x:  # a page must not stop the others
                        results.append([])
                        errors.append(f"{type(x).__name__}: {x}"[:500])
                yield pa.RecordBatch.from_arrays([*(column(f.name) for f in kept), pa.array(results, arrow), pa.array(errors, pa.string())], names=[*(f.name for f in kept), out, "error"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out, many), T.StructField("error", T.StringType())]))


def listings(df: DataFrame) -> DataFrame:
    """Listing captures with `doctors`, `pagination_urls`, `advertised_total` and what classifiers need."""
    both = T.StructType([*schema.LISTING.fields, *schema.SIGNALS.fields])
    out = parsed(df, lambda html, url: {**pages.listing(html, url), **pages.signals(html)}, both, "page")
    return out.withColumn("page", F.get("page", F.lit(0))).select(*(c for c in out.columns if c != "page"), "page.*")


def appearances(df: DataFrame) -> DataFrame:
    """A row for each provider that a listing shows."""
    out = parsed(df, lambda html, url: pages.occurrences(html, url), schema.APPEARANCE, "rows")
    return out.select(*(c for c in out.columns if c != "rows"), F.explode("rows").alias("r")).select(*(c for c in out.columns if c != "rows"), "r.*")


def trace_rows(df: DataFrame, file: str = "file") -> DataFrame:
    """The 29 trace columns; df: url, html and, where known, state_group, location, specialty_* and a file."""
    have = set(df.columns)
    meta = {
        "listing_url": U.normalize_url(F.col("url")),
        "listing_page_no": U.page_number(F.col("url")),
        "listing_file": F.col(file) if file in have else F.lit(""),
        **{f"listing_{c}": F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("") for c in ("state_group", "location", "specialty_url", "specialty_name", "specialty_slug")},
    }
    return appearances(df.select("url", "html", *(v.alias(k) for k, v in meta.items()))).select(*schema.TRACE_COLUMNS)


def profiles(df: DataFrame) -> DataFrame:
    """Profile captures with `profile`, null where the page could not be parsed."""
    return parsed(df, lambda html, url: pages.profile(html, url), schema.PROFILE, "profile").withColumn("profile", F.get("profile", F.lit(0)))


def profile_signals(df: DataFrame) -> DataFrame:
    return parsed(df, lambda html, _: pages.signals(html), schema.SIGNALS, "s").withColumn("s", F.get("s", F.lit(0)))


def catalog(df: DataFrame, least: int = CATALOG_LEAST) -> DataFrame:
    """Catalog entries; a page without the heading, or with fewer than `least` entries, gives one row with an error and no entry.

    Links of the first list under the heading, if it has enough of them, else all above the footer; of links to one
    address the first one's name stays.
    """
    out = parsed(df, lambda html, _: pages.catalog_links(html), LINK, "links")
    listed = F.filter("links", lambda x: x["listed"])
    chosen = F.when(F.size(listed) >= least, listed).otherwise(F.filter("links", lambda x: x["above"]))
    links = out.select("url", "error", F.explode_outer(chosen).alias("x")).select("url", "error", "x.place", V.collapse(F.col("x.name")).alias("name"), U.absolute_url(F.col("x.href"), F.col("url")).alias("to"))
    fits = (F.col("name") != "") & U.is_catalog_url(F.col("to"))
    entry = F.struct(F.col("name").alias("specialty_name"), U.specialty_slug(F.col("to")).alias("specialty_slug"), F.col("to").alias("specialty_url"), V.entity_type(F.col("name")).alias("entity_type"))
    firsts = links.groupBy("url", "error", F.when(fits, F.col("to")).alias("to")).agg(F.min_by(F.when(fits, entry), "place").alias("r"))
    n = F.count("to").over(Window.partitionBy("url"))
    error = F.coalesce("error", F.when(n < least, F.concat(F.lit("only "), n.cast("string"), F.lit(" catalog entries"))))
    told = firsts.withColumn("n", n).withColumn("error", error)
    # one row for a page that is refused, none for what isn't an entry elsewhere
    first = F.row_number().over(Window.partitionBy("url").orderBy(F.col("to").asc_nulls_first())) == 1
    told = told.withColumn("first", first).filter("error IS NULL AND to IS NOT NULL OR error IS NOT NULL AND first")
    return told.select("url", "error", F.when(F.col("error").isNull(), F.col("r")).alias("r")).select("url", "error", "r.*")


def landings(df: DataFrame) -> DataFrame:
    """Locations of landing pages, one a row."""
    out = parsed(df, lambda html, url: pages.landing(html, url), schema.LANDING, "page").withColumn("page", F.get("page", F.lit(0)))
    return out.select("url", "error", "page.*").select("url", "error", "specialty_url", "specialty_slug", "specialty_id", "procedure_id", "search_query", F.explode_outer("locations").alias("l")).select("*", "l.*").drop("l")


def verified_counts(df: DataFrame) -> DataFrame:
    """`N verified <specialty> in <location>`: of all matches that name both, the one of the likeliest place and strictest wording."""
    out = parsed(df, lambda html, _: pages.headers(html), HEADER, "said")

    def hits(said: Column) -> Column:
        group = lambda wording, k: F.regexp_extract(said["text"], wording, k)
        return F.array(*(F.struct(said["rank"], said["place"], F.lit(strict).alias("strict"), group(w, 1).alias("n"), V.normalize_specialty(group(w, 2)).alias("specialty"), V.normalize_location(group(w, 3)).alias("location")) for strict, w in enumerate(COUNTS)))

    named = F.filter(F.flatten(F.transform("said", hits)), lambda h: (h["specialty"] != "") & (h["location"] != ""))
    best = F.array_min(named)
    return out.withColumn("c", best).select(*(c for c in out.columns if c != "said"), "c.specialty", "c.location", F.regexp_replace("c.n", ",", "").cast("int").alias("count"))


# ---- finding captures


def write_index(captures: DataFrame, path: str, tasks: int = 32) -> None:
    """Captures as a table to look names up in: ranges of names, sorted, with a bloom filter for each row group.

    A name is then read from the one or two row groups that can hold it, instead of a listing of the whole folder.
    """
    options = {"parquet.bloom.filter.enabled#file": "true", "parquet.bloom.filter.expected.ndv#file": "100000", "parquet.block.size": str(16 << 20)}
    captures.repartitionByRange(tasks, "file").sortWithinPartitions("file").write.mode("overwrite").options(**options).parquet(path)


def looked_up(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The captures of a few names from an index: the filter reaches the files, whose footers and bloom filters skip the rest."""
    return spark.read.parquet(path).filter(F.col("file").isin(names) if len(names) > 1 else F.col("file") == names[0])


def listing_captures(pages_df: DataFrame, captures: DataFrame) -> DataFrame:
    """pages with the capture under their slug, where there is one."""
    return pages_df.withColumn("_slug", U.safe_slug(F.col("url"))).join(captures.withColumnRenamed("file", "_file"), F.col("_slug") == F.col("_file"), "left").drop("_slug").withColumnRenamed("_file", "file")


def newest_by_id(captures: DataFrame) -> DataFrame:
    """Per trailing provider id the newest file; of files of one time the last name."""
    keyed = captures.withColumn("_id", U.file_trailing_id(F.col("file"))).filter("_id <> ''")
    return keyed.groupBy("_id").agg(F.max_by("file", F.struct("captured_at", "file")).alias("file_by_id"))


def profile_captures(urls: DataFrame, captures: DataFrame, url: str = "doctor_url") -> DataFrame:
    """urls with `file`: the capture under the slug, else the newest one with the same trailing id."""
    exact = captures.select(F.col("file").alias("_file")).distinct()
    ids = newest_by_id(captures)
    out = urls.withColumn("_slug", U.safe_slug(F.col(url))).withColumn("_tail", F.nullif(U.trailing_id(U.normalize_url(F.col(url))), F.lit("")))
    out = out.join(exact, F.col("_slug") == F.col("_file"), "left").join(ids, F.col("_tail") == F.col("_id"), "left")
    return out.withColumn("file", F.coalesce("_file", "file_by_id")).drop("_slug", "_tail", "_file", "_id", "file_by_id")


def latest_capture(captures: DataFrame, prefix: str = "") -> DataFrame:
    """The newest capture whose name begins so."""
    return captures.filter(F.col("file").startswith(prefix)).orderBy(F.desc("captured_at"), F.desc("file")).limit(1)


def redirects(requested: DataFrame, captured: DataFrame) -> DataFrame:
    """Requested profile URLs with the one captured URL that they redirect to; ambiguous ones are left out.

    The pattern match becomes an equi-join on route and slug without its number.
    """
    left = requested.select(F.col("doctor_url").alias("requested")).withColumn("_k", U.canonical_key(F.col("requested")))
    right = captured.select(F.col("url").alias("canonical"), "file").distinct().withColumn("_c", U.canonical_key(F.col("canonical")))
    pairs = left.join(right, F.col("_k") == F.col("_c")).filter(U.is_canonical_redirect(F.col("requested"), F.col("canonical")))
    per = pairs.groupBy("requested").agg(F.count_distinct("canonical").alias("n"), F.count_distinct("file").alias("files"), F.min("canonical").alias("canonical"), F.min("file").alias("file"))
    return per.filter("n = 1 AND files = 1").select("requested", "canonical", "file")
