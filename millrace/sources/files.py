"""Tabular and document files: readers with fixed schemas, writers, archives."""

from __future__ import annotations

import csv
import email
import email.policy
import hashlib
import io
import json
import posixpath
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schema
from millrace.functions import url as U
from millrace.functions import values as V
from millrace.session import ship


def filesystem(uri: str):
    """The pyarrow file system of a URI or plain path, and the path inside it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes | Iterable[bytes]) -> None:
    """A file, given whole or in portions, that appears whole or not at all."""
    fs, path = filesystem(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.partial"
    with fs.open_output_stream(part) as out:
        for portion in [data] if isinstance(data, bytes) else data:
            out.write(portion)
    fs.move(part, path)


def read_bytes(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


# ---- readers


def read_text_csv(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A CSV file with a header, all columns as text, blanks as empty text, a byte order mark dropped."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return df.na.fill("")


def seed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Seed locations as pages; rows without a URL are dropped."""
    df = read_text_csv(spark, path, ["url"]).filter(F.trim("url") != "")
    wanted = ["state_group", "location", "specialty_url", "specialty_name", "specialty_slug"]
    texts = [V.strip(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in wanted]
    address = F.col("url")
    return df.select(U.normalize_url(address).alias("url"), U.base_location_url(address).alias("base_location_url"), U.page_number(address).alias("page_no"), F.lit("seed").alias("source"), F.lit("pending").alias("status"), *texts).dropDuplicates(["url"])


def read_manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """Profile captures that manifests list: url and its files; unreadable files are skipped."""
    df = spark.read.option("header", True).option("ignoreCorruptFiles", True).csv(pattern)
    kept = df.filter((F.col("page_type") == "profile") & F.col("status").isin("saved", "existing") & (F.trim(V.text(F.col("file"))) != ""))
    return kept.groupBy(U.normalize_url(F.col("url")).alias("url")).agg(F.collect_set("file").alias("files"))


def read_metrics(spark: SparkSession, pattern: str, command: str | None = None) -> DataFrame:
    """Metrics rows with the file they came from and their place in it."""
    df = in_place(spark.read.option("header", True).csv(pattern), "seq")
    return df.filter(F.col("command") == command) if command else df


def in_place(df: DataFrame, place: str, file: str = "file") -> DataFrame:
    """Rows of text files with their file's name and their place in it, from 0, however the files were split and dealt out.

    Rows of one split come in order, so a row's place in it is known by itself; the splits before it are counted. df must
    read files and nothing else. A file's splits are few, so their running count is no work.
    """
    told = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias(file), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    splits = told.groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("_path").alias("_p"), F.col("_start").alias("_s"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = told.join(splits, (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s")))
    return placed.withColumn(place, F.col("_id") - F.col("_first") + F.col("_before")).drop("_path", "_start", "_id", "_p", "_s", "_first", "_before")


def latest_per_file(metrics: DataFrame) -> DataFrame:
    """The last row of each file."""
    return metrics.groupBy("file").agg(F.max_by(F.struct(*(c for c in metrics.columns if c != "file")), "seq").alias("r")).select("file", "r.*")


def read_runtime(spark: SparkSession, pattern: str, slug: str | None = None) -> DataFrame:
    """Rows of the runtime log: specialty_slug, seconds, processed; of one specialty if it is named."""
    df = spark.read.option("header", True).csv(pattern)
    out = df.select("specialty_slug", F.expr("try_cast(seconds AS double)").alias("seconds"), F.expr("try_cast(processed AS bigint)").alias("processed"))
    return out.filter(F.col("specialty_slug") == slug) if slug else out


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file of reviewed groups of URLs: one row an alias."""
    df = spark.read.option("multiLine", True).schema("group_id string, urls array<string>").json(path)
    return df.select("group_id", F.explode("urls").alias("doctor_url"))


def mhtml_html(data: bytes, location: str = "") -> str:
    """The HTML part of an MHTML file, the one at a location if there is one."""
    parts = [p for p in email.message_from_bytes(data, policy=email.policy.default).walk() if p.get_content_type() == "text/html"]
    chosen = next((p for p in parts if location and (p.get("Content-Location") or "").strip() == location), parts[0] if parts else None)
    return chosen.get_content() if chosen else ""


def read_mhtml(spark: SparkSession, pattern: str) -> DataFrame:
    """MHTML captures as file and html."""
    decode = F.udf(lambda b: mhtml_html(bytes(b)), T.StringType())
    return spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -1).alias("file"), decode("content").alias("html"))


def import_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of an older workspace's database, opened read-only on the driver; text throughout."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]
        if not names:
            raise ValueError(f"no table {table!r}")
        rows = [[None if v is None else str(v) for v in r] for r in db.execute(f'SELECT * FROM "{table}"')]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def legacy_captures(parts: list[DataFrame]) -> DataFrame:
    """Captures of several folders; of files with one name the first folder's stays."""
    from millrace.operators.merge import union_priority

    return union_priority(parts, ["file"])


# ---- writers


def as_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in order as text: nested values as JSON, null as empty."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))}
    return df.select(*(V.csv_value(F.col(c), c in nested).alias(c) for c in columns))


def write_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """A folder of CSV parts with a header each."""
    as_cells(df, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def csv_chunks(rows: Iterable[Iterable[str]], columns: list[str]) -> Iterator[bytes]:
    """A CSV file with a byte order mark, in portions of a thousand rows."""
    buffer = io.StringIO(newline="")
    writer = csv.writer(buffer)
    buffer.write("﻿")
    writer.writerow(columns)
    for n, row in enumerate(rows, 1):
        writer.writerow(row)
        if n % 1000 == 0:
            yield buffer.getvalue().encode()
            buffer.seek(0)
            buffer.truncate()
    yield buffer.getvalue().encode()


def csv_bytes(rows: Iterable[Iterable[str]], columns: list[str]) -> bytes:
    return b"".join(csv_chunks(rows, columns))


def write_single_csv(df: DataFrame, columns: list[str], uri: str) -> int:
    """One CSV file with a byte order mark, for people; rows stream through the driver in order."""
    n = 0

    def rows():
        nonlocal n
        for r in as_cells(df, columns).toLocalIterator():
            n += 1
            yield list(r)

    write_bytes(uri, csv_chunks(rows(), columns))
    return n


def write_pair(df: DataFrame, columns: list[str], folder: str, name: str) -> int:
    """A matching CSV and JSON pair, read back and compared row by row; returns the rows.

    Nested values are JSON text in CSV and stay nested in JSON; NaN is not allowed.
    """
    spark = df.sparkSession
    data, seen = df.select(*columns), Observation()
    numbers = [f.name for f in data.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    # what is written is counted as it is written
    written = data.observe(seen, F.count(F.lit(1)).alias("n"), *(F.count_if(F.isnan(c)).alias(c) for c in numbers))
    write_csv(written, columns, f"{folder}/{name}.csv")
    if bad := [c for c in numbers if seen.get[c]]:
        raise ValueError(f"{', '.join(bad)} holds NaN")
    data.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}.json")
    as_text = read_text_csv(spark, f"{folder}/{name}.csv").select(*columns)
    back = as_cells(spark.read.schema(data.schema).json(f"{folder}/{name}.json"), columns)
    # rows of both, counted and summed by two hashes, in whatever order
    mark = lambda rows: rows.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.sum(F.hash(*columns).cast("long")))
    sides = mark(as_text).unionAll(mark(back)).collect()
    if sides[0] != sides[1] or sides[0][0] != seen.get["n"]:
        raise ValueError(f"{name}: the two files differ")
    return sides[0][0]


def xlsx_bytes(sheets: dict[str, list[list[str | int | None]]]) -> bytes:
    """A workbook of sheets; text cells are marked as text, so ZIP codes keep their zeros."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"

    def letters(k: int) -> str:
        return (letters(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)

    def cell(r: int, c: int, v: str | int | None) -> str:
        at = f"{letters(c)}{r}"
        if v is None:
            return ""
        return f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{at}" s="1" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{links}<Relationship Id="s" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf numFmtId="49" applyNumberFormat="1"/></cellXfs></styleSheet>')
        for k, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def zip_bytes(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in sorted(files.items()):
            z.writestr(name, data)
    return out.getvalue()


def digest(uri: str) -> tuple[int, str]:
    """Size and SHA-256 of a file of any size, read in portions."""
    fs, path = filesystem(uri)
    h, n = hashlib.sha256(), 0
    with fs.open_input_stream(path) as f:
        while portion := f.read(1 << 20):
            h.update(portion)
            n += len(portion)
    return n, h.hexdigest()


def listed(folder: str) -> list[str]:
    """The files below a folder, as paths in it; names that begin with _ or . are left out."""
    from pyarrow.fs import FileSelector

    fs, path = filesystem(folder)
    found = fs.get_file_info(FileSelector(path, recursive=True, allow_not_found=True))
    return sorted(f.path[len(path) :].lstrip("/") for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def manifest(spark: SparkSession, folder: str, **counts: int) -> bytes:
    """Names, sizes and SHA-256 of a folder's files, or of one file, with summary counts, as JSON. Files are read by the tasks, in portions."""
    ship(spark)
    fs, path = filesystem(folder.rstrip("/"))
    single = fs.get_file_info(path).is_file
    uri, names = (posixpath.dirname(folder), [posixpath.basename(path)]) if single else (folder.rstrip("/"), listed(folder))
    sizes = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, min(len(names), 64))).mapInArrow(lambda b: _digests(b, uri), "name string, length long, sha256 string").orderBy("name").collect()
    return json.dumps({"files": [r.asDict() for r in sizes], "summary": counts}, sort_keys=True, indent=1).encode()


def _digests(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        got = [digest(f"{folder}/{n}") for n in names]
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "length": pa.array([g[0] for g in got], pa.int64()), "sha256": pa.array([g[1] for g in got], pa.string())})


def write_zip(folder: str, uri: str) -> list[str]:
    """A ZIP archive of a folder's files, in order, written in portions; returns their names. A closed archive appears whole."""
    fs, path = filesystem(uri)
    part = f"{path}.{uuid.uuid4().hex}.partial"
    names = listed(folder)
    with fs.open_output_stream(part) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, allowZip64=True) as z:
        for n in names:
            source, inner = filesystem(f"{folder.rstrip('/')}/{n}")
            with source.open_input_stream(inner) as f, z.open(zipfile.ZipInfo(n), "w", force_zip64=True) as member:
                while portion := f.read(1 << 20):
                    member.write(portion)
    fs.move(part, path)
    return names


def append_upgraded(spark: SparkSession, uri: str, columns: list[str], rows: list[list[str]]) -> None:
    """Append to a small CSV log whose header may be older: as long rows keep their places, shorter ones are filled up."""
    fs, path = filesystem(uri)
    kept: list[list[str]] = []
    if fs.get_file_info(path).is_file:
        kept = list(csv.reader(io.StringIO(read_bytes(uri).decode("utf-8-sig"), newline="")))[1:]
    fit = [(r + [""] * len(columns))[: len(columns)] for r in kept]
    write_bytes(uri, csv_bytes([*fit, *rows], columns))


def declared(df: DataFrame, name: str) -> DataFrame:
    """df under a state table's declared schema: known columns cast, missing ones null, others kept at the end."""
    want = schema.STATE_TABLES[name]
    have = set(df.columns)
    known = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields]
    return df.select(*known, *(c for c in df.columns if c not in want.names))
