"""Sources, sinks, the table store and streams."""

import csv
import io
import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import captures, files
from millrace.sources.store import Append, Conflict, Lease, TableStore, create, first_write, rename_new
from millrace.streaming import ingest


def test_store_versions_and_conflicts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.version("t") == 0
    store.write("t", spark.range(3).toDF("id"))
    pinned = store.pinned("t")["t"]
    store.append("t", spark.range(2).toDF("id").withColumn("new", F.lit("x")))
    assert pinned.count() == 3 and store.read("t").count() == 5 and store.read("t", 1).count() == 3 and "new" in store.read("t").columns
    with pytest.raises(Conflict):
        store.write("t", spark.range(1).toDF("id"), expected=1)
    assert store.version("t") == 2
    with pytest.raises(KeyError):
        store.read("t", 9)


def test_commits_change_tables_together(spark, tmp_path, monkeypatch):
    store, other = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    one = spark.range(1).toDF("id")
    assert store.commit({"a": one, "b": one}) == 1 and store.commit({"a": Append(one), "b": one.filter("false")}) == 2
    assert store.read("a").count() == 2 and store.read("b").count() == 0 and store.read("b", 1).count() == 1
    # two writers who saw the same commit: the second gets a conflict, and nothing of its tables shows
    monkeypatch.setattr(other, "commit_number", lambda: 2)
    store.write("a", one)
    with pytest.raises(Conflict):
        other.commit({"a": one.filter("false"), "b": one})
    assert store.commit_number() == 3 and store.read("a").count() == 1 and store.read("b").count() == 0
    assert store.restore(1) == 4 and store.read("b").count() == 1
    assert len(store.vacuum(keep=1)) == 3 and store.read("a").count() == 1
    # an append writes its own rows only, until there are too many folders
    before = store.state()["a"]["parts"]
    store.append("a", one)
    assert store.state()["a"]["parts"][:-1] == before
    monkeypatch.setattr("millrace.sources.store.MOST_PARTS", 2)
    store.append("a", one)
    assert len(store.state()["a"]["parts"]) == 1 and store.read("a").count() == 3


def test_first_write_wins(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    merge = first_write(store, "t", ["k"], ["v"])
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    for batch in (rows((1, "a"), (2, "b")), rows((1, "a"), (2, "b")), rows((2, "late"), (3, "c"), (3, "c"))):
        merge(batch, 0)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_file_is_created_once(tmp_path):
    uri = str(tmp_path / "x" / "f")
    assert create(uri, b"1") and not create(uri, b"2") and open(uri, "rb").read() == b"1" and len(list((tmp_path / "x").iterdir())) == 1


def test_a_rename_does_not_overwrite(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text(name)
    to = f"file://{tmp_path}/c"
    assert rename_new(spark, f"file://{tmp_path}/a", to) and not rename_new(spark, f"file://{tmp_path}/b", to)
    assert (tmp_path / "c").read_text() == "a" and (tmp_path / "b").exists()


def test_lease_keeps_a_second_writer_out(tmp_path):
    with Lease(str(tmp_path)):
        with pytest.raises(Conflict), Lease(str(tmp_path)):
            pass
    with Lease(str(tmp_path), seconds=-1):
        with Lease(str(tmp_path)):
            pass


def test_seed_csv_with_mark_and_blanks(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿url,state_group\nhttps://www.example.org/a/b-1pm/2,XY\n ,zz\n")
    got = files.seed_pages(spark, str(tmp_path / "s.csv")).collect()
    assert [(r.url, r.base_location_url, r.page_no, r.state_group, r.location) for r in got] == [("https://www.example.org/a/b-1pm/2", "https://www.example.org/a/b-1pm", 2, "XY", "")]
    (tmp_path / "bad.csv").write_text("link\nx\n")
    with pytest.raises(ValueError):
        files.seed_pages(spark, str(tmp_path / "bad.csv"))


def test_pair_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([("007", None, ["a", "b"], 1.5), ('q"u,o\nte', "", [], None)], "zip string, t string, l array<string>, d double")
    assert files.write_pair(df, ["zip", "t", "l", "d"], str(tmp_path), "rows") == 2
    back = spark.read.schema("zip string, l array<string>").json(str(tmp_path / "rows.json")).collect()
    assert {tuple(r.l) for r in back} == {("a", "b"), ()}
    with pytest.raises(ValueError):
        files.write_pair(df.withColumn("d", F.lit(float("nan"))), ["d"], str(tmp_path), "nan")


def test_single_csv_workbook_and_archive(spark, tmp_path):
    df = spark.createDataFrame([("00501", True), (None, None)], "zip string, b boolean")
    uri = str(tmp_path / "one.csv")
    assert files.write_single_csv(df, ["zip", "b"], uri) == 2
    assert list(csv.reader(io.StringIO((tmp_path / "one.csv").read_bytes().decode("utf-8-sig")))) == [["zip", "b"], ["00501", "true"], ["", ""]]
    book = zipfile.ZipFile(io.BytesIO(files.xlsx_bytes({"Wide": [["XY"], ["00501", None]], "Counts": [["XY", 3]]})))
    assert '<t xml:space="preserve">00501</t>' in book.read("xl/worksheets/sheet1.xml").decode() and "<v>3</v>" in book.read("xl/worksheets/sheet2.xml").decode()
    assert zipfile.ZipFile(io.BytesIO(files.zip_bytes({"a": b"1"}))).read("a") == b"1"
    listed = json.loads(files.manifest(spark, str(tmp_path / "one.csv"), rows=2))
    assert listed["summary"] == {"rows": 2} and listed["files"][0]["sha256"] == files.digest(uri)[1]


def test_log_header_is_upgraded(spark, tmp_path):
    log = tmp_path / "m.csv"
    log.write_text("a,b\n1,2\n3\n")
    files.append_upgraded(spark, str(log), ["a", "b", "c"], [["4", "5", "6"]])
    assert list(csv.reader(io.StringIO(log.read_bytes().decode("utf-8-sig")))) == [["a", "b", "c"], ["1", "2", ""], ["3", "", ""], ["4", "5", "6"]]


def test_metrics_and_manifests(spark, tmp_path):
    (tmp_path / "manifest-1.csv").write_text("status,page_type,url,file\nsaved,profile,https://www.example.org/d/x/,f1\nfailed,profile,https://www.example.org/d/y,f2\nexisting,profile,https://www.example.org/d/x,f3\n")
    got = files.read_manifests(spark, str(tmp_path / "manifest*.csv")).collect()
    assert [(r.url, sorted(r.files)) for r in got] == [("https://www.example.org/d/x", ["f1", "f3"])]
    (tmp_path / "r1.csv").write_text("command,rate\na,1\na,2\nb,9\n")
    assert [r.rate for r in files.latest_per_file(files.read_metrics(spark, str(tmp_path / "r1.csv"), "a")).collect()] == ["2"]


def test_old_database_and_mhtml(spark, tmp_path):
    with sqlite3.connect(tmp_path / "old.db") as db:
        db.execute("CREATE TABLE pages (url TEXT, n INTEGER)")
        db.execute("INSERT INTO pages VALUES ('u', 3)")
    assert [tuple(r) for r in files.import_sqlite(spark, str(tmp_path / "old.db"), "pages").collect()] == [("u", "3")]
    (tmp_path / "x.mhtml").write_text('MIME-Version: 1.0\nContent-Type: multipart/related; boundary="B"\n\n--B\nContent-Type: text/css\n\np{}\n--B\nContent-Type: text/html; charset=utf-8\nContent-Location: https://www.example.org/\n\n<p>hi</p>\n--B--\n')
    assert [(r.file, r.html.strip()) for r in files.read_mhtml(spark, str(tmp_path / "*.mhtml")).collect()] == [("x.mhtml", "<p>hi</p>")]


def test_captures_are_ingested_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.html").write_text("<p>a</p>")

    def merge(batch, _):
        store.append("captures", batch.drop("captured_at"))

    for _ in range(2):
        ingest.ingest(spark, str(folder), str(tmp_path / "cp"), merge).awaitTermination()
    (folder / "b.html").write_text("<p>b</p>")
    ingest.ingest(spark, str(folder), str(tmp_path / "cp"), merge).awaitTermination()
    assert sorted(r.file for r in store.read("captures").collect()) == ["a.html", "b.html"]
    assert captures.read_captures(spark, str(folder), "profile").filter("page_type = 'profile'").count() == 2


def test_declared_schema_fills_and_keeps(spark):
    df = files.declared(spark.createDataFrame([("u", "2", "x")], "url string, page_no string, extra string"), "pages")
    assert df.columns[-1] == "extra" and df.first().page_no == 2 and df.first().status is None


def test_rows_know_their_place_in_a_split_file(spark, tmp_path):
    """Two files, each in many splits, several of them in a task; the last row is the last one."""
    for name, n in (("a", 4000), ("b", 2500)):
        (tmp_path / f"{name}.csv").write_text("v,w\n" + "".join(f"{k},{'x' * (k % 50)}\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = files.in_place(spark.read.option("header", True).csv(str(tmp_path / "*.csv")), "seq")
        rows = df.withColumn("split", F.spark_partition_id()).collect()
        last = files.latest_per_file(files.read_metrics(spark, str(tmp_path / "*.csv"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 6500 and all(int(r.v) == r.seq for r in rows) and {r.file for r in rows} == {"a.csv", "b.csv"}
    assert {(r.file, r.v) for r in last} == {("a.csv", "3999"), ("b.csv", "2499")}


def test_names_are_looked_up_in_few_row_groups(spark, tmp_path):
    """The rows that a scan hands on are those of the groups that can hold the name; a name that isn't there reads none."""
    held = spark.range(60_000).select(F.concat(F.lit("page-"), F.sha2(F.col("id").cast("string"), 256), F.lit(".html")).alias("file"), F.col("id").alias("k"))
    captures.write_index(held, str(tmp_path / "i"), 6)
    one = held.filter("k = 77").first().file

    def scanned(names):
        df = captures.looked_up(spark, str(tmp_path / "i"), names)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return rows, leaf.metrics().get("numOutputRows").get().value(), plan

    rows, n, plan = scanned([one])
    assert [r.k for r in rows] == [77] and 0 < n <= 20_000 and "PushedFilters: [IsNotNull(file), EqualTo(file" in plan
    rows, n, _ = scanned(["page-" + "0" * 64 + ".html"])
    assert rows == [] and n == 0
    assert {r.k for r in scanned([one, held.filter("k = 59999").first().file])[0]} == {77, 59999}
