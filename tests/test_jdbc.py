"""Databases: merges in one transaction, reads by ranges; an embedded database in the driver's memory stands for any."""

import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.sources import jdbc

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def db():
    return jdbc.Database(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true")


def people(spark, *rows):
    return spark.createDataFrame(rows, "doctor_url string, name string, first_seen_at timestamp_ntz, n int")


def at(day):
    import datetime

    return datetime.datetime(2024, 1, day)


def found(spark, db, name):
    return sorted(map(tuple, jdbc.read_table(spark, db, name).collect()))


def test_statements():
    pg = jdbc.Database("jdbc:postgresql://h/d")
    assert jdbc.merge_sql(pg, "t", ["k", "first_seen_at", "n"], ["k"]) == (
        'INSERT INTO "t" AS t ("k", "first_seen_at", "n") SELECT "k", "first_seen_at", "n" FROM "staging_t" ON CONFLICT ("k") DO UPDATE SET "first_seen_at" = LEAST(t."first_seen_at", EXCLUDED."first_seen_at"), "n" = EXCLUDED."n"'
    )
    assert jdbc.merge_sql(pg, "events", ["k", "n"], ["k"]).endswith("DO NOTHING")
    other = jdbc.merge_sql(jdbc.Database("jdbc:derby:x"), "events", ["k", "n"], ["k"])
    assert "WHEN MATCHED" not in other and other.endswith('VALUES (s."k", s."n")')
    assert jdbc.quoted('a"b') == '"a""b"'


def test_publications_merge_by_key(spark, db):
    jdbc.publish({"people": (people(spark, ("a", "A", at(5), 1), ("b", None, None, 2)), ["doctor_url"])}, db)
    second = people(spark, ("a", "B", at(9), 3), ("b", "x", at(1), 4), ("c", 'quote " and, é', at(2), 5), (None, "no key", at(1), 6))
    jdbc.publish({"people": (second, ["doctor_url"])}, db)
    assert found(spark, db, "people") == [("a", "B", at(5), 3), ("b", "x", at(1), 4), ("c", 'quote " and, é', at(2), 5)]
    jdbc.publish({"people": (second, ["doctor_url"])}, db)  # again: nothing changes
    assert len(found(spark, db, "people")) == 3


def test_events_are_only_added(spark, db):
    rows = lambda *r: spark.createDataFrame(r, "event_key string, kind string")
    jdbc.publish({"events": (rows(("u:1", "added")), ["event_key"])}, db)
    jdbc.publish({"events": (rows(("u:1", "changed"), ("u:2", "removed")), ["event_key"])}, db)
    assert found(spark, db, "events") == [("u:1", "added"), ("u:2", "removed")]


def test_a_failure_takes_everything_back(spark, db):
    """The second table's rows break its key, so the first one's merge is undone as well."""
    good, key = people(spark, ("a", "A", at(5), 1)), ["doctor_url"]
    jdbc.publish({"first": (good, key), "second": (good, key)}, db)
    twice = people(spark, ("z", "Z", at(1), 1), ("z", "Z", at(1), 2))
    with pytest.raises(Exception, match="(?i)duplicate"):
        jdbc.publish({"first": (people(spark, ("a", "changed", at(1), 9)), key), "second": (twice, key)}, db)
    assert found(spark, db, "first") == found(spark, db, "second") == [("a", "A", at(5), 1)]
    jdbc.publish({"first": (people(spark, ("a", "changed", at(1), 9)), key), "second": (good, key)}, db)
    assert found(spark, db, "first") == [("a", "changed", at(1), 9)]


def test_a_transaction_that_breaks_leaves_nothing(spark, db):
    jdbc.write_table(spark.range(3).toDF("k"), db, "t")
    with pytest.raises(RuntimeError), jdbc.transaction(spark, db) as statement:
        statement.execute('DELETE FROM "t"')
        raise RuntimeError
    assert jdbc.read_table(spark, db, "t").count() == 3 and "t" in jdbc.tables(spark, db)


def test_ranges_of_a_key_are_read_in_parallel(spark, db, capsys):
    jdbc.write_table(spark.range(-50, 950).selectExpr("id AS k", "pmod(id, 7) AS v"), db, "t", batch=100)
    got = jdbc.read_table(spark, db, "t", "k", tasks=5)
    assert got.rdd.getNumPartitions() == 5 and got.count() == 1000 and got.select(F.sum("v")).first()[0] == sum(k % 7 for k in range(-50, 950))
    got.filter("v = 3").select("k").explain("formatted")
    shown = capsys.readouterr().out
    assert "PushedFilters" in shown and "EqualTo(v,3)" in shown
    jdbc.write_table(spark.range(0).toDF("k"), db, "none")
    assert jdbc.read_table(spark, db, "none", "k").count() == 0


def test_files_carry_what_connections_carry(spark, db, monkeypatch):
    """An embedded database and executors of other processes: rows go by files, whatever they hold."""
    monkeypatch.setattr(jdbc.Database, "apart", lambda *_: True)
    rows = [("", 'a "b", c\nd\\', at(1), -5), ("é ", "", None, None), (" x", None, at(2), 7), ("z", ",", at(3), 2**31 - 1)]
    jdbc.publish({"people": (people(spark, *rows), ["doctor_url"])}, db, tasks=2)
    jdbc.publish({"people": (people(spark, ("z", "'", at(2), 1)), ["doctor_url"])}, db)
    expected = [*rows[:3], ("z", "'", at(2), 1)]
    assert set(map(tuple, jdbc.read_table(spark, db, "people").collect())) == set(expected)
    assert set(map(tuple, jdbc.read_table(spark, db, "people", "n", tasks=3).collect())) == set(expected)
    assert [r.n for r in jdbc.read_table(spark, db, "people", "n", where='"n" > 1').collect()] == [7]
    jdbc.write_table(spark.range(0).toDF("k"), db, "none")
    assert jdbc.read_table(spark, db, "none", "k").count() == 0


def test_round_trip_on_executors_of_their_own(tiny, tmp_path):
    """The query on a cluster of two processes beside the driver's."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "700m").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from millrace.plans import catalogue
got = catalogue.QUERIES["jdbc_round_trip"](spark, {tiny!r})
assert got.count() == spark.read.parquet("{tiny}/customer.parquet").count() > 0 and got.filter("name = 'new' AND k % 2 = 0 AND first_seen_at = least(k, 5)").count() == got.filter("k % 2 = 0").count() > 0
print("whole")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert done.stdout.strip().endswith("whole"), done.stderr[-2000:]
