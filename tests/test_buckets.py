"""Bucketed tables: only what a batch meets is read and written, and interrupted changes are finished."""

import os
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.operators.buckets import BUCKET, PENDING, BucketedTable, bucket_of

RULES = {"name": "overwrite_if_nonblank", "seen": "least"}


def files(path):
    """bucket -> its files and when they were written."""
    out = {}
    for folder, _, names in os.walk(path):
        if PENDING not in folder and f"{BUCKET}=" in folder:
            out[int(folder.rsplit("=", 1)[1])] = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
    return out


@pytest.fixture
def table(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), ["k"], 16)
    t.create(spark.range(500).selectExpr("id AS k", "concat('n', id) AS name", "id % 7 AS seen"))
    return t


def rows(df):
    return sorted(map(tuple, df.select("k", "name", "seen").collect()), key=str)


def batch(spark, *given):
    return spark.createDataFrame(given, "k long, name string, seen long")


def test_upsert_equals_a_merge_of_whole_tables(spark, table):
    new = batch(spark, (3, "x", 9), (4, " ", 0), (999, "y", 1), (None, "null", 2))
    want = rows(merge.merge(table.read(), new, ["k"], RULES))
    table.upsert(new, RULES)
    assert rows(table.read()) == want and len(want) == 502


def test_untouched_buckets_keep_their_files(spark, table):
    before, new = files(table.path), batch(spark, (3, "x", 9), (77, "z", 0))
    met = table.touched(new)
    assert table.upsert(new, RULES) == met and len(met) <= 2
    after = files(table.path)
    assert {b for b in before if before[b] != after[b]} == set(met) and set(before) == set(after)


def test_the_plan_prunes_to_touched_buckets(spark, table, capsys):
    table.read(table.touched(batch(spark, (3, "x", 9)))).explain("formatted")
    shown = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[.*_bucket", shown)
    found = table.read([5]).select(F.input_file_name().alias("f")).distinct().collect()
    assert found and all(f"{BUCKET}=5/" in r.f for r in found)
    assert rows(table.lookup(batch(spark, (3, "", 0), (4, "", 0), (9999, "", 0)))) == [(3, "n3", 3), (4, "n4", 4)]


def test_a_batch_that_changes_nothing_writes_nothing(spark, table):
    before = files(table.path)
    assert table.upsert(batch(spark, (3, " ", 100)), RULES) == [] and table.insert_missing(batch(spark, (5, "other", 0))) == []
    assert files(table.path) == before and table.upsert(batch(spark), RULES) == []


def test_deleting_a_whole_bucket(spark, table):
    b = table.touched(batch(spark, (3, "", 0)))[0]
    mine = table.read([b]).select("k").collect()
    assert table.delete(spark.createDataFrame(mine, "k long")) == [b]
    assert b not in files(table.path) and table.read().count() == 500 - len(mine) and table.read([b]).count() == 0
    table.upsert(batch(spark, (3, "back", 1)), RULES)
    assert rows(table.read([b])) == [(3, "back", 1)]


def test_groups_are_replaced_in_their_buckets(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "g"), ["g"], 8)
    t.create(spark.range(100).selectExpr("id % 10 AS g", "id AS v"))
    t.replace_groups(spark.createDataFrame([(3, 1000), (3, 1000), (77, 1)], "g long, v long"))
    got = sorted(map(tuple, t.read().select("g", "v").collect()))
    assert got == sorted([(k % 10, k) for k in range(100) if k % 10 != 3] + [(3, 1000), (3, 1000), (77, 1)])


@pytest.mark.parametrize("broken", ["before", "between", "after"])
def test_an_interrupted_change_is_finished_or_forgotten(spark, table, monkeypatch, broken):
    """Stopped before the change is ready: as if it had not begun. After: the next reader sees it whole."""
    new = batch(spark, *((k, "x", 0) for k in range(40)))
    was, want = rows(table.read()), rows(merge.merge(table.read(), new, ["k"], RULES))

    class Lost(Exception):
        pass

    def lose(*_):
        raise Lost

    real = BucketedTable._finish

    def half(self, staged):
        # one bucket gone, as a commit that died half way leaves it
        self._drop(f"{self.path}/{BUCKET}={self.touched(new)[0]}")
        raise Lost

    if broken == "before":
        monkeypatch.setattr(BucketedTable, "_differing", lose)
    else:
        monkeypatch.setattr(BucketedTable, "_finish", half if broken == "between" else lambda self, staged: (real(self, staged), lose()))
    with pytest.raises(Lost):
        table.upsert(new, RULES)
    monkeypatch.undo()
    assert rows(table.read()) == (was if broken == "before" else want)
    assert not os.path.isdir(f"{table.path}/{PENDING}") or not os.listdir(f"{table.path}/{PENDING}")


def test_buckets_of_null_keys_and_several_columns(spark):
    got = spark.createDataFrame([(None, "a"), (1, None), (None, None)], "k long, s string").select(bucket_of(["k", "s"], 7).alias("b")).collect()
    assert all(0 <= r.b < 7 for r in got)
