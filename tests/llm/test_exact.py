"""Streaming exact deduplication: growth, restarts, weak digests, odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact, queries
from millrace.session import scratch

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    """doc_id -> (keep_id, group_size, kept, sha) of (doc_id, text) pairs with numbers of their own."""
    groups = {}
    for n, t in rows:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), n))
    out = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        out |= {n: (keep, len(members), n == keep, hashlib.sha256(norm.encode()).hexdigest()) for _, n in members}
    return out


def result(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def add(spark, rows, path):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.mode("append").parquet(path)


def test_query_by_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    assert result(queries.op12_exact(spark, tiny)) == brute([tuple(r) for r in docs])


@pytest.mark.parametrize("bits", [256, 8])
def test_state_goes_on_over_runs(spark, bits):
    """A second run reads what is new only, meets the first one's state, and replaces kept rows by better ones. 8 bits: texts share digests."""
    chance, path, home = random.Random(bits), scratch(spark, "docs"), scratch(spark, "home")
    texts = [f"text {k}" for k in range(300)]
    rows = [(n, chance.choice(texts).replace(" ", " " * chance.randint(0, 4))) for n in range(800)]
    add(spark, rows[:500], path)
    schema = spark.read.parquet(path).schema
    for part in (rows[:500], rows):
        if part is rows:
            add(spark, rows[500:], path)
        exact.ingest(spark, path, schema, home, bits=bits)
        exact.ingest(spark, path, schema, home, bits=bits)  # nothing new
        assert result(exact.resolve(spark, path, schema, home, bits=bits)) == brute(part)
    batches = spark.read.parquet(f"{home}/changes")
    assert {r.batch for r in batches.select("batch").distinct().collect()} == {0, 1}
    second = batches.filter("batch = 1").select("digest").distinct().count()
    assert second < batches.select("digest").distinct().count() or bits == 8  # keys that didn't change aren't written again


def test_a_run_that_stopped_is_taken_up(spark):
    """The rows are printed, the state isn't there yet; then a batch of the state is written twice."""
    path, home, rows = scratch(spark, "docs"), scratch(spark, "home"), [(n, f"t{n % 7}") for n in range(50)]
    add(spark, rows, path)
    schema = spark.read.parquet(path).schema

    class Lost(Exception):
        pass

    whole = exact.better
    exact.better = lambda: (_ for _ in ()).throw(Lost())
    try:
        with pytest.raises(Lost):
            exact.ingest(spark, path, schema, home)
    finally:
        exact.better = whole
    exact.ingest(spark, path, schema, home)
    assert result(exact.resolve(spark, path, schema, home)) == brute(rows)


def test_settings_are_put_back(spark, tiny):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    queries.op12_exact(spark, tiny).count()
    assert spark.conf.get(name, None) == before


def test_odd_rows(spark, odd):
    path, home = scratch(spark, "docs"), scratch(spark, "home")
    rows = odd.withColumn("digest", F.lit("clash")).withColumn("file", F.lit("clash")).withColumn("norm", F.lit("clash")).withColumn("best", F.lit("clash"))
    rows.unionByName(rows.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))).write.parquet(path)
    schema = spark.read.parquet(path).schema
    exact.ingest(spark, path, schema, home)
    got = exact.resolve(spark, path, schema, home).collect()
    assert len(got) == odd.count() + 1
    same = [r for r in got if r.doc_id in (1, 6, None)]
    assert len(same) == 4 and {r.keep_id for r in same} == {1} and {r.group_size for r in same} == {4} and [r.doc_id for r in same if r.kept] == [1]
    blank = [r for r in got if r.doc_id in (2, 3, 4)]
    assert {r.keep_id for r in blank} == {4} and {r.text_sha256 for r in blank} == {hashlib.sha256(b"").hexdigest()}
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_repeated_rows_keep_one(spark):
    path, home = scratch(spark, "docs"), scratch(spark, "home")
    add(spark, [(1, "a b"), (1, "a b"), (1, "ab")], path)
    schema = spark.read.parquet(path).schema
    exact.ingest(spark, path, schema, home)
    got = exact.resolve(spark, path, schema, home).collect()
    assert [r.group_size for r in got] == [3, 3, 3] and sum(r.kept for r in got) == 1 and {r.keep_id for r in got} == {1}


def test_no_documents(spark, none):
    path, home = scratch(spark, "docs"), scratch(spark, "home")
    none.write.parquet(path)
    exact.ingest(spark, path, none.schema, home)
    assert exact.resolve(spark, path, none.schema, home).count() == 0
