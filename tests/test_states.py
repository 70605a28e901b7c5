"""Streams with state: the life of pages over restarts, stale claims, completeness and late captures, progress events."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import queue, sketches
from millrace.streaming import completeness, progress, states
from millrace.streaming.ingest import drain, settings

SCHEMA = "url string, event_id long, kind string, at timestamp"
T0 = datetime.datetime(2024, 1, 1)


def minute(m):
    return T0 + datetime.timedelta(minutes=m)


def put(spark, folder, name, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, pages=None):
    raw = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/*")
    with settings(spark, states.ROCKSDB):
        drain(states.page_states(raw, pages, stale_minutes=10, late="1 minute"), f"{folder}/checkpoint", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


def test_one_capture_is_as_the_expression_says(spark):
    kinds = ["valid", "valid_empty", "unavailable", "restriction_like", "timeout", "retry_zero", "other"]
    df = spark.createDataFrame([(k, r) for k in kinds for r in range(4)], "k string, r int")
    for row in df.select("*", queue.page_transition(F.col("k"), F.col("r")).alias("s")).collect():
        assert states.after(row.k, row.r) == (row.s.status, row.s.retry_count)


def test_states_go_on_after_a_restart(spark, tmp_path):
    """Retries counted by one run are known to the next, which starts from the checkpoint and reads new files only."""
    pages = spark.createDataFrame([("known", "retry_pending", 1)], "url string, status string, retry_count int")
    put(spark, f"{tmp_path}/in", "0", [("known", 1, "retry_zero", minute(1)), ("new", 2, "retry_zero", minute(1)), ("new", 3, "retry_zero", minute(0))])
    first = run(spark, tmp_path, pages).orderBy("event_id").select("url", "status", "retry_count", "attempts").collect()
    assert [tuple(r) for r in first] == [("known", "retry_pending", 2, 1), ("new", "retry_pending", 2, 2), ("new", "retry_pending", 1, 1)]
    put(spark, f"{tmp_path}/in", "1", [("known", 4, "retry_zero", minute(2)), ("new", 5, "retry_zero", minute(2)), ("new", 6, "valid", minute(3))])
    second = run(spark, tmp_path, pages).filter("event_id > 3").orderBy("event_id").select("url", "status", "retry_count", "attempts").collect()
    assert [tuple(r) for r in second] == [("known", "review", 2, 2), ("new", "review", 2, 3), ("new", "saved", 0, 4)]


def test_stale_claims_wait_again(spark, tmp_path):
    put(spark, f"{tmp_path}/in", "0", [("stale", 1, "claim", minute(0)), ("done", 2, "claim", minute(0)), ("done", 3, "valid", minute(5)), ("again", 4, "claim", minute(0)), ("again", 5, "claim", minute(25))])
    run(spark, tmp_path)
    put(spark, f"{tmp_path}/in", "1", [("clock", 6, "valid", minute(30))])
    run(spark, tmp_path)
    put(spark, f"{tmp_path}/in", "2", [("clock", 7, "valid", minute(31)), ("stale", 8, "retry_zero", minute(31))])
    got = run(spark, tmp_path)
    expired = got.filter("event_id IS NULL").collect()
    assert [(r.url, r.status, r["at"]) for r in expired] == [("stale", "pending", minute(10))]
    assert [(r.status, r.retry_count) for r in got.filter("event_id = 8").collect()] == [("retry_pending", 1)]


def answers(spark, folder):
    a = spark.readStream.schema("target string, page long, asked_at timestamp").parquet(f"{folder}/asked/*")
    c = spark.readStream.schema("target string, page long, captured_at timestamp").parquet(f"{folder}/came/*")
    drain(completeness.answered(a, c, "30 minutes", "5 minutes"), f"{folder}/checkpoint", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").filter("target <> 'clock'")


def test_a_late_page_leaves_its_target_incomplete(spark, tmp_path):
    asked, came = "target string, page long, asked_at timestamp", "target string, page long, captured_at timestamp"
    put(spark, f"{tmp_path}/asked", "0", [("whole", 1, minute(0)), ("whole", 2, minute(1)), ("late", 1, minute(0)), ("never", 1, minute(2))], asked)
    put(spark, f"{tmp_path}/came", "0", [("whole", 1, minute(3)), ("late", 1, minute(45))], came)
    first = answers(spark, tmp_path)
    assert {(r.target, r.page) for r in first.collect()} == {("whole", 1)}  # the rest may still come
    put(spark, f"{tmp_path}/came", "1", [("whole", 2, minute(31)), ("clock", 0, minute(120))], came)
    put(spark, f"{tmp_path}/asked", "1", [("clock", 9, minute(120))], asked)
    answers(spark, tmp_path)
    # beyond the watermark: this one is dropped by the join, and found by the table of late captures
    put(spark, f"{tmp_path}/came", "2", [("never", 1, minute(4)), ("clock", 0, minute(200))], came)
    put(spark, f"{tmp_path}/asked", "2", [("clock", 9, minute(200))], asked)
    pages = answers(spark, tmp_path)
    told = {r.target: (r.n_pages, r.n_captured, r.complete) for r in completeness.targets(pages).collect()}
    assert told == {"whole": (2, 2, True), "late": (1, 0, False), "never": (1, 0, False)}
    late = completeness.late(spark.read.schema(came).parquet(f"{tmp_path}/came/*").filter("target <> 'clock'"), pages)
    assert {(r.target, r.page) for r in late.collect()} == {("late", 1), ("never", 1)}


def test_streams_tell_true_row_counts(spark, tmp_path):
    for k, n in enumerate((3, 5)):
        put(spark, f"{tmp_path}/in", str(k), [("u", k * 10 + i, "valid", minute(i)) for i in range(n)])
    told = []
    with progress.watching(spark, told.append, {"copy": 16}):
        raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        raw.writeStream.queryName("copy").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    mine = [e for e in told if e["command"] == "copy"]
    batches = [e for e in mine if e["event"] == "batch"]
    assert [e["event"] for e in mine] == ["start", "batch", "batch", "done"] and sorted(e["rows"] for e in batches) == [3, 5]
    assert mine[-1]["rows"] == 8 and batches[-1]["rate"] > 0 and batches[-1]["seconds_left"] == pytest.approx(8 / batches[-1]["rate"])


def test_commands_tell_true_row_counts(spark, tmp_path):
    told, ticks = [], iter(range(0, 100, 4))
    with progress.counted("export", told.append, lambda: next(ticks)) as work:
        work.watch(spark.range(1000).filter("id % 4 = 0"), "rows").write.parquet(f"{tmp_path}/a")
        work.watch(spark.range(7), "few").write.parquet(f"{tmp_path}/b")
    assert [e["event"] for e in told] == ["start", "batch", "batch", "done"] and {e["name"]: e["rows"] for e in told[1:3]} == {"rows": 250, "few": 7}
    assert told[-1] == {"command": "export", "event": "done", "rows": 257, "seconds": 4} and told[1]["rate"] == 250 / 4
    with pytest.raises(ValueError), progress.counted("export", told.append):
        raise ValueError
    assert told[-1]["event"] == "failed" and told[-1]["error"] == "ValueError"
    assert progress.pace(10, 5.0, 30) == {"rate": 2.0, "seconds_left": 10.0} and progress.pace(0, 1.0, 5)["seconds_left"] is None


# ---- sketches


def test_merged_sketches_stay_within_their_error(spark):
    df = spark.range(200_000).selectExpr("id % 20 AS part", "id % 3 AS run", "id % 50000 AS user", "cast(id * 7919 % 200000 AS double) AS value")
    stored = sketches.sketches(df, ["part", "run"], "user", "value")
    assert stored.count() == 60
    row = sketches.report(stored.withColumn("all", F.lit(1)), ["all"], (0.01, 0.5, 0.95)).first()
    assert row.n == 200_000 and abs(row.n_distinct - 50_000) <= sketches.count_error() * 50_000
    for p, name in ((0.01, "p1"), (0.5, "p50"), (0.95, "p95")):
        assert abs(row[name] / 200_000 - p) <= sketches.rank_error() + 1e-5


def test_sketches_of_few_rows_are_exact(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("a", 2, None), ("b", None, None)], "run string, user int, value double")
    got = {r.run: r for r in sketches.report(sketches.sketches(df, ["run"], "user", "value"), ["run"]).collect()}
    assert (got["a"].n, got["a"].n_distinct, got["a"].p50, got["a"].p95) == (2, 2, 5.0, 6.0) and (got["b"].n, got["b"].n_distinct, got["b"].p50) == (0, 0, None)
    assert sketches.report(sketches.sketches(df.limit(0), ["run"], "user", "value"), ["run"]).count() == 0
