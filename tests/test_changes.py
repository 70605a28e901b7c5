"""Merges, snapshot diffs, queues and history: rules, idempotence and order."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import measures, values
from millrace.functions import url as U
from millrace.operators import dedup, diff, merge, quality, queue, summaries

T1, T2, T3 = (datetime.datetime(2024, 1, d) for d in (1, 2, 3))
MEMBER = "target string, doctor_url string, is_active boolean, missing_streak int, first_seen_at timestamp, last_seen_at timestamp, inactive_at timestamp, name string"


def ts(t):
    return F.lit(t).cast("timestamp")


def run(spark, old, pairs, at, gate=None, **kw):
    new = spark.createDataFrame([(t, d, n) for t, d, n in pairs], "target string, doctor_url string, name string")
    complete = spark.createDataFrame([(g,) for g in gate], "target string") if gate is not None else None
    return diff.membership_diff(old, new, ["target"], "doctor_url", ts(at), complete=complete, **kw)


def events(d):
    return {(r.target, r.doctor_url, r.event_type, r.old_value, r.new_value) for r in d.events.collect()}


def state(d):
    return {(r.target, r.doctor_url): (r.is_active, r.missing_streak, r.name) for r in d.memberships.collect()}


def test_membership_rules_over_three_runs(spark):
    empty = spark.createDataFrame([], MEMBER)
    one = run(spark, empty, [("s", "a", "A"), ("s", "b", "B")], T1)
    assert events(one) == {("s", "a", "added", "absent", "active"), ("s", "b", "added", "absent", "active")}
    two = run(spark, one.memberships, [("s", "a", "")], T2)
    assert events(two) == {("s", "b", "removal_pending", "0", "1")} and state(two) == {("s", "a"): (True, 0, "A"), ("s", "b"): (True, 1, "B")}
    three = run(spark, two.memberships, [("s", "a", "A2")], T3)
    assert events(three) == {("s", "b", "removed", "active", "inactive")} and state(three)["s", "a"] == (True, 0, "A2")
    four = run(spark, three.memberships, [("s", "a", ""), ("s", "b", "")], T3)
    assert events(four) == {("s", "b", "reactivated", "inactive", "active")}
    assert {r.doctor_url: r.inactive_at for r in four.memberships.collect()}["b"] is None


def test_incomplete_target_changes_nothing(spark):
    one = run(spark, spark.createDataFrame([], MEMBER), [("s", "a", "A"), ("t", "c", "C")], T1)
    two = run(spark, one.memberships, [("s", "z", "Z"), ("t", "c", "C")], T2, gate=["t"])
    assert events(two) == set() and state(two) == state(one)


def test_gated_target_without_providers_loses_all(spark):
    one = run(spark, spark.createDataFrame([], MEMBER), [("s", "a", "A")], T1)
    two = run(spark, one.memberships, [], T2, gate=["s"], confirmations=1)
    assert events(two) == {("s", "a", "removed", "active", "inactive")}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seen=st.sets(st.tuples(st.sampled_from("st"), st.sampled_from("abcd")), min_size=1))
def test_same_snapshot_twice_has_no_events(spark, seen):
    pairs = [(t, d, d) for t, d in seen]
    one = run(spark, spark.createDataFrame([], MEMBER), pairs, T1)
    two = run(spark, one.memberships, pairs, T2)
    assert events(two) == set() and all(s[:2] == (True, 0) for s in state(two).values())


def test_providers_go_inactive_only_when_active_nowhere(spark):
    members = spark.createDataFrame([("s", "a", False), ("t", "a", True), ("s", "b", False)], "target string, doctor_url string, is_active boolean")
    providers = spark.createDataFrame([("a", True, None), ("b", True, None), ("c", True, None)], "doctor_url string, is_active boolean, inactive_at timestamp")
    once = diff.deactivate(providers, members, "doctor_url", ts(T1))
    again = diff.deactivate(once, members, "doctor_url", ts(T2))
    assert {r.doctor_url: (r.is_active, r.inactive_at) for r in again.collect()} == {"a": (True, None), "b": (False, T1), "c": (True, None)}
    assert {r.doctor_url: r.inactive_at for r in diff.deactivate(once, members, "doctor_url", ts(T2), compat=True).collect()}["b"] == T2


def test_every_merge_rule(spark):
    old = spark.createDataFrame([(1, "o", "", "o", 5, None), (2, "p", "q", "r", 1, 1)], "k int, a string, b string, c string, d int, e int")
    new = spark.createDataFrame([(1, "n", "n", "", 3, 7), (3, "x", "y", "z", 9, 9)], "k int, a string, b string, c string, d int, e int")
    rules = {"a": "overwrite", "b": "backfill_blank", "c": "overwrite_if_nonblank", "d": "least", "e": "coalesce_new"}
    got = {r.k: tuple(r)[1:] for r in merge.merge(old, new, ["k"], rules).collect()}
    assert got == {1: ("n", "n", "o", 3, 7), 2: ("p", "q", "r", 1, 1), 3: ("x", "y", "z", 9, 9)}
    assert merge.merge(old, new, ["k"], {}).filter("k = 1").first().a == "o"
    with pytest.raises(ValueError):
        merge.merge(old, new, ["k"], {"a": "guess"})


def test_merging_twice_is_merging_once(spark):
    old = spark.createDataFrame([(1, "a"), (2, "")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    once = merge.merge(old, new, ["k"], {"v": "backfill_blank"})
    assert sorted(once.collect()) == sorted(merge.merge(once, new, ["k"], {"v": "backfill_blank"}).collect())


def test_soft_delete_within_a_scope(spark):
    old = spark.createDataFrame([("a", "s", True, T1, T1), ("b", "s", True, T1, T1), ("c", "t", True, T1, T1)], "url string, slug string, is_active boolean, first_seen_at timestamp, last_seen_at timestamp")
    new = spark.createDataFrame([("a", "s"), ("d", "s")], "url string, slug string")
    got = {r.url: (r.is_active, r.first_seen_at, r.last_seen_at) for r in merge.soft_delete(old, new, ["url"], {}, ts(T2), F.col("o_slug") == "s").collect()}
    assert got == {"a": (True, T1, T2), "b": (False, T1, T1), "c": (True, T1, T1), "d": (True, T2, T2)}


def test_gate_needs_every_page(spark):
    def gate(*pages):
        df = spark.createDataFrame([("s", p, v, n) for p, v, n in pages], "target string, page int, valid boolean, n int")
        return quality.contiguity_gate(df, ["target"], "page", F.col("valid"), F.col("n")).first().complete

    assert gate((1, True, 3), (2, True, 0)) and not gate((1, True, 3), (3, True, 1)) and not gate((1, False, 3)) and not gate((1, True, 0), (2, True, 1)) and not gate((2, True, 1))


def test_wall_and_404_need_the_right_context(spark):
    row = lambda **k: spark.createDataFrame([{"text": "", "title": "", "visible": "", "n": 0, **k}], "text string, title string, visible string, n int")
    kind = lambda **k: row(**k).select(quality.listing_class(F.col("text"), F.col("title"), F.col("visible"), F.col("n"), F.lit(None).cast("int"))["class"]).first()[0]
    wall = "Please enable JS and disable any ad blocker"
    assert kind(visible=wall) == "restriction_like" and kind(visible=wall, n=1) == "valid" and kind(text=wall.lower()) == "retry_zero"
    assert kind(text="not found. redirecting to /404") == "unavailable" and kind(text="captcha not found. redirecting to /404") == "restriction_like"
    assert kind(title="404 error", text="well, this is unexpected this page may no longer be available") == "unavailable" and kind(title="404 error") == "retry_zero"
    assert kind(text="no providers found") == "valid_empty"


def test_streaks_restart_after_presence(spark):
    df = spark.createDataFrame([("a", k, p) for k, p in enumerate([True, False, False, True, False])], "k string, run int, present boolean")
    assert [r.missing_streak for r in dedup.absence_streaks(df, ["k"], "run", "present").orderBy("run").collect()] == [0, 1, 2, 0, 1]


def test_queue_rules(spark):
    jobs = spark.range(500).select("id", F.when(F.col("id") % 2 == 0, "pending").otherwise("saved").alias("status"))
    got = queue.assign(jobs, ["id"], 7)
    assert got.count() == 250 and got.select("id").distinct().count() == 250 and max(r["count"] for r in got.groupBy("worker").count().collect()) <= 64
    with pytest.raises(ValueError):
        queue.reset(jobs, ["saved"])
    open_ = spark.createDataFrame([("opening", T1), ("opening", T3)], "status string, claimed_at timestamp")
    assert sorted(r.status for r in queue.recover_stale(open_, ts(T3), 60).collect()) == ["opening", "pending"]


def test_two_percentiles_differ(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    whole = df.withColumn("g", F.lit(None).cast("string"))
    row = summaries.latency_summary(whole, ["g"], "v").select(F.col("p95").alias("a")).crossJoin(summaries.timing_summary(whole, ["g"], "v").select(F.col("p95_nearest").alias("b"))).first()
    assert (row.a, row.b) == (pytest.approx(9.55), 10.0) and measures.split_limit(10, 4) == [3, 3, 2, 2]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(urls=st.lists(st.from_regex(r"https?://[a-z]{1,5}\.example(/[a-z0-9-]{0,6}){0,4}(\?[a-z]{0,3})?(#[a-z]{0,2})?", fullmatch=True), min_size=1, max_size=6))
def test_url_algebra_is_idempotent(spark, urls):
    from millrace.sources import links

    df = spark.createDataFrame([(u,) for u in urls], "u string")
    once, base = U.normalize_url(F.col("u")), U.base_location_url(F.col("u"))
    for r in df.select("u", once.alias("n"), U.normalize_url(once).alias("nn"), base.alias("b"), U.page_number(F.col("u")).alias("p"), U.is_profile_url(F.col("u")).alias("f")).collect():
        assert r.n == r.nn == links.normal(r.u) and r.b == links.base_of(r.u) and r.p == links.page_of(r.u) and r.f == links.is_profile(r.u)


def test_fingerprint_ignores_order(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "x string").agg(measures.set_fingerprint(F.col("x"))).first()[0] for xs in (["p", "q", "p"], ["q", "p"]))
    none = spark.createDataFrame([], "x string").agg(measures.set_fingerprint(F.col("x"))).first()[0]
    assert a == b and none == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_unknown_is_not_false(spark):
    df = spark.createDataFrame([("1.0",), ("Y",), (" no ",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(values.tri_bool(F.col("x"))).collect()] == [None, True, False, None, None]


def test_plans_stay_native_and_use_semi_joins(spark, tiny, capsys):
    from millrace.plans.catalogue import QUERIES

    def plan(name):
        QUERIES[name](spark, tiny).explain("formatted")
        return capsys.readouterr().out

    assert "LeftSemi" in plan("semi_exists") and "LeftAnti" in plan("anti_not_exists") and "WindowGroupLimit" in plan("latest_snapshot")
    for name in ("url_normalize", "zip_normalize", "name_split", "tri_state_flags", "membership_diff"):
        assert "Python" not in plan(name) and "Arrow" not in plan(name)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)" in plan("semi_exists")


def test_unique_match_drops_ambiguity(spark):
    left = spark.createDataFrame([("x",), ("y",)], "a string")
    right = spark.createDataFrame([("x-1",), ("y-1",), ("y-2",)], "b string")
    got = summaries.unique_match(left, right, F.col("a"), F.substring_index("b", "-", 1), "b").collect()
    assert [(r.a, r.matched_b) for r in got] == [("x", "x-1")]


def test_fair_rounds_take_up_where_they_stopped(spark):
    """A target with many jobs waits for the others in every round; the next run goes on after the target served last."""
    jobs = spark.createDataFrame([("big", k, "pending") for k in range(6)] + [("mid", k, "pending") for k in range(2)] + [("one", 0, "pending"), ("one", 1, "saved")], "t string, k int, status string")
    first, after = queue.next_turns(jobs, ["t"], ["k"], 2)
    assert [(r.t, r.k) for r in first.collect()] == [("big", 0), ("mid", 0)] and after == ("mid",)
    left = jobs.join(first.select("t", "k"), ["t", "k"], "left_anti")
    second, after = queue.next_turns(left, ["t"], ["k"], 4, after)
    assert [(r.t, r.k) for r in second.collect()] == [("one", 0), ("big", 1), ("mid", 1), ("big", 2)] and after == ("big",)
    left = left.join(second.select("t", "k"), ["t", "k"], "left_anti")
    third, again = queue.next_turns(left, ["t"], ["k"], 10, after)
    assert [(r.t, r.k) for r in third.collect()] == [("big", 3), ("big", 4), ("big", 5)] and again == ("big",)
    assert queue.next_turns(left.limit(0), ["t"], ["k"], 3, again)[1] == ("big",)
