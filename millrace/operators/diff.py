"""Change tracking between complete snapshots.

A target's crawl counts only if its completeness gate is passed; the others change nothing: no removal,
no longer streak. Memberships of all targets are compared in one full outer join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIRMATIONS = 2


@dataclass(frozen=True)
class Diff:
    memberships: DataFrame
    events: DataFrame


def membership_diff(old: DataFrame, new: DataFrame, target: list[str], member: str, run_ts: Column, confirmations: int = CONFIRMATIONS, complete: DataFrame | None = None) -> Diff:
    """The next memberships and the change events.

    old: target, member, is_active, missing_streak, first_seen_at, last_seen_at, inactive_at, name.
    new: target, member, name. complete: the targets that passed the gate (default: those in new).

    New keys are added, inactive ones reactivated, active ones refreshed without an event; an active one
    that is absent has its streak raised and goes inactive when that reaches `confirmations`.
    """
    gate = (complete if complete is not None else new).select(*target).distinct().withColumn("_gated", F.lit(True))
    keys = [*target, member]
    seen = new.select(*keys, F.col("name").alias("_new_name")).dropDuplicates(keys).withColumn("_seen", F.lit(True)).join(gate.drop("_gated"), target, "left_semi")
    both = old.withColumn("_old", F.lit(True)).join(seen, keys, "full").join(gate, target, "left")
    here, was, active = F.coalesce("_seen", F.lit(False)), F.coalesce("_old", F.lit(False)), F.coalesce("is_active", F.lit(False))
    gone = F.coalesce("_gated", F.lit(False)) & was & active & ~here
    streak = F.col("missing_streak") + 1
    out_now = gone & (streak >= confirmations)
    event = (
        F.when(here & ~was, "added").when(here & ~active, "reactivated").when(out_now, "removed").when(gone, "removal_pending")
    )
    before = F.when(event == "added", "absent").when(event == "reactivated", "inactive").when(event == "removed", "active").when(event == "removal_pending", F.col("missing_streak").cast("string"))
    after = F.when(event.isin("added", "reactivated"), "active").when(event == "removed", "inactive").when(event == "removal_pending", streak.cast("string"))
    tagged = both.withColumn("event_type", event).withColumn("old_value", before).withColumn("new_value", after)
    next_rows = tagged.select(
        *keys,
        F.when(here, True).when(out_now, False).otherwise(F.col("is_active")).alias("is_active"),
        F.when(here, 0).when(gone, streak).otherwise(F.col("missing_streak")).cast("int").alias("missing_streak"),
        F.coalesce("first_seen_at", run_ts).alias("first_seen_at"),
        F.when(here, run_ts).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(here, F.lit(None)).when(out_now, run_ts).otherwise(F.col("inactive_at")).alias("inactive_at"),
        F.when(here & (F.trim(F.coalesce("_new_name", F.lit(""))) != ""), F.col("_new_name")).otherwise(F.coalesce("name", "_new_name")).alias("name"),
    )
    events = tagged.filter("event_type IS NOT NULL").select(*keys, "event_type", "old_value", "new_value", run_ts.alias("event_at"))
    return Diff(next_rows, events)


def deactivate(providers: DataFrame, memberships: DataFrame, member: str, run_ts: Column, compat: bool = False) -> DataFrame:
    """Providers active nowhere go inactive, those active somewhere become active.

    A membership whose removal is pending is still active. compat: stamp inactive_at again on every run.
    """
    active = memberships.groupBy(F.col(member).alias("_m")).agg(F.bool_or("is_active").alias("_active"))
    joined = providers.join(active, F.col(member) == F.col("_m"), "left")
    off = F.col("_active") == False  # noqa: E712
    stamp = off if compat else off & F.col("is_active")
    return (
        joined.withColumn("inactive_at", F.when(F.col("_active"), F.lit(None)).when(stamp, run_ts).otherwise(F.col("inactive_at")))
        .withColumn("is_active", F.coalesce("_active", "is_active"))
        .drop("_m", "_active")
    )


def hash_changes(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys of new with `event_type`: profile_added, profile_changed, or none where the hash is the same."""
    have = old.select(F.col(key).alias("_k"), F.col(digest).alias("_old"))
    event = F.when(F.coalesce("_old", F.lit("")) == "", "profile_added").when(F.col("_old") != F.col(digest), "profile_changed")
    return new.join(have, F.col(key) == F.col("_k"), "left").withColumn("event_type", event).withColumn("old_value", F.coalesce("_old", F.lit(""))).drop("_k", "_old")


def count_changes(latest: DataFrame, current: DataFrame, keys: list[str], open_jobs: DataFrame) -> DataFrame:
    """Current counts with `previous` and `verdict`: unchanged (also a first sighting), changed, or queued already."""
    before = latest.select(*keys, F.col("n").alias("previous"))
    waiting = open_jobs.select(*keys).distinct().withColumn("_open", F.lit(True))
    differs = F.coalesce(F.col("previous") != F.col("n"), F.lit(False))
    verdict = F.when(~differs, "unchanged").when(F.coalesce("_open", F.lit(False)), "already_queued").otherwise("changed")
    return current.join(before, keys, "left").join(waiting, keys, "left").withColumn("verdict", verdict).drop("_open")


def targets_result(new: DataFrame, target: list[str], member: str, events: DataFrame) -> DataFrame:
    """A row for each gated target: its members, their fingerprint, and its events by kind."""
    from millrace.functions.measures import set_fingerprint

    counts = events.groupBy(*target).agg(*(F.count_if(F.col("event_type") == e).alias(f"n_{e}") for e in ("added", "reactivated", "removed", "removal_pending")))
    seen = new.groupBy(*target).agg(F.count_distinct(member).alias("n_members"), set_fingerprint(F.col(member).cast("string")).alias("fingerprint"))
    return seen.join(counts, target, "left").na.fill(0)
