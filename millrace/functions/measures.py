"""Hashes, times, rates and percentiles as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_fingerprint(values: Column) -> Column:
    """Aggregate: SHA-256 of the sorted distinct texts, one to a line; the empty set's is that of ''."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(values)), "\n"), 256)


def row_fingerprint(*columns: str) -> Column:
    """SHA-256 of a row's columns as JSON by name, nulls told from missing."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"}), 256)


def rows_fingerprint(*columns: str) -> Column:
    """Aggregate: SHA-256 of a group's rows, whatever their order."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(row_fingerprint(*columns))), "\n"), 256)


def parse_timestamp(x: Column) -> Column:
    """ISO text as a time, without a zone as UTC; what can't be read is null."""
    return F.try_to_timestamp(F.nullif(F.trim(x), F.lit("")))


def age_days(updated: Column, captured: Column, now: Column) -> Column:
    """Days since the update, else since the capture, else infinity; never negative."""
    since = lambda t: (F.unix_micros(now) - F.unix_micros(t)) / 86_400_000_000
    return F.coalesce(F.greatest(F.lit(0.0), since(updated)), F.greatest(F.lit(0.0), since(captured)), F.lit(float("inf")))


def is_stale(claimed: Column, now: Column, minutes: int) -> Column:
    return claimed < now - F.make_dt_interval(mins=F.lit(minutes))


def per_minute(n: Column, seconds: Column) -> Column:
    """A rate; 0 where no time has passed."""
    return F.when(seconds > 0, n * 60 / seconds).otherwise(0.0)


def projected_seconds(left: Column, rate: Column) -> Column:
    """The time that what is left takes at a rate; null without one."""
    return F.when(rate > 0, left * 60 / rate)


def split_limit(total: int, parts: int) -> list[int]:
    """A limit in fair parts; the first ones get the remainder."""
    whole, rest = divmod(total, parts)
    return [whole + (k < rest) for k in range(parts)]
