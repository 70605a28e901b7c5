"""Summaries that merge: distinct counts and percentiles from sketches of a few kilobytes a group.

Exact counts and ranks (operators.summaries) sort or shuffle all rows each time a report is made. A sketch is made once for each part
(a run, a day), stored, and merged for any report over parts. A HyperLogLog sketch of lg_k bits has a standard error
of 1.04 / sqrt(2**lg_k); a KLL sketch of k has ranks within about 2.296 / k**0.9021 of the truth, at 99 % confidence.
Both are exact for groups smaller than they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, K = 12, 200


def count_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that a distinct count stays within, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def rank_error(k: int = K) -> float:
    """How far from the asked-for one the rank of a percentile may be, as a part of all rows."""
    return 2.296 / k**0.9021


def sketches(df: DataFrame, parts: list[str], distinct: str, value: str, lg_k: int = LG_K, k: int = K) -> DataFrame:
    """A row for each part: n, and the sketches `ids` of the distinct values of one column and `values` of another. Nulls don't count."""
    return df.groupBy(*parts).agg(F.count(value).alias("n"), F.hll_sketch_agg(distinct, lg_k).alias("ids"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("values"))


def merged(stored: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of parts -> sketches of groups of parts, of the same columns."""
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("values").alias("values"))


def n_distinct(ids: str = "ids") -> Column:
    return F.hll_sketch_estimate(ids)


def percentile(p: float, values: str = "values") -> Column:
    """The value of rank p; null for a group without values."""
    return F.when(F.kll_sketch_get_n_double(values) > 0, F.kll_sketch_get_quantile_double(values, F.lit(p)))


def report(stored: DataFrame, by: list[str], percentiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """n, n_distinct and percentiles (p50, p95, ...) of groups of parts."""
    return merged(stored, by).select(*by, "n", n_distinct().alias("n_distinct"), *(percentile(p).alias(f"p{round(p * 100)}") for p in percentiles))
