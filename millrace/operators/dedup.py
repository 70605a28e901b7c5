"""First, latest and best rows of a key, numbering, and comparisons along a key's history.

Every "first" has an explicit order; none depends on how rows happen to arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = list[str | Column]


def keep_first(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """One row a key, the first by order. Planned as a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def tail_n(df: DataFrame, keys: Keys, order: Keys, n: int) -> DataFrame:
    """The first n rows of a key by order (descending columns give the latest)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def earliest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Columns of each key's smallest row by order; aggregates before the shuffle, so hot keys don't hurt."""
    picked = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *(F.col(f"_first.{c}").alias(c) for c in columns))


def identity(provider_id: Column, npi: Column, url: Column) -> Column:
    """A namespaced identity: provider id, else NPI, else URL."""
    has = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return F.when(has(provider_id), F.concat(F.lit("provider::"), F.trim(provider_id))).when(has(npi), F.concat(F.lit("npi::"), F.trim(npi))).otherwise(F.concat(F.lit("url::"), F.coalesce(url, F.lit(""))))


def location_key(key: Column, *fallback: Column, tie: Column) -> Column:
    """A row's own location key, else its other columns together; where all are blank, `tie` keeps rows apart."""
    blank = F.trim(F.coalesce(key, F.lit(""))) == ""
    parts = [F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))) for c in fallback]
    empty = F.concat(*parts) == ""
    return F.when(~blank, F.concat(F.lit("plk::"), F.trim(key))).when(empty, F.concat(F.lit("row::"), tie.cast("string"))).otherwise(F.concat(F.lit("parts::"), F.concat_ws("\x1f", *parts)))


def conflicts(df: DataFrame, keys: Keys, order: Keys, content: Column) -> DataFrame:
    """One row a key: the first by order, with `n_conflicts`, the others whose content differs from it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.withColumn("_h", content).withColumn("_differs", F.col("_h") != F.first("_h").over(whole))
    out = out.withColumn("n_conflicts", F.count_if("_differs").over(whole)).withColumn("_rn", F.row_number().over(w))
    return out.filter("_rn = 1").drop("_rn", "_h", "_differs")


def changed(df: DataFrame, keys: Keys, order: Keys, column: str) -> DataFrame:
    """Rows with `previous`, the column's value in the key's row before, and `changed`; a first row is unchanged."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("previous", F.lag(column).over(w))
    return out.withColumn("changed", F.coalesce(F.col("previous") != F.col(column), F.lit(False)))


def absence_streaks(df: DataFrame, keys: Keys, order: str, present: str) -> DataFrame:
    """Rows with `missing_streak`: how many rows of the key in a row, this one last, were absent.

    Islands of absence are numbered by the presences before them.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    island = F.sum(F.col(present).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    inside = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_island", island).withColumn("missing_streak", F.sum((~F.col(present)).cast("long")).over(inside)).drop("_island")


def ragged_pivot(df: DataFrame, group: str, value: str, columns: list[str]) -> DataFrame:
    """A column for each group, its values top down in order; shorter ones end in nulls."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(value))
    return df.select(group, value).distinct().withColumn("rn", rn).groupBy("rn").pivot(group, columns).agg(F.first(value))
