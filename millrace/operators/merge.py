"""Set-based merges: a current table and a batch give the next version of the table.

A rule says what becomes of a column when a key is in both; keys in one only are kept or inserted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import text

RULES = ("overwrite", "keep_old", "backfill_blank", "overwrite_if_nonblank", "least", "greatest", "coalesce_new")


def apply_rule(rule: str, old: Column, new: Column) -> Column:
    if rule == "overwrite":
        return new
    if rule == "keep_old":
        return old
    if rule == "backfill_blank":
        return F.when(F.trim(text(old)) == "", new).otherwise(old)
    if rule == "overwrite_if_nonblank":
        return F.when(F.trim(text(new)) == "", old).otherwise(new)
    if rule == "least":
        return F.least(old, new)
    if rule == "greatest":
        return F.greatest(old, new)
    if rule == "coalesce_new":
        return F.coalesce(new, old)
    raise ValueError(f"unknown rule {rule!r}; one of {', '.join(RULES)}")


def _sides(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Both tables side by side, every column as o_ and n_, with o_here and n_here; one shuffle of each side."""
    left = old.select(*(F.col(c).alias(f"o_{c}") for c in old.columns), F.lit(True).alias("o_here"))
    right = new.select(*(F.col(c).alias(f"n_{c}") for c in new.columns), F.lit(True).alias("n_here"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}"))
    return left.join(right, match, "full")


def merge(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str], insert: bool = True, update: bool = True) -> DataFrame:
    """The next version of old. Columns without a rule keep old's value; new may lack some columns."""
    both = _sides(old, new, keys)
    if not insert:
        both = both.filter("o_here")
    out = []
    for c in old.columns:
        o = F.col(f"o_{c}")
        n = F.col(f"n_{c}") if c in new.columns else F.lit(None).cast(old.schema[c].dataType)
        kept = apply_rule(rules.get(c, "keep_old"), o, n) if update and c not in keys and c in new.columns else o
        out.append(F.when(F.col("o_here") & F.col("n_here"), kept).when(F.col("o_here"), o).otherwise(n).alias(c))
    return both.select(*out)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and the rows of new whose key is not there."""
    fresh = new.join(old.select(*keys).distinct(), keys, "left_anti")
    return old.unionByName(fresh.select(*(c for c in old.columns if c in new.columns)), allowMissingColumns=True)


def replace_groups(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with all rows of the groups that new has replaced by new's; duplicates stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def soft_delete(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str], seen_at: Column, scope: Column | None = None) -> DataFrame:
    """A dimension refresh: absent keys become inactive, present ones active and overwritten by rule.

    `first_seen_at` is set once, `last_seen_at` on every sighting. scope: only these old rows can go inactive.
    """
    both = _sides(old, new, keys)
    scoped = F.lit(True) if scope is None else scope
    out = []
    for c in old.columns:
        o = F.col(f"o_{c}")
        n = F.col(f"n_{c}") if c in new.columns else F.lit(None).cast(old.schema[c].dataType)
        if c == "is_active":
            value = F.when(F.col("n_here"), True).when(scoped, False).otherwise(o)
        elif c == "first_seen_at":
            value = F.coalesce(o, seen_at)
        elif c == "last_seen_at":
            value = F.when(F.col("n_here"), seen_at).otherwise(o)
        elif c in keys:
            value = F.coalesce(o, n)
        else:
            value = F.when(F.col("o_here") & F.col("n_here"), apply_rule(rules.get(c, "overwrite"), o, n)).when(F.col("o_here"), o).otherwise(n)
        out.append(value.alias(c))
    return both.select(*out)


def union_priority(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of tables; of equal keys the row of the earliest table stays."""
    tagged = [p.withColumn("_priority", F.lit(k)) for k, p in enumerate(parts)]
    whole = tagged[0]
    for p in tagged[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    order = [F.col("_priority"), *(F.col(c) for c in parts[0].columns if c not in keys)]
    return whole.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn", "_priority")


def classify_import(rows: DataFrame, current: DataFrame, key: str, stored: str) -> DataFrame:
    """rows with `outcome`: invalid (blank key), unmatched, already_present (something stored) or import."""
    have = current.select(F.col(key).alias("_k"), F.col(stored).alias("_stored"))
    outcome = F.when(F.trim(text(F.col(key))) == "", "invalid").when(F.col("_k").isNull(), "unmatched").when(F.trim(text(F.col("_stored"))) != "", "already_present").otherwise("import")
    return rows.join(have, F.col(key) == F.col("_k"), "left").withColumn("outcome", outcome).drop("_k", "_stored")
