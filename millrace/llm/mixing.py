"""Mixing sources to target weights by entropy balancing.

Among all document rates that give every source its target number of words, none above `most`, the mix
takes those closest to 1 in relative entropy. The dual problem is convex with one multiplier a source: a
document's rate is exp(multiplier * size), at most `most`, so documents are tilted by their size. Newton's
steps on the dual run over the data: each sums words and curvature over a table of (source, size, number of
documents) and moves all sources' multipliers at once, inside brackets that a step too far only narrows, until
every source's words are within `TOLERANCE` of its target.

Rates become whole copies: every document gets the rate's whole part, and the table of sizes says how
many documents of each size get one more, so that the running total stays near the target from the longest
sizes to the shortest; what is then still missing or too much is mended, from the largest size that fits it
to the smallest, and last by the one exchange of two sizes that comes nearest. What is left is reported as
`residual`. Which documents of a size get one more is settled by a hash of their number.

Everything is DataFrame code. What a source has in one place is a row for each of its sizes (and of the
sizes' bins of HOT documents), never its documents; weights need a row for each source in one order.

Defined results: null or empty text has size 0, rate 1 and takes 0 words; a null source is a source of its
own, last in order; a source whose target is `most` times its words has that rate throughout, one without
a target rate 0; an empty table gives an empty mix; repeated rows are documents of their own and, sharing
a number, get the same fate wherever both can; ties of size go by hash, then number; texts of any length
count whole; other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stash, uid

#: How near the rates' words come to a source's target, relative to it, before they are rounded.
TOLERANCE = 1e-9
#: Documents of one source and size beyond which they are dealt to bins.
HOT = 500


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: list[float], most: float) -> DataFrame:
    """source, total -> and target: shares of all words by weight, none above `most` times its total.

    The weights go round the sources in code point order, null last. The excess of the capped sources
    goes to the others by weight: with the sources in order of cap / weight, the capped ones come first,
    and a source is capped if the level that the ones from it onwards would share reaches its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.col("total") * F.lit(float(most)))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("own", (F.sum("total").over(everything) - F.col("before")) / F.col("left"))
    )
    open_level = F.min(F.when(F.col("own") < F.col("level"), F.struct("level", "source", "own"))).over(everything)["own"]
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * open_level, F.col("cap")))
    return ranked.select("source", "total", target.alias("target"))


def multipliers(sizes: DataFrame, goal: DataFrame, most: float) -> DataFrame:
    """goal with `unit` and `dual`: a document's rate is exp(dual * size / unit), at most `most`.

    Newton's steps solve log(words) = log(target), whose left side rises with the multiplier.
    """
    unit = sizes.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("unit"))
    state = goal.join(unit.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    free = (F.col("target") > 0) & (F.col("target") < most * F.col("total") * (1 - TOLERANCE))
    state = state.withColumn("unit", F.coalesce("unit", F.lit(1.0))).withColumn("dual", F.lit(0.0)).withColumn("off", F.when(free, float("inf")).otherwise(0.0))
    state = stash(state.withColumn("low", -50 * F.col("unit")).withColumn("high", math.log(most) * F.col("unit")), "dual")
    while (state.agg(F.max("off")).first()[0] or 0) > TOLERANCE:
        of = state.withColumnRenamed("source", "s")
        tilt = F.exp(F.col("dual") * F.col("size") / F.col("unit"))
        words = F.col("n") * F.col("size") * F.least(tilt, F.lit(float(most)))
        sums = sizes.filter("size > 0").join(of, F.col("source").eqNullSafe(F.col("s")))
        sums = sums.groupBy("source").agg(F.sum(words).alias("words"), F.sum(F.when(tilt < most, words * F.col("size") / F.col("unit")).otherwise(0.0)).alias("slope"), *(F.first(c).alias(c) for c in state.columns if c != "source"))
        gap = F.log(F.col("words") / F.col("target"))
        sums = sums.withColumn("gap", F.when(F.col("off") > TOLERANCE, gap).otherwise(0.0))
        sums = sums.withColumn("low", F.when(F.col("gap") < 0, F.col("dual")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("gap") > 0, F.col("dual")).otherwise(F.col("high")))
        newton = F.col("dual") - F.col("gap") * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        narrow = F.col("high") - F.col("low") <= 1e-14 * F.col("unit")
        off = F.when(narrow, 0.0).otherwise(F.abs(F.col("gap")))
        moved = F.when(off <= TOLERANCE, F.col("dual")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = stash(sums.withColumn("off", off).withColumn("dual", moved).select(*state.columns), "dual")
    return state.select(*goal.columns, "unit", "dual")


def rate_of(most: float) -> Column:
    """The rate of documents of a size, from a source's row of multipliers."""
    tilted = F.least(F.exp(F.col("dual") * F.col("size") / F.col("unit")), F.lit(float(most)))
    full = F.col("target") >= most * F.col("total") * (1 - TOLERANCE)
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("target") <= 0, 0.0).when(full, float(most)).otherwise(tilted)
    # a rate that is whole but for rounding errors is whole
    return F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)


def _mend(groups: DataFrame, most: float) -> DataFrame:
    """Per source: sizes, how many of their documents get one copy more or less to meet the target, and what is left then."""
    off = groups.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.col("up")))).alias("off"))
    can = F.when((F.col("off") > 0) & (F.col("whole") + 1 <= most), F.col("n") - F.col("up")).when(F.col("off") < 0, F.col("up")).otherwise(0)
    usable = (F.col("size") > 0) & (F.col("size") <= F.abs("off"))
    # two NULL sources match
    coins = (
        groups.join(off.select(F.col("source").alias("s"), "off"), F.col("source").eqNullSafe(F.col("s")))
        .groupBy("source", "size")
        .agg(F.sum(F.when(usable, can).otherwise(0)).alias("can"), F.first("off").alias("off"))
        .groupBy("source")
        .agg(F.reverse(F.array_sort(F.collect_list(F.when(F.col("can") > 0, F.struct("size", "can"))))).alias("coins"), F.first("off").alias("off"))
    )
    start = F.struct(F.abs("off").alias("left"), F.expr("CAST(array() AS array<struct<size:bigint,k:bigint>>)").alias("taken"))

    def pay(acc: Column, coin: Column) -> Column:
        k = F.least(coin["can"], F.floor(acc["left"] / coin["size"])).cast("bigint")
        paid = F.struct((acc["left"] - k * coin["size"]).alias("left"), F.concat(acc["taken"], F.array(F.struct(coin["size"].alias("size"), k.alias("k")))).alias("taken"))
        return F.when(k > 0, paid).otherwise(acc)

    paid = coins.select("source", F.signum("off").alias("sign"), F.aggregate("coins", start, pay).alias("p"))
    return paid.select("source", "sign", (F.col("sign") * F.col("p.left")).alias("residual"), F.explode_outer("p.taken").alias("c")).select("source", "residual", F.col("c.size").alias("size"), (F.col("c.k") * F.col("sign").cast("long")).alias("mend"))


def _exchange(groups: DataFrame, mend: DataFrame, most: float) -> DataFrame:
    """mend's rows and, where it helps, a document of one size more and of another size less, either of which may be none.

    For every size that can be taken more often, the size nearest to what the exchange would have to give back is
    met in a sorted run of both, so a source's sizes are gone through once in each direction.
    """
    same = F.col("source").eqNullSafe(F.col("s"))
    per = groups.filter("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"), F.sum("up").alias("up"), F.first("whole").alias("whole"))
    own = mend.filter("size IS NOT NULL").select(F.col("source").alias("s"), F.col("size").alias("z"), "mend")
    left = mend.groupBy(F.col("source").alias("s")).agg(F.first("residual").alias("residual"))
    now = per.join(own, same & (F.col("size") == F.col("z")), "left").withColumn("up", F.col("up") + F.coalesce("mend", F.lit(0))).drop("s", "z").join(left, same).drop("s")
    side = lambda more, size, value: F.struct(F.lit(more).alias("more"), size.cast("long").alias("size"), value.cast("double").alias("value"))
    more = F.when((F.col("whole") + 1 <= most) & (F.col("n") > F.col("up")), side(True, F.col("size"), F.col("size") - F.col("residual")))
    less = F.when(F.col("up") > 0, side(False, F.col("size"), F.col("size")))
    none = left.select(F.col("s").alias("source"), "residual", F.array(side(True, F.lit(0), -F.col("residual")), side(False, F.lit(0), F.lit(0))).alias("sides"))
    sides = now.select("source", "residual", F.array(more, less).alias("sides")).unionByName(none).select("source", "residual", F.explode("sides").alias("x")).filter("x IS NOT NULL").select("source", "residual", "x.*")
    given = F.when(~F.col("more"), F.col("size"))
    up, down = (Window.partitionBy("source").orderBy(o, "more").rowsBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc("value"), F.desc("value")))
    near = sides.withColumn("below", F.last(given, True).over(up)).withColumn("above", F.last(given, True).over(down)).filter("more")
    pairs = near.select("source", "residual", F.col("size").alias("a"), F.explode(F.array("below", "above")).alias("b")).filter("b IS NOT NULL")
    best = pairs.groupBy("source").agg(F.min(F.struct(F.abs(F.col("residual") - F.col("a") + F.col("b")).alias("gap"), "a", "b")).alias("x"), F.first("residual").alias("residual"))
    best = best.withColumn("helps", F.col("x.gap") < F.abs("residual") - 1e-6)
    after = best.select(F.col("source").alias("s"), F.when(F.col("helps"), F.col("residual") - F.col("x.a") + F.col("x.b")).otherwise(F.col("residual")).alias("left"))
    changes = best.filter("helps").select("source", F.explode(F.array(F.struct(F.col("x.a").alias("size"), F.lit(1).cast("long").alias("mend")), F.struct(F.col("x.b").alias("size"), F.lit(-1).cast("long").alias("mend")))).alias("c")).select("source", "c.*").filter("size > 0")
    total = mend.select("source", "size", "mend").unionByName(changes).groupBy("source", "size").agg(F.sum("mend").alias("mend"))
    return total.join(after, same).select("source", F.col("left").alias("residual"), "size", "mend")


def mix(df: DataFrame, key: str, text: str, source: str, weights: list[float], most: float = 3.0) -> DataFrame:
    """df's keys with source, size, source_size, target, rate, copies and the source's residual: the whole mix.

    Only the words of a text are counted, once; the rest works on slim rows.
    """
    docs = df.select(F.col(key), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), uid(F.lit(17), F.col(key)).alias("h"))
    docs = stash(docs, "sizes")
    sizes = stash(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "groups")
    goal = stash(targets(sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("total")), weights, most), "targets")
    goal = multipliers(sizes, goal, most)

    hot = stash(sizes.filter(F.col("n") > HOT).select(F.col("source").alias("s"), F.col("size").alias("z"), F.ceil(F.col("n") / HOT).alias("bins")), "hot")
    same = docs["source"].eqNullSafe(F.col("s")) & (docs["size"] == F.col("z"))
    docs = docs.join(hot, same, "left").withColumn("bin", F.coalesce(F.pmod("h", "bins"), F.lit(0)).cast("long")).drop("s", "z", "bins")

    # running totals of the parts due in two levels: over a source's sizes, then over a size's bins; counts are whole, so reruns agree
    levels = sizes.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rate", rate_of(most))
    levels = levels.withColumn("whole", F.floor("rate").cast("long")).withColumn("part", F.col("rate") - F.floor("rate"))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.withColumn("start", F.coalesce(F.sum(F.col("n") * F.col("part")).over(larger), F.lit(0.0)))
    levels = levels.withColumnsRenamed({"source": "s", "size": "z"}).drop("n")
    groups = docs.groupBy("source", "size", "bin").agg(F.count("*").alias("n"))
    groups = groups.join(levels, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    upto = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    due, earlier = F.col("start") + F.col("upto") * F.col("part"), F.col("start") + (F.col("upto") - F.col("n")) * F.col("part")
    groups = groups.withColumn("upto", upto).withColumn("up", F.least(F.greatest(F.round(due) - F.round(earlier), F.lit(0)), F.col("n")).cast("long"))
    groups = stash(groups.drop("upto", "start", "part"), "groups")

    mend = stash(_exchange(groups, stash(_mend(groups, most), "mend"), most), "mend")
    room = F.when(F.col("mend") > 0, F.when(F.col("whole") + 1 <= most, F.col("n") - F.col("up")).otherwise(0)).otherwise(F.col("up"))
    in_size = Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    left = mend.groupBy(F.col("source").alias("s")).agg(F.first("residual").alias("residual"))
    # a mend goes to the bins of its size in turn, each as far as it has room
    mended = (
        groups.join(mend.filter("size IS NOT NULL").select(F.col("source").alias("s"), F.col("size").alias("z"), "mend"), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
        .drop("s", "z")
        .withColumn("mend", F.coalesce("mend", F.lit(0)))
        .withColumn("room", room)
        .withColumn("gone", F.coalesce(F.sum("room").over(in_size), F.lit(0)))
        .withColumn("own", F.greatest(F.lit(0), F.least(F.col("room"), F.abs("mend") - F.col("gone"))) * F.signum("mend").cast("long"))
        .join(left, F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bin").alias("b"), "total", "target", "rate", "whole", (F.col("up") + F.col("own")).alias("up"), "residual")
    )
    match = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bin") == F.col("b"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy("h", key))
    return (
        docs.join(mended, match)
        .withColumn("copies", F.col("whole") + F.when(rank <= F.col("up"), 1).otherwise(0))
        .select(key, "source", "size", F.col("total").alias("source_size"), "target", "rate", "copies", "residual")
    )


def expand(df: DataFrame, mixed: DataFrame, key: str) -> DataFrame:
    """df with each row as often as the mix takes it; rows that share a number are all taken as often as any of them."""
    plan = mixed.filter("copies > 0").groupBy(F.col(key).alias("_key")).agg(F.max("copies").alias("_copies"))
    out = df.join(plan, F.col(key).eqNullSafe(F.col("_key")))
    return out.select(*df.columns, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy")).drop("_copy")
