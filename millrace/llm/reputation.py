"""URL filters by rules and by empirical-Bayes host reputation.

Outcomes of labelled pages (1 bad, 0 good) are counted by host. Beta-binomial priors shrink a host's
rate of bad pages towards its registered domain's, that one towards its public suffix's, and that one
towards the rate of all pages; each prior's strength comes from the spread of the rates it governs, by
the method of moments. A posterior's variance includes that of the prior it leans on, so that a host with few
pages doesn't pass for certain because its domain's estimate is taken as known. A host is blocked if the lower bound of its posterior rate is above what its
suffix lets expect, times `lift`: only enough bad pages can do that, so unknown and clean hosts stay allowed,
and the limit fits webs of good and of bad repute alike.

Everything is DataFrame code; counts are pre-aggregated, and the join back to pages is one that Spark
can split where a host is hot.

Defined results: a null URL or one without `://` has empty host and path, fits no rule and is allowed
unless its (empty) host has earned a block; labels of unknown pages are ignored; an empty table of
labels allows all that no rule blocks; repeated pages are judged alike; of rules of equal length that fit,
the greater (as host and path) wins; URLs of any length are read whole; other columns pass through, and
ones named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Second-level labels below two-letter suffixes under which names are registered, as in example.co.uk: a default.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, second_level: list[str] = SECOND_LEVEL) -> Column:
    """The last label, or the last two where names are registered below the second."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    two = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(second_level)
    return F.when(two, F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column, second_level: list[str] = SECOND_LEVEL) -> Column:
    """The suffix and the label before it."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.size(F.split(suffix_of(host, second_level), r"\.")) == 2
    return F.when(two, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule, as (rule, verdict); null if none fits. Rules: (verdict, host, path)."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _shrunk(df: DataFrame, level: str, above: str) -> DataFrame:
    """df with `rate` and `var` of each group at a level, shrunk to `prior`, the rate above it, which has a variance itself.

    With rates p_i of n_i pages around m, the method of moments gives the prior's strength a + b from
    the rates' weighted variance in excess of what pages' chance alone would give.
    """
    n, p, m = F.col("n"), F.col("bad") / F.col("n"), F.col("prior")
    chance = m * (1 - m)
    moments = df.groupBy(F.col(above).alias("_up")).agg(
        F.sum(n * F.pow(p - m, F.lit(2))).alias("spread"), F.sum("n").alias("pages"), F.sum(n * n).alias("squares"), F.count("*").alias("k"), F.first(chance).alias("chance")
    )
    between = (F.col("spread") - (F.col("k") - 1) * F.col("chance")) / F.greatest(F.col("pages") - F.col("squares") / F.col("pages"), F.lit(1e-9))
    strength = F.when(F.col("k") < 2, 10.0).when(between <= F.col("chance") / 1000, 1000.0).otherwise(F.greatest(F.lit(2.0), F.col("chance") / between - 1))
    moments = moments.select("_up", F.coalesce(strength, F.lit(10.0)).alias("strength"))
    total = F.col("strength") + F.col("n")
    rate = (F.col("prior") * F.col("strength") + F.col("bad")) / total
    var = F.col("rate") * (1 - F.col("rate")) / (total + 1) + F.pow(F.col("strength") / total, F.lit(2)) * F.col("prior_var")
    return df.join(moments, F.col(above) == F.col("_up")).drop("_up").withColumn("rate", rate).withColumn("var", var)


def reputations(outcomes: DataFrame, z: float = 2.326, second_level: list[str] = SECOND_LEVEL) -> DataFrame:
    """host, bad -> host, n, n_bad, rate, the lower bound of its posterior, and the rate of its suffix.

    The bound is `z` posterior standard deviations below the mean; it is meant against the suffix's rate, taken as known.
    """
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), second_level)).withColumn("suffix", suffix_of(F.col("host"), second_level))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("all", F.lit("*"))
    # one number; the smoothing keeps the rate off 0 and 1
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    top = _shrunk(suffixes.withColumn("prior", F.lit(((bad or 0) + 0.5) / ((n or 0) + 1))).withColumn("prior_var", F.lit(0.0)), "suffix", "all")
    top = top.select(F.col("suffix").alias("_s"), F.col("rate").alias("prior"), F.lit(0.0).alias("prior_var"), F.col("rate").alias("expected"))
    middle = _shrunk(domains.join(top, F.col("suffix") == F.col("_s")).drop("_s"), "domain", "suffix").select(F.col("domain").alias("_d"), F.col("rate").alias("prior"), F.col("var").alias("prior_var"), "expected")
    own = _shrunk(hosts.join(middle, F.col("domain") == F.col("_d")).drop("_d"), "host", "domain")
    bound = F.col("rate") - z * F.sqrt("var")
    return own.select("host", "n", F.col("bad").alias("n_bad"), "rate", bound.alias("bound"), "expected")


def judge(pages: DataFrame, url: str, outcomes: DataFrame, rules: list[tuple[str, str, str]], lift: float = 1.0, z: float = 2.326, second_level: list[str] = SECOND_LEVEL) -> DataFrame:
    """pages with host, path, rule and verdict; outcomes: (url, bad) of labelled pages."""
    judged = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    known = reputations(outcomes.select(host_of(F.col("url")).alias("host"), "bad"), z, second_level).filter(F.col("bound") > lift * F.col("expected")).select(F.col("host").alias("_h"), F.lit(True).alias("_bad"))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.join(known, F.col("host") == F.col("_h"), "left").withColumn("_fit", fit)
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("_bad"), "block").otherwise("allow"))
    return judged.withColumn("rule", F.col("_fit.rule")).withColumn("verdict", verdict).drop("_h", "_bad", "_fit")
