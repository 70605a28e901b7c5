"""Gates, evidence and page classes as native expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGES = 500

#: What pages say when they are empty, restricted or gone; compared lower-cased.
EMPTY_MARKERS = ("no providers found", "no results found", "we couldn't find any", "we could not find any", "there are no providers", "0 verified providers")
RESTRICTION_MARKERS = ("verify you are human", "captcha", "access denied", "unusual traffic", "security check", "just a moment")
CHALLENGE_MARKERS = {
    "verify you are human": "human-verification message",
    "are you a human": "human-verification message",
    "access is temporarily restricted": "temporary-access restriction",
    "automated (bot) activity": "automated-activity restriction",
    "unusual activity": "unusual-activity restriction",
}
WALL = r"(?i)enable\s+(?:javascript|js)\s+and\s+disable\s+(?:any\s+|your\s+|the\s+)?ad[\s-]*block(?:er|ers|ing)?"
GONE = r"not found\.?\s*redirecting to\s*/404(?:\s|$|[.])"
HOME = r"not found\.?\s*redirecting to\s*/(?:\s|$|[.])"


def first_marker(text: Column, markers: tuple[str, ...]) -> Column:
    """The first of the markers that the text contains, else null."""
    out = F.lit(None).cast("string")
    for m in reversed(markers):
        out = F.when(F.contains(text, F.lit(m)), F.lit(m)).otherwise(out)
    return out


def unavailable_reason(text: Column, title: Column) -> Column:
    """An explicit 404 of a listing; a restriction marker anywhere vetoes it. Both lower-cased."""
    page = title.rlike(r"\b404\s+error\b") & F.contains(text, F.lit("well, this is unexpected")) & F.contains(text, F.lit("this page may no longer be available"))
    return F.when(first_marker(text, RESTRICTION_MARKERS).isNotNull(), F.lit(None)).when(text.rlike(GONE), "explicit /404 redirect").when(page, "explicit 404 error page")


def wall_reason(visible: Column, has_provider: Column) -> Column:
    """A JavaScript or ad-block wall in visible text, unless provider content is there."""
    return F.when(~has_provider & visible.rlike(WALL), "JavaScript/ad-block verification page")


def listing_class(text: Column, title: Column, visible: Column, n_doctors: Column, total: Column) -> Column:
    """(class, reason) of a listing capture; the order of tests matters. text, title: lower-cased."""
    wall, gone = wall_reason(visible, n_doctors > 0), unavailable_reason(text, title)
    empty, restricted = first_marker(text, EMPTY_MARKERS), first_marker(text, RESTRICTION_MARKERS)
    # fixed values: the reasons' wording, which stored results are compared by
    pair = lambda k, r: F.struct(F.lit(k).alias("class"), r.alias("reason"))
    return (
        F.when(wall.isNotNull(), pair("restriction_like", wall))
        .when(gone.isNotNull(), pair("unavailable", gone))
        .when(n_doctors > 0, pair("valid", F.lit("provider links found")))
        .when(total == 0, pair("valid_empty", F.lit("advertised provider total is explicitly zero")))
        .when(empty.isNotNull(), pair("valid_empty", F.concat(F.lit("explicit empty-results marker: "), empty)))
        .when(restricted.isNotNull(), pair("restriction_like", F.concat(F.lit("restriction-like marker: "), restricted)))
        .otherwise(pair("retry_zero", F.lit("no provider links and no explicit empty-results marker")))
    )


def challenge_reason(html_lower: Column, visible: Column, has_name: Column, has_provider: Column, has_frame: Column) -> Column:
    """Why a profile capture is a verification page, else null; a provider's name rules it out."""
    out = F.when(has_frame, "challenge frame")
    for marker, reason in reversed(CHALLENGE_MARKERS.items()):
        out = F.when(F.contains(html_lower, F.lit(marker)), reason).otherwise(out)
    wall = wall_reason(visible, has_provider)
    return F.when(has_name, F.lit(None)).when(wall.isNotNull(), wall).otherwise(out)


def profile_unavailable_reason(text: Column, final_path: Column) -> Column:
    """A profile that is gone; text lower-cased, final_path: where the browser ended."""
    not_found = F.contains(text, F.lit("not found. redirecting to /404")) | F.contains(text, F.lit("not found. redirecting to/404"))
    return F.when(F.regexp_replace(final_path, "/+$", "") == "/404", "profile returned /404").when(not_found, "profile returned /404").when(text.rlike(HOME), "not found, homepage redirect")


# ---- completeness


def contiguity_gate(pages: DataFrame, target: list[str], page: str, valid: Column, n_items: Column) -> DataFrame:
    """Per target: n_pages, max_page and `complete`: pages 1..max all there, all valid, none but the last empty. One pass."""
    empty = F.min(F.when(n_items <= 0, F.col(page)))
    found = pages.groupBy(*target).agg(F.count_distinct(page).alias("n_pages"), F.max(page).alias("max_page"), F.min(page).alias("_min"), F.bool_and(valid).alias("_valid"), empty.alias("_empty"))
    full = (F.col("n_pages") == F.col("max_page")) & (F.col("_min") == 1) & F.col("_valid") & (F.coalesce("_empty", "max_page") == F.col("max_page")) & (F.col("max_page") <= MAX_PAGES)
    return found.withColumn("complete", full).drop("_min", "_valid", "_empty")


def missing_pages(pages: DataFrame, target: list[str], page: str) -> DataFrame:
    """Page numbers below each target's largest that were not captured."""
    due = pages.groupBy(*target).agg(F.max(page).alias("_max")).select(*target, F.explode(F.sequence(F.lit(1), F.col("_max"))).alias(page))
    return due.join(pages.select(*target, page).distinct(), [*target, page], "left_anti")


def coverage(expected: DataFrame, found: DataFrame, group: list[str], item: str) -> DataFrame:
    """Per group: expected items, those missing among the found, and the status."""
    have = found.select(*group, item).distinct().withColumn("_found", F.lit(True))
    joined = expected.select(*group, item).distinct().join(have, [*group, item], "left")
    missing = F.count_if(F.col("_found").isNull())
    return joined.groupBy(*group).agg(F.count("*").alias("n_expected"), missing.alias("n_missing"), F.when(missing == 0, "parsed").otherwise("trace_partial").alias("status"))


# ---- evidence: aggregates over a provider's appearances


def unanimous(flag: Column) -> Column:
    """Aggregate: the flag if all known values agree, else null."""
    return F.when(F.min(flag) == F.max(flag), F.min(flag))


def any_true(*flags: Column) -> Column:
    """Aggregate: true if any value of any flag is; never false by inference."""
    out = F.bool_or(F.coalesce(flags[0], F.lit(False)))
    for f in flags[1:]:
        out = out | F.bool_or(F.coalesce(f, F.lit(False)))
    return F.nullif(out, F.lit(False))


def appointments(listing: Column, conflict: Column, bookable: Column, preview: Column, marketplace: Column) -> Column:
    """(value, source): the listings' unanimous flag, else bookable, else preview or closed marketplace mean false."""
    pair = lambda v, s: F.struct(v.cast("boolean").alias("value"), F.lit(s).alias("source"))
    return (
        F.when(listing.isNotNull(), pair(listing, "listing"))
        .when(bookable.isNotNull() & conflict, pair(bookable, "bookable_after_listing_conflict"))
        .when(bookable.isNotNull(), pair(bookable, "bookable"))
        .when(preview, pair(F.lit(False), "preview"))
        .when(~marketplace, pair(F.lit(False), "marketplace"))
        .otherwise(pair(F.lit(None), "unresolved"))
    )


def telemedicine(positive: dict[str, Column], negative: dict[str, Column]) -> Column:
    """(value, evidence): any positive wins, else any explicit negative; evidence names what spoke, in order."""
    named = lambda d: F.array_distinct(F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in d.items())), lambda x: x.isNotNull()))
    pos, neg = named(positive), named(negative)
    pair = lambda v, e: F.struct(v.alias("value"), e.alias("evidence"))
    return F.when(F.size(pos) > 0, pair(F.lit(True), F.array_join(pos, "; "))).when(F.size(neg) > 0, pair(F.lit(False), F.array_join(neg, "; "))).otherwise(pair(F.lit(None).cast("boolean"), F.lit("")))


def delivery_gate(n_profiles: Column, n_open_pages: Column, n_conflicts: Column, n_review: Column) -> Column:
    """Ready only with a profile, no page still open, no conflicting duplicate and nothing to review."""
    return (n_profiles >= 1) & (n_open_pages == 0) & (n_conflicts == 0) & (n_review == 0)
