"""URL algebra as native column expressions: no Python runs per row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: First path segments that never lead to a provider's page.
NON_PROFILE_ROUTES = ("about", "business", "patient-help", "createuser", "insurance", "specialty", "location", "condition", "procedure", "treatment", "hospital", "practice", "resources", "blog", "techblog")


@dataclass(frozen=True)
class Site:
    """The directory that pages were captured from."""

    origin: str = "https://www.example.org"
    hosts: tuple[str, ...] = ("www.example.org", "example.org")
    index_path: str = "/specialty"
    non_profile_routes: tuple[str, ...] = field(default=NON_PROFILE_ROUTES)


DEFAULT_SITE = Site()

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_EDGES = r"^[\s\x{85}\x{A0}\p{Z}\x1c-\x1f]+|[\s\x{85}\x{A0}\p{Z}\x1c-\x1f]+$"


def _tidy(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), _EDGES, ""), r"[\t\r\n]", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(url), _SCHEME, 1))


def _after_scheme(url: Column) -> Column:
    return F.regexp_replace(_tidy(url), _SCHEME, "")


def netloc(url: Column) -> Column:
    """Host with port and user part, case kept; empty for relative URLs."""
    return F.regexp_extract(_after_scheme(url), r"^//([^/?#]*)", 1)


def raw_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^(?://[^/?#]*)?([^?#]*)", 1)


def normalize_url(url: Column) -> Column:
    """Trimmed, without query, fragment and trailing slashes; a URL without a path gets `/`.

    A blank URL gives `/`: callers drop blanks first.
    """
    path = F.regexp_replace(raw_path(url), "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    host, kind = netloc(url), scheme(url)
    return F.concat(F.when(kind != "", F.concat(kind, F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""), path)


def without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments: each `..` takes the segment before it away, if there is one."""
    parts = F.split(path, "/")
    inner = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda s: s != ".")
    back = lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.array_append(kept, s))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(inner, F.array().cast("array<string>"), back), "/"))


def absolute_url(value: Column, base: Column | str = DEFAULT_SITE.origin) -> Column:
    """The normalised target of a link on a page; blank stays blank. Paths are resolved as RFC 3986 says, those of full URLs stay."""
    base = F.lit(base) if isinstance(base, str) else base
    link = _tidy(value)
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    path = F.regexp_extract(link, "^([^?#]*)", 1)
    folder = F.regexp_replace(raw_path(base), "[^/]*$", "")
    # empty segments go where a relative path is joined to a folder
    below = F.regexp_replace(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), "/{2,}", "/")
    joined = (
        F.when(link.rlike(_SCHEME), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(path == "", F.concat(root, raw_path(base)))
        .otherwise(F.concat(root, without_dots(F.when(path.startswith("/"), path).otherwise(below))))
    )
    return F.when(link == "", F.lit("")).otherwise(normalize_url(joined))


def safe_slug(url: Column) -> Column:
    """The file name under which a page is kept: its path, made safe, and a short digest."""
    clean = normalize_url(url)
    raw = F.regexp_replace(raw_path(clean), "^/+|/+$", "")
    raw = F.when(raw == "", F.lit("home")).otherwise(raw)
    slug = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, "/", "__"), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.concat(slug, F.lit("--"), F.substr(F.sha1(clean.cast("binary")), F.lit(1), F.lit(8)), F.lit(".html"))


def slugged(df: DataFrame, url: str = "url") -> DataFrame:
    """df with `_slug`, a column to join captures by: as a join's key the expression itself would be worked out at every comparison of its sort."""
    return df.withColumn("_slug", safe_slug(F.col(url)))


def base_location_url(url: Column) -> Column:
    """The normalised URL without one trailing page number; a page of the root keeps an empty path."""
    return F.regexp_replace(normalize_url(url), "/[0-9]+$|(?<=[^/:])/$", "")


def page_number(url: Column) -> Column:
    """The number that ends the path, else 1."""
    found = F.regexp_extract(raw_path(url), "/([0-9]+)/?$", 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("int"), F.lit(1))


def profile_path(url: Column, site: Site = DEFAULT_SITE) -> Column:
    full = absolute_url(url, site.origin)
    return F.when(full == "", F.lit("")).otherwise(F.regexp_replace(raw_path(full), "/+$", ""))


def segments(url: Column) -> Column:
    return F.filter(F.split(raw_path(normalize_url(url)), "/"), lambda s: s != "")


def is_index_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return raw_path(normalize_url(url)) == site.index_path


def is_profile_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    """Two segments on an allowed (or no) host, not a listing's location and not a denied route."""
    parts, host = segments(url), F.lower(netloc(url))
    route, slug = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    fits = (F.size(parts) == 2) & ~slug.rlike("(?i)-[0-9]+pm$") & ~F.lower(route).isin(*site.non_profile_routes)
    return F.coalesce((F.when(host == "", True).otherwise(host.isin(*site.hosts))) & fits, F.lit(False))


def is_landing_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return (F.size(segments(url)) == 1) & ~is_index_url(url, site) & ~is_profile_url(url, site)


def is_listing_url(url: Column) -> Column:
    parts = segments(url)
    n = F.size(parts)
    return F.coalesce(((n == 2) | (n == 3) & F.get(parts, F.lit(2)).rlike("^[0-9]+$")) & F.get(parts, F.lit(1)).rlike("-[0-9]+pm$"), F.lit(False))


def page_type(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return (
        F.when(is_index_url(url, site), "specialty_index")
        .when(is_profile_url(url, site), "profile")
        .when(is_landing_url(url, site), "specialty_landing")
        .when(is_listing_url(url), "listing")
        .otherwise("unsupported")
    )


def specialty_slug(url: Column) -> Column:
    return F.regexp_replace(raw_path(normalize_url(url)), "^/+|/+$", "")


def is_catalog_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    parts = segments(url)
    kind = scheme(url).isin("http", "https") & F.lower(netloc(url)).isin(*site.hosts)
    return F.coalesce(kind & (F.size(parts) == 1) & (F.concat(F.lit("/"), F.lower(F.get(parts, F.lit(0)))) != site.index_path), F.lit(False))


def trailing_id(url: Column) -> Column:
    """The number after the last hyphen of a URL, as text; empty if there is none."""
    return F.regexp_extract(url, "-([0-9]+)$", 1)


def file_trailing_id(name: Column) -> Column:
    return F.regexp_extract(name, r"-([0-9]+)--[0-9a-f]{8}\.html$", 1)


def canonical_key(url: Column) -> Column:
    """What a profile URL and the one that it redirects to share: lower-cased route and slug without its number.

    Redirects append `-<number>` to the slug, so equality of this key stands for the pattern match.
    """
    parts = segments(url)
    return F.when(F.size(parts) == 2, F.concat_ws("/", F.lower(F.get(parts, F.lit(0))), F.regexp_replace(F.lower(F.get(parts, F.lit(1))), "-[0-9]+$", "")))


def is_canonical_redirect(requested: Column, canonical: Column) -> Column:
    """Whether the second URL is the first with `-<number>` after its slug; case is ignored."""
    a, b = segments(requested), segments(canonical)
    low = lambda x, k: F.lower(F.get(x, F.lit(k)))
    grown = F.startswith(low(b, 1), F.concat(low(a, 1), F.lit("-"))) & F.substr(low(b, 1), F.length(low(a, 1)) + 2).rlike("^[0-9]+$")
    return F.coalesce((F.size(a) == 2) & (F.size(b) == 2) & (low(a, 0) == low(b, 0)) & grown, F.lit(False))
