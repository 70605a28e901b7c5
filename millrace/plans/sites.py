"""Captured directory pages made from the driver's tables, and every parser, export and report over them.

Suppliers stand for providers, those of a nation among RANGE numbers for the listing of a town, regions for specialties.
Pages are written as HTML with native expressions and read back by the parsers, so that SQL on the tables says what must
come out. There are more pages where there are more suppliers, and none grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import url as U
from millrace.functions.url import DEFAULT_SITE
from millrace.operators import quality, queue, repairs, trace
from millrace.plans import providers, reports
from millrace.plans.registry import query, read
from millrace.sources import captures, state
from millrace.sources.dom import parse, select

ORIGIN = DEFAULT_SITE.origin
NOW = "2024-06-01 00:00:00"
#: Numbers of suppliers that share the towns of 25 nations: some twenty suppliers a listing.
RANGE = 500


def _say(*parts: Column | str) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def _key(c: str) -> Column:
    return F.col(c).cast("string")


def _script(json: Column) -> Column:
    """The application state as pages carry it: JSON inside a JavaScript string."""
    quoted = F.replace(F.replace(json, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return _say('<script>window.__REDUX_STATE__ = JSON.parse("', quoted, '");</script>')


def _zip(c: str) -> Column:
    return F.lpad((F.col(c) % 100000).cast("string"), 5, "0")


def _path(c: str) -> Column:
    return _say("/dentist/supplier-", _key(c))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, name, n (the nation), r (the region) and t (the town) of every supplier."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_regionkey").alias("r"))
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"), (F.floor(F.col("s_suppkey") / RANGE) * 25 + F.col("s_nationkey")).cast("long").alias("t")).join(F.broadcast(nation), "n")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing for each town: url, html, specialty_slug, specialty_name, state_group, location."""
    item = lambda name, value: _say(f'<span itemprop="{name}">', value, "</span>")
    card = _say(
        '<article data-test="search-result-item"><a data-test="doctor-card-info-name" href="', _path("k"), '">', F.col("name"), '</a><div data-test="doctor-card-info-location">',
        item("streetAddress", _say(_key("k"), " Main St,")), item("addressLocality", _say("Town ", _key("n"))), item("addressRegion", F.lit("XY")), item("postalCode", _zip("k")), "</div>",
        F.when(F.col("k") % 2 == 0, '<i data-test="video-visits-text">video</i>').otherwise(""), "</article>",
    )
    provider = F.struct(_path("k").alias("profileUrl"), _say("p", _key("k")).alias("id"), (F.col("k") % 3 == 0).alias("acceptsNewPatients"))
    entry = F.struct(_say("p", _key("k"), "|", _key("n")).alias("id"), provider.alias("provider"), F.struct(_key("n").alias("id"), _zip("k").alias("zipCode")).alias("location"))
    shown = suppliers(spark, sf_dir).select("t", "n", "r", F.struct("k", card.alias("card"), entry.alias("entry")).alias("s"))
    town = shown.groupBy("t", "n", "r").agg(F.array_sort(F.collect_list("s")).alias("s"))
    address = _say(ORIGIN + "/dentists/town", _key("t"), "-", _key("t"), "pm")
    html = _say(
        "<html><title>Dentists</title><body>", '<div data-test="selection-criteria-header"><h1>', F.size("s").cast("string"), " verified Dentists in Town ", _key("n"), ", XY</h1></div>", F.array_join("s.card", ""),
        '<nav data-test="search-results-pagination"><a href="', address, '/3">3</a><a href="', address, '/2">2</a><a href="/other/town-6pm/2">x</a></nav>', _script(F.to_json(F.struct(F.col("s.entry").alias("listing")))), "</body></html>",
    )
    slug = F.when(F.col("r") % 2 == 0, "dentists").otherwise("doctors")
    return town.select(address.alias("url"), html.alias("html"), slug.alias("specialty_slug"), F.initcap(slug).alias("specialty_name"), _say("Region ", _key("r")).alias("state_group"), _say("Town ", _key("n")).alias("location"))


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile for each supplier, with one to three locations: doctor_url, url, html."""
    j = lambda x: x.cast("string")
    place = lambda x: F.struct(
        _say("l", _key("k"), "-", j(x)).alias("id"),
        _say(j(x + 1), " Oak Rd").alias("address1"),
        _say("Town ", _key("n")).alias("city"),
        F.element_at(F.array(*map(F.lit, ("OH", "IA", "TX"))), (F.col("n") % 3).cast("int") + 1).alias("state"),
        F.lpad(((F.col("k") + x * 1000) % 100000).cast("string"), 5, "0").alias("zipCode"),
        F.when(x < 2, x == 1).alias("isVirtual"),
    )
    provider = F.struct(
        _say("p", _key("k")).alias("id"),
        F.lpad(_key("k"), 10, "1").alias("npi"),
        _path("k").alias("profileUrl"),
        _say("Dr. Ada ", F.replace("name", F.lit("#"), F.lit("")), ", MD").alias("approvedFullName"),
        (F.col("k") % 100).cast("int").alias("reviewCount"),
        F.when(F.col("k") % 4 < 2, F.col("k") % 4 == 0).alias("isBookable"),
        F.when(F.col("k") % 5 == 0, F.lit(False)).alias("offersTelemedicine"),
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("k") % 3), place).alias("approvedLocations"),
        F.array(F.struct(F.lit("General").alias("name")), F.struct(_say("Town ", _key("n")).alias("name"))).alias("hospitalAffiliations"),
    )
    whole = F.to_json(F.struct(F.struct(F.struct(provider.alias("provider")).alias("data")).alias("profile")))
    html = _say("<html><head>", '<link rel="canonical" href="', _path("k"), '"></head><body>', _script(whole), '<h1 data-test="provider-name">', F.col("name"), "</h1></body></html>")
    address = _say(ORIGIN, _path("k"))
    return suppliers(spark, sf_dir).select(address.alias("doctor_url"), _say(address, "?from=list").alias("url"), html.alias("html"))


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures.trace_rows(listing_pages(spark, sf_dir))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.provider_rows(captures.profiles(profile_pages(spark, sf_dir)), appearances(spark, sf_dir))


#: What SQL knows of providers, of their appearances and of their locations.
S = "SELECT s_suppkey AS k, s_name AS name, s_nationkey AS n, n_regionkey AS r, s_suppkey // 500 * 25 + s_nationkey AS t, 'https://www.example.org/dentist/supplier-' || s_suppkey AS url, CASE WHEN n_regionkey % 2 = 0 THEN 'dentists' ELSE 'doctors' END AS slug, 'https://www.example.org/dentists/town' || (s_suppkey // 500 * 25 + s_nationkey) || '-' || (s_suppkey // 500 * 25 + s_nationkey) || 'pm' AS page, lpad((s_suppkey % 100000)::VARCHAR, 5, '0') AS zip FROM supplier JOIN nation ON n_nationkey = s_nationkey"
L = f"SELECT *, 'l' || k || '-' || j AS location_id, lpad(((k + j * 1000) % 100000)::VARCHAR, 5, '0') AS postal, CASE n % 3 WHEN 0 THEN 'OH' WHEN 1 THEN 'IA' ELSE 'TX' END AS st, CASE WHEN j < 2 THEN j = 1 END AS virtual, CASE WHEN j = 0 THEN 'p' || k || '|' || n ELSE 'p' || k || '|l' || k || '-' || j END AS lkey FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS j FROM ({S}))"


# ---- parsers


@query(f"SELECT page AS url, count(*)::INTEGER AS n_doctors, arg_min(url, k) AS first_url, arg_min(name, k) AS first_name, page || '/2' AS next_page, 2 AS n_pages, count(*)::INTEGER AS advertised_total FROM ({S}) GROUP BY page")
def parse_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = captures.listings(listing_pages(spark, sf_dir))
    return got.select("url", F.size("doctors").alias("n_doctors"), F.col("doctors")[0]["doctor_url"].alias("first_url"), F.col("doctors")[0]["doctor_name"].alias("first_name"), F.col("pagination_urls")[0].alias("next_page"), F.size("pagination_urls").alias("n_pages"), "advertised_total")


@query(f"""
SELECT page AS listing_url, slug AS listing_specialty_slug, 1 AS listing_page_no, (row_number() OVER (PARTITION BY page ORDER BY k))::INTEGER AS card_index, url AS doctor_url, name AS doctor_name, k || ' Main St' AS address_line_1,
  'Town ' || n AS city, zip AS postal_code, 'p' || k AS provider_id, 'p' || k || '|' || n AS provider_location_key, k % 2 = 0 AS listing_offers_video_visits, k % 3 = 0 AS structured_accepts_new_patients, NULL::BOOLEAN AS structured_offers_telemedicine FROM ({S})
""")
def parse_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return appearances(spark, sf_dir).select(
        "listing_url", "listing_specialty_slug", "listing_page_no", "card_index", "doctor_url", "doctor_name", "address_line_1", "city", "postal_code", "provider_id", "provider_location_key",
        "listing_offers_video_visits", "structured_accepts_new_patients", "structured_offers_telemedicine",
    )


@query(f"""
SELECT url AS doctor_url, url AS profile_url, 'Dr. Ada ' || replace(name, '#', '') || ', MD' AS full_name, 'p' || k AS provider_id, lpad(k::VARCHAR, 10, '1') AS npi, (k % 100)::VARCHAR AS review_count,
  CASE WHEN k % 4 < 2 THEN k % 4 = 0 END AS is_bookable, CASE WHEN k % 5 = 0 THEN false END AS offers_telemedicine, (k % 3 + 1)::INTEGER AS n_locations, 'General, Town ' || n AS hospitals FROM ({S})
""")
def parse_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = captures.profiles(profile_pages(spark, sf_dir)).select("doctor_url", "profile.*")
    return p.select("doctor_url", "profile_url", "full_name", "provider_id", "npi", "review_count", "is_bookable", "offers_telemedicine", F.size("locations").alias("n_locations"), F.array_join("hospital_affiliations", ", ").alias("hospitals"))


@query(f"SELECT url AS doctor_url, location_id, (j + 1) || ' Oak Rd' AS address_line_1, 'Town ' || n AS city, st AS state, postal AS postal_code, virtual AS is_virtual_location FROM ({L})")
def parse_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = captures.profiles(profile_pages(spark, sf_dir)).select("doctor_url", F.explode("profile.locations").alias("l"))
    return p.select("doctor_url", "l.location_id", "l.address_line_1", "l.city", "l.state", "l.postal_code", "l.is_virtual_location")


@query("SELECT 'https://www.example.org/specialty' AS url, 'Kind ' || n_name || CASE WHEN n_nationkey % 5 = 0 THEN ' Clinics' ELSE '' END AS specialty_name, 'kind-' || n_nationkey AS specialty_slug, CASE WHEN n_nationkey % 5 = 0 THEN 'facility_or_clinic' ELSE 'provider_specialty' END AS entity_type FROM nation")
def parse_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    clinic = F.when(F.col("n_nationkey") % 5 == 0, " Clinics").otherwise("")
    link = _say('<li><a href="/kind-', _key("n_nationkey"), '">Kind ', F.col("n_name"), clinic, "</a></li>")
    items = read(spark, sf_dir, "nation").agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("items"))
    html = _say('<header><a href="/login">x</a></header><h2>Browse All Specialties</h2><ul>', F.col("items"), '</ul><footer><a href="/about">y</a></footer>')
    return captures.catalog(items.select(F.lit(ORIGIN + "/specialty").alias("url"), html.alias("html"))).select("url", "specialty_name", "specialty_slug", "entity_type")


@query("""
SELECT 'https://www.example.org/kind-' || r_regionkey AS specialty_url, 'kind-' || r_regionkey AS specialty_slug, 's' || r_regionkey AS specialty_id, CASE WHEN n_nationkey % 2 = 0 THEN 'Even' ELSE 'Odd' END AS state_group,
  n_name AS location, 'https://www.example.org/kind-' || r_regionkey || '/town-' || n_nationkey || 'pm' AS listing_url FROM region JOIN nation ON n_regionkey = r_regionkey
""")
def parse_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = _say('<a href="/kind-', _key("n_regionkey"), "/town-", _key("n_nationkey"), 'pm">', F.col("n_name"), "</a>")
    group = F.when(F.col("n_nationkey") % 2 == 0, "Even").otherwise("Odd")
    part = read(spark, sf_dir, "nation").groupBy("n_regionkey", group.alias("g")).agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("links"))
    section = _say('<div data-test="expandable-list-section-', F.col("g"), '"><div role="button">', F.col("g"), '</div><div data-test="expandable-list-section-list">', F.col("links"), '<a href="/else/c-3pm">C</a></div></div>')
    region = part.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(section)), "").alias("sections"))
    own = _say("/kind-", _key("n_regionkey"))
    search = F.struct(F.struct(F.struct(own.alias("url"), F.lit("specialty").alias("searchType"), _say("s", _key("n_regionkey")).alias("specialtyId")).alias("parameters")).alias("search"))
    html = _say(_script(F.to_json(search)), '<div data-test="tab-panel-location">', F.col("sections"), "</div>")
    return captures.landings(region.select(_say(ORIGIN, own).alias("url"), html.alias("html"))).select("specialty_url", "specialty_slug", "specialty_id", "state_group", "location", "listing_url")


@query(f"SELECT page AS url, 'dentists' AS specialty, 'Town ' || n || ', XY' AS location, count(*)::INTEGER AS count FROM ({S}) GROUP BY page, n")
def verified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures.verified_counts(listing_pages(spark, sf_dir).select("url", "html")).select("url", "specialty", "location", "count")


_STATE = schema.struct(n_objects=schema.T.IntegerType(), first_id=schema.T.StringType())


def _state_of(html: str, _: str) -> dict:
    found = state.embedded_state(html)
    return {"n_objects": sum(1 for _ in state.dicts(found)), "first_id": next((d["id"] for d in state.dicts(found) if "id" in d), None)}


@query(f"SELECT page AS url, (1 + 3 * count(*))::INTEGER AS n_objects, arg_min('p' || k || '|' || n, k) AS first_id FROM ({S}) GROUP BY page")
def embedded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that a page carries, and all objects in it, parents first."""
    got = captures.parsed(listing_pages(spark, sf_dir).select("url", "html"), _state_of, _STATE, "s")
    return got.select("url", F.get("s", F.lit(0)).alias("s")).select("url", "s.*")


def _preferred(html: str, url: str) -> dict:
    found = state.Providers(state.embedded_state(html))
    provider, entry = found.best(url, "00500")
    return {"provider_id": provider.get("id"), "entry_id": entry.get("id")}


@query(f"SELECT url, 'p' || k AS provider_id, 'p' || k || CASE k % 3 WHEN 0 THEN '|near' WHEN 1 THEN '|a' ELSE '' END AS entry_id FROM ({S})")
def structured_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several objects about one provider: the one at the ZIP asked for, else the first that names a location, else an entry."""
    own = F.struct(_path("k").alias("profileUrl"), _say("p", _key("k")).alias("id"))
    entry = lambda suffix, postal: F.struct(_say("p", _key("k"), suffix).alias("id"), own.alias("provider"), F.struct(F.lit(postal).alias("zipCode")).alias("location"))
    plain, first, second, near = entry("", "1"), entry("|a", "2"), entry("|b", "3"), entry("|near", "00500")
    which = F.when(F.col("k") % 3 == 0, F.array(first, near, second)).when(F.col("k") % 3 == 1, F.array(plain, first, second)).otherwise(F.array(plain))
    html = _script(F.to_json(F.struct(own.alias("bare"), which.alias("listing"))))
    df = suppliers(spark, sf_dir).select(_say(ORIGIN, _path("k")).alias("url"), html.alias("html"))
    got = captures.parsed(df, _preferred, schema.struct(**schema.texts("provider_id", "entry_id")), "s")
    return got.select("url", F.get("s", F.lit(0)).alias("s")).select("url", "s.*")


@query(f"SELECT url, 'p' || k AS provider_id, CASE k % 3 WHEN 0 THEN 'page' WHEN 1 THEN 'place' ELSE 'fullest' END AS found FROM ({S})")
def profile_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provider of a profile page: in the usual places in turn, else the fullest object with its URL."""
    about = lambda found, *more: F.struct(_path("k").alias("profileUrl"), _say("p", _key("k")).alias("id"), F.lit(found).alias("kind"), *more)
    other = F.struct(F.lit("/dentist/someone-else").alias("profileUrl"), F.lit("x").alias("id"))
    more = lambda npi, statement: (F.lit(npi).cast("string").alias("npi"), F.lit(statement).cast("string").alias("statement"))
    rest = F.array(about("thin", *more(None, None)), about("fullest", *more("1", "s")), about("thinner", *more("2", None)))
    on_page = F.struct(F.struct(F.struct(F.when(F.col("k") % 3 == 0, about("page")).alias("provider")).alias("data"), F.when(F.col("k") % 3 == 1, about("place")).otherwise(F.struct(other["profileUrl"], other["id"], F.lit("no").alias("kind"))).alias("provider")).alias("profile"), rest.alias("rest"))
    df = suppliers(spark, sf_dir).select(_say(ORIGIN, _path("k")).alias("url"), _script(F.to_json(on_page)).alias("html"))

    def pick(html: str, url: str) -> dict:
        got = state.profile_provider(state.embedded_state(html), url)
        return {"provider_id": got.get("id"), "found": got.get("kind")}

    got = captures.parsed(df, pick, schema.struct(**schema.texts("provider_id", "found")), "s")
    return got.select("url", F.get("s", F.lit(0)).alias("s")).select("url", "s.*")


@query("SELECT page_id, len(regexp_extract_all(html, '<p>'))::INTEGER AS n_paragraphs, len(regexp_extract_all(html, '<a [^>]*href='))::INTEGER AS n_links FROM pages")
def page_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that selectors find in the tree of every captured page."""
    kind = schema.struct(n_paragraphs=schema.T.IntegerType(), n_links=schema.T.IntegerType())

    def count(html: str, _: str) -> dict:
        tree = parse(html)
        return {"n_paragraphs": sum(1 for _ in select(tree, "p")), "n_links": sum(1 for _ in select(tree, "a[href]"))}

    got = captures.parsed(read(spark, sf_dir, "pages").select("page_id", "url", "html"), count, kind, "s")
    return got.select("page_id", F.get("s", F.lit(0)).alias("s")).select("page_id", "s.*")


# ---- classes of captures


@query(f"""
SELECT page AS url, CASE WHEN n % 5 = 0 THEN 'valid_empty' WHEN n % 5 = 1 THEN 'retry_zero' ELSE 'valid' END AS class, CASE WHEN n % 5 < 2 THEN 0 ELSE count(*) END::INTEGER AS n_doctors, n % 5 <> 1 AS has_hash FROM ({S}) GROUP BY page, n
""")
def listing_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of captured listings: with providers, validly empty, and empty without saying so."""
    town = F.regexp_extract("url", r"town(\d+)-", 1).cast("int") % 5
    none = F.lit('<html><title>Dentists</title><body><div data-test="selection-criteria-header"><h1>0 verified Dentists in Town</h1></div></body></html>')
    silent = F.lit("<html><title>Dentists</title><body><p>Something went on</p></body></html>")
    held = listing_pages(spark, sf_dir).withColumn("html", F.when(town == 0, none).when(town == 1, silent).otherwise(F.col("html")))
    got = trace.page_results(captures.listings(held), F.lit(NOW).cast("timestamp"))
    return got.select("url", "class", "n_doctors", F.col("provider_set_hash").isNotNull().alias("has_hash"))


@query(f"SELECT url, k % 3 = 2 AS has_name, CASE k % 3 WHEN 0 THEN 'profile returned /404' END AS reason FROM ({S})")
def profile_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles that are gone, by the text of their capture."""
    gone = F.lit("<html><body>Not found. Redirecting to /404</body></html>")
    held = profile_pages(spark, sf_dir).withColumn("k", F.regexp_extract("doctor_url", r"(\d+)$", 1).cast("long") % 3)
    held = held.withColumn("html", F.when(F.col("k") == 0, gone).when(F.col("k") == 1, "<p>no name</p>").otherwise(F.col("html")))
    said = captures.profile_signals(held.select("doctor_url", "url", "html"))
    return said.select(F.col("doctor_url").alias("url"), F.col("s.has_name").alias("has_name"), quality.profile_unavailable_reason(F.col("s.text"), F.lit("")).alias("reason"))


@query(f"SELECT page AS listing_url, count(*) AS n_expected, count(*) FILTER (k % 7 = 0) AS n_missing, CASE WHEN count(*) FILTER (k % 7 = 0) = 0 THEN 'parsed' ELSE 'trace_partial' END AS status FROM ({S}) GROUP BY page")
def trace_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = appearances(spark, sf_dir).filter(F.regexp_extract("doctor_url", r"(\d+)$", 1).cast("long") % 7 != 0)
    return trace.coverage(captures.listings(listing_pages(spark, sf_dir)), lost)


# ---- provider rows and exports


@query(f"""
SELECT url AS doctor_url, j::INTEGER AS loc_seq, location_id, postal AS postal_code, st AS state, lkey AS provider_location_key, (k % 3 + 1)::INTEGER AS num_locations, 'Ada' AS first_name, 'MD' AS postnominal, CASE WHEN k % 3 = 0 THEN true END AS accepts_new_patients,
  CASE WHEN k % 2 = 0 OR k % 3 >= 1 THEN true WHEN k % 5 = 0 THEN false END AS offers_telemedicine, CASE WHEN k % 4 < 2 THEN k % 4 = 0 END AS can_have_appointments, CASE WHEN k % 4 < 2 THEN 'bookable' ELSE 'unresolved' END AS can_have_appointments_source, virtual AS is_virtual_location FROM ({L})
""")
def provider_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles and what listings say of them, a row for each location; what nobody says stays unknown."""
    return rows(spark, sf_dir).select(
        "doctor_url", "loc_seq", "location_id", "postal_code", "state", "provider_location_key", "num_locations", "first_name", "postnominal", "accepts_new_patients", "offers_telemedicine",
        "can_have_appointments", "can_have_appointments_source", "is_virtual_location",
    )


@query(f"SELECT lkey AS provider_location_key, url AS profile_url, location_id FROM ({L})")
def final_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every location once, although all rows come twice."""
    all_rows = rows(spark, sf_dir)
    return providers.final_rows(all_rows.unionByName(all_rows)).select("provider_location_key", "profile_url", "location_id")


@query(f"SELECT DISTINCT url AS profile_url, 'p' || k AS provider_id, (k % 3 + 1)::INTEGER AS num_locations FROM ({L})")
def unique_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.derive(providers.final_rows(rows(spark, sf_dir)))["unique_providers"].select("profile_url", "provider_id", "num_locations")


@query(f"SELECT CASE WHEN virtual THEN 'virtual' WHEN virtual IS NULL THEN 'unknown' ELSE 'physical' END AS kind, location_id FROM ({L})")
def location_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = providers.derive(providers.final_rows(rows(spark, sf_dir)))
    kinds = [sets[f"{k}_locations"].select(F.lit(k).alias("kind"), "location_id") for k in ("virtual", "physical", "unknown")]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query(f"SELECT DISTINCT st AS state, postal AS zip FROM ({L}) WHERE postal <> '00000'")
def zip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.zip_inputs(rows(spark, sf_dir))["long"]


@query("SELECT c_custkey % 50 + 1 AS zip_no, string_agg(DISTINCT chr(65 + c_nationkey % 3) || 'A', ',' ORDER BY chr(65 + c_nationkey % 3) || 'A') AS states, count(DISTINCT c_nationkey % 3)::INTEGER AS n_states FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey % 3) > 1")
def zip_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZIP codes that several states claim."""
    df = read(spark, sf_dir, "customer").select(F.concat(F.char((F.col("c_nationkey") % 3 + 65).cast("long")), F.lit("A")).alias("state"), F.lpad((F.col("c_custkey") % 50 + 1).cast("string"), 5, "0").alias("postal_code"))
    return providers.zip_inputs(df)["conflicts"].select(F.col("zip").cast("long").alias("zip_no"), "states", "n_states")


@query(f"SELECT st AS state, count(DISTINCT postal) AS n_zips FROM ({L}) WHERE postal <> '00000' GROUP BY st")
def zip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.zip_inputs(rows(spark, sf_dir))["counts"]


@query(f"""
SELECT slug AS specialty_slug, count(DISTINCT k) AS n_profiles, 0::BIGINT AS n_conflicts, count(DISTINCT t) FILTER (t % 9 = 0) AS n_open_pages, 0::BIGINT AS n_review, count(DISTINCT t) FILTER (t % 9 = 0) = 0 AS ready FROM ({S}) GROUP BY slug
""")
def delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which specialties can be delivered: none with an open page."""
    t = appearances(spark, sf_dir)
    cohort = t.select(F.col("listing_specialty_slug").alias("specialty_slug"), "doctor_url")
    open_pages = listing_pages(spark, sf_dir).filter(F.regexp_extract("url", r"town(\d+)-", 1).cast("int") % 9 == 0).select("specialty_slug", "url")
    return providers.delivery(cohort, rows(spark, sf_dir), open_pages, cohort.filter("FALSE"))["summary"].select("specialty_slug", "n_profiles", "n_conflicts", "n_open_pages", "n_review", "ready")


@query(f"SELECT slug AS specialty_slug, lkey AS provider_location_key, url AS doctor_url FROM ({L})")
def delivery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = appearances(spark, sf_dir)
    cohort = t.select(F.col("listing_specialty_slug").alias("specialty_slug"), "doctor_url")
    return providers.delivery(cohort, rows(spark, sf_dir), cohort.filter("FALSE"), cohort.filter("FALSE"))["rows"].select("specialty_slug", "provider_location_key", "doctor_url")


@query("""
SELECT c_custkey // 3 AS group_id, 'u' || max(c_custkey) AS doctor_url, count(DISTINCT c_nationkey % 2) = 1 AND count(DISTINCT c_mktsegment = 'BUILDING') = 1 AND count(DISTINCT CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 8 < 4 END) = 1 AS agreed FROM customer GROUP BY 1
""")
def reviewed_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each reviewed group of three URLs the newest, and whether provider, NPI (some don't say) and offices agree."""
    c = read(spark, sf_dir, "customer").withColumn("doctor_url", _say("u", _key("c_custkey")))
    npi = F.when(F.col("c_custkey") % 4 == 0, "").when(F.col("c_custkey") % 8 < 4, "1").otherwise("2")
    facts = c.select("doctor_url", (F.col("c_nationkey") % 2).alias("provider_id"), npi.alias("npi"), F.col("c_custkey").alias("saved_at"), F.array((F.col("c_mktsegment") == "BUILDING").cast("string")).alias("offices"))
    return providers.overrides(c.select(F.floor(F.col("c_custkey") / 3).alias("group_id"), "doctor_url"), facts)


@query(f"SELECT url AS doctor_url, name AS doctor_name, page AS first_seen_page_url, CASE slug WHEN 'dentists' THEN 'Dentists' ELSE 'Doctors' END AS first_seen_specialty_name FROM ({S})")
def provider_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.doctors(appearances(spark, sf_dir), F.lit(NOW).cast("timestamp")).select("doctor_url", "doctor_name", "first_seen_page_url", "first_seen_specialty_name")


@query(f"SELECT url AS doctor_url, name AS doctor_name, 2::BIGINT AS listing_occurrences, 1::BIGINT AS listing_pages, 'p' || k AS provider_id FROM ({S})")
def trace_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = appearances(spark, sf_dir)
    return trace.summary(t.unionByName(t)).select("doctor_url", "doctor_name", "listing_occurrences", "listing_pages", "provider_id")


@query(f"SELECT url AS doctor_url, slug AS listing_specialty_slug, 1::BIGINT AS occurrences, 1::BIGINT AS pages FROM ({S})")
def trace_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.observations(appearances(spark, sf_dir)).select("doctor_url", "listing_specialty_slug", "occurrences", "pages")


@query(f"SELECT url AS doctor_url, k % 2 = 0 AS video, CASE WHEN k % 3 = 0 THEN true END AS accepts, zip FROM ({S})")
def listing_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = trace.evidence(appearances(spark, sf_dir))
    return got.select("doctor_url", F.coalesce("t_video", F.lit(False)).alias("video"), F.col("t_accepts").alias("accepts"), F.col("t_zip").alias("zip"))


@query(f"SELECT url AS doctor_url FROM ({S}) WHERE slug = 'doctors'")
def trace_by_specialty(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = suppliers(spark, sf_dir).select(_say(ORIGIN, _path("k")).alias("doctor_url"))
    return trace.by_specialty(own, appearances(spark, sf_dir), [" Doctors "])


@query(f"SELECT page AS listing_url, sha256(string_agg(url, chr(10) ORDER BY url)) AS provider_set_hash FROM ({S}) GROUP BY page")
def provider_set_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.set_hash(appearances(spark, sf_dir))


# ---- queues, runs and reports


def _page_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of towns: forty a town, in several states of work."""
    town, page = F.floor(F.col("o_orderkey") / 40), (F.col("o_orderkey") % 40 + 1).cast("int")
    base = _say(ORIGIN + "/dentists/town", town.cast("string"), "-", town.cast("string"), "pm")
    status = F.when(F.col("o_orderkey") % 11 == 0, "pending").when(F.col("o_orderkey") % 13 == 0, "unavailable").otherwise("saved")
    return read(spark, sf_dir, "orders").select(
        F.when(page == 1, base).otherwise(_say(base, "/", page.cast("string"))).alias("url"), base.alias("base_location_url"), page.alias("page_no"), status.alias("status"), _say("kind-", (town % 5).cast("string")).alias("specialty_slug"),
        F.when(F.col("o_orderkey") % 2 == 0, "parsed").alias("trace_status"), F.when(page == 1, "seed").otherwise("pagination").alias("source"), F.col("o_orderdate").alias("saved_at"), F.col("o_orderdate").alias("discovered_at"),
        F.lit("Kind").alias("specialty_name"), town.cast("string").alias("location"), F.lit("g").alias("state_group"),
    )


Q = "SELECT o_orderkey AS k, o_orderkey // 40 AS town, (o_orderkey % 40 + 1)::INTEGER AS page_no, CASE WHEN o_orderkey % 11 = 0 THEN 'pending' WHEN o_orderkey % 13 = 0 THEN 'unavailable' ELSE 'saved' END AS status, 'kind-' || (o_orderkey // 40 % 5) AS slug, 'https://www.example.org/dentists/town' || (o_orderkey // 40) || '-' || (o_orderkey // 40) || 'pm' AS base, o_orderdate AS at FROM orders"


@query(f"SELECT CASE WHEN page_no = 1 THEN 'seed' ELSE 'pagination' END AS source, status, count(*) AS n FROM ({Q}) GROUP BY 1, 2")
def status_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages_ = _page_queue(spark, sf_dir)
    profiles = read(spark, sf_dir, "supplier").select(F.lit("saved").alias("status"))
    return reports.status_snapshot(pages_, profiles, appearances(spark, sf_dir))["pages"].select("source", "status", "n")


@query(f"SELECT count(*) FILTER (k % 2 = 0) AS parsed, count(*) FILTER (k % 2 <> 0) AS unparsed FROM ({Q}) WHERE status = 'saved'")
def status_of_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = read(spark, sf_dir, "supplier").select(F.lit("saved").alias("status"))
    return reports.status_snapshot(_page_queue(spark, sf_dir), profiles, appearances(spark, sf_dir))["parsing"]


@query(f"SELECT base AS base_location_url, base AS url FROM ({Q}) GROUP BY base")
def page_of_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that stands for each base: the base itself."""
    return providers.first_per_base(_page_queue(spark, sf_dir)).select("base_location_url", "url")


@query(f"SELECT slug AS specialty_slug, base AS location_url, CASE WHEN town % 2 = 0 THEN 'declared' ELSE 'Kind' END AS specialty_name FROM ({Q}) GROUP BY ALL")
def update_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared targets first, then bases that only pages know."""
    seen = _page_queue(spark, sf_dir)
    declared = seen.filter((F.col("location").cast("long") % 2 == 0) & (F.col("page_no") == 1)).select("specialty_slug", F.col("base_location_url").alias("listing_url"), F.lit("declared").alias("specialty_name"), "location", "state_group", F.lit(True).alias("is_active"))
    return providers.update_targets(declared, seen).select("specialty_slug", "location_url", "specialty_name")


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as targets of runs, one run a nation; every fifth run has failed ones."""
    c = read(spark, sf_dir, "customer")
    n = F.col("c_nationkey")
    status = F.when((n % 5 == 0) & (F.col("c_custkey") % 2 == 0), "failed").when((n % 5 == 1) & (F.col("c_custkey") % 3 == 0), "pending").otherwise("complete")
    locations = c.select(n.cast("long").alias("run_id"), status.alias("status"), F.lit(1).cast("long").alias("n_added"), (F.col("c_custkey") % 2).alias("n_removed"))
    jobs = c.filter((n % 5 == 2) & (F.col("c_custkey") % 4 == 0)).select(n.cast("long").alias("run_id"), F.lit("pending").alias("status"))
    runs = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("run_id"), F.lit("running").alias("status"), F.lit(None).cast("string").alias("error"))
    return runs, locations, jobs


@query("""
SELECT n_nationkey::BIGINT AS run_id, count(c_custkey) FILTER (CASE n_nationkey % 5 WHEN 0 THEN c_custkey % 2 <> 0 WHEN 1 THEN c_custkey % 3 <> 0 ELSE true END) AS completed, count(c_custkey) FILTER (n_nationkey % 5 = 0 AND c_custkey % 2 = 0) AS failed,
  count(c_custkey) AS n_added, coalesce(sum(c_custkey % 2), 0)::BIGINT AS n_removed, count(c_custkey) FILTER (n_nationkey % 5 = 1 AND c_custkey % 3 = 0 OR n_nationkey % 5 = 2 AND c_custkey % 4 = 0) = 0 AS collection_resolved
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
""")
def finalized_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.finalize(*_runs(spark, sf_dir)).select("run_id", "completed", "failed", "n_added", "n_removed", "collection_resolved")


@query("""
SELECT n_nationkey::BIGINT AS run_id, count(c_custkey) AS targets, CASE WHEN count(c_custkey) FILTER (CASE n_nationkey % 5 WHEN 0 THEN c_custkey % 2 <> 0 WHEN 1 THEN c_custkey % 3 <> 0 ELSE true END) > 0 THEN 'partial' ELSE 'failed' END AS proposed
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
""")
def reconciled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What interrupted runs reached."""
    runs, locations, _ = _runs(spark, sf_dir)
    return reports.reconcile(runs, locations).select("run_id", "targets", "proposed")


@query("SELECT event_type AS run, count(*) AS n, count(*) FILTER (event_id % 3 > 0) AS n_saved, round(avg(value), 6) AS mean_seconds, round(quantile_cont(value, 0.5), 6) AS p50_seconds, round(quantile_cont(value, 0.95), 6) AS p95_seconds FROM events GROUP BY 1")
def performance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("run"), F.when(F.col("event_id") % 3 > 0, "saved").otherwise("failed").alias("status"), F.col("value").alias("total_seconds"), F.lit(3600.0).alias("elapsed"), (F.col("value") / 2).alias("parse"))
    got = reports.performance(e, ["parse"])
    return got.select("run", "n", "n_saved", *(F.round(c, 6).alias(c) for c in ("mean_seconds", "p50_seconds", "p95_seconds")))


@query("SELECT count(*) AS runners, sum(n)::BIGINT AS n, round(sum(m * n) / sum(n), 6) AS parse FROM (SELECT event_type, count(*) AS n, avg(value / 2) AS m FROM events GROUP BY 1)")
def combined_runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg(F.col("value") / 2).alias("parse"), F.lit(1.0).alias("pages_per_minute"))
    return reports.combined(e, ["parse"]).select("runners", "n", F.round("parse", 6).alias("parse"))


@query(f"""
SELECT slug AS specialty_slug, count(*) AS n_pages, count(*) FILTER (status = 'pending') AS open_pages, count(*) FILTER (status = 'unavailable') AS unavailable_pages, count(*) FILTER (status = 'pending') = 0 AS resolved, count(*) FILTER (status <> 'saved') = 0 AS complete FROM ({Q}) GROUP BY slug
""")
def runtime_by_specialty(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = read(spark, sf_dir, "supplier").select(_say(ORIGIN, _path("s_suppkey")).alias("doctor_url"), F.lit("saved").alias("status"))
    timings = _page_queue(spark, sf_dir).select("specialty_slug", F.lit(2.0).alias("seconds"), F.lit(1).alias("processed"))
    got = reports.specialty_runtime(_page_queue(spark, sf_dir), appearances(spark, sf_dir), profiles, timings)
    return got.select("specialty_slug", "n_pages", "open_pages", "unavailable_pages", "resolved", "complete")


@query("SELECT o_orderstatus AS status, count(*) FILTER (o_orderkey % 2 = 0) - count(*) FILTER (o_orderkey % 3 = 0) AS delta FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) > 0")
def status_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the number of each status moved since a baseline."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    count = lambda m: o.filter(F.col("o_orderkey") % m == 0).groupBy("status").agg(F.count("*").alias("n"))
    return reports.progress(count(3), count(2))


# ---- upkeep


@query(f"SELECT base || '/' || 99 AS url, base AS base_location_url, 99 AS page_no, slug AS specialty_slug, 'pagination' AS source FROM ({Q}) GROUP BY base, slug")
def inherited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages met for the first time take over where their base belongs."""
    known = _page_queue(spark, sf_dir).withColumn("specialty_url", F.lit("u"))
    new = known.select(_say(F.col("base_location_url"), "/99?x=1").alias("url"))
    return repairs.ensure_pages(known, new, F.lit(NOW).cast("timestamp")).select("url", "base_location_url", "page_no", "specialty_slug", "source")


@query(f"SELECT url AS doctor_url, page AS page_url, page AS location_url FROM ({S})")
def provider_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = appearances(spark, sf_dir)
    return repairs.sources(t.unionByName(t), F.lit(NOW).cast("timestamp")).select("doctor_url", "page_url", "location_url")


@query("""
SELECT 'u' || s_suppkey AS doctor_url, CASE WHEN s_suppkey % 7 = 0 THEN 'unavailable' WHEN s_suppkey % 5 = 0 THEN 'done' ELSE 'pending' END AS status FROM supplier
""")
def normalized_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile jobs before work: what is gone, what is stored, and what is tried again."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), _say("u", _key("s_suppkey")).alias("doctor_url"))
    jobs = s.select("doctor_url", F.lit("missing_profile").alias("reason"), F.when(F.col("k") % 3 == 0, "failed").otherwise("pending").alias("status"))
    profiles = s.select("doctor_url", F.when(F.col("k") % 7 == 0, "unavailable").otherwise("pending").alias("status"), F.lit(None).cast("timestamp").alias("saved_at"))
    stored = s.select("doctor_url", F.when(F.col("k") % 5 == 0, "x").otherwise("").alias("profile_sha256"))
    return repairs.normalize_jobs(jobs, profiles, stored).select("doctor_url", "status")


@query("SELECT 'u' || s_suppkey AS doctor_url, CASE WHEN s_suppkey % 4 = 0 THEN 'unavailable' WHEN s_suppkey % 4 = 1 THEN 'not_saved' WHEN s_suppkey % 4 = 2 THEN 'missing_file' ELSE 'import' END AS outcome FROM supplier WHERE s_suppkey % 6 <> 0")
def import_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a local import can do for each active provider without stored details."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), _say("u", _key("s_suppkey")).alias("doctor_url"))
    kind = F.col("k") % 4
    profiles = s.select("doctor_url", F.when(kind == 0, "unavailable").when(kind == 1, "pending").otherwise("saved").alias("status"))
    files = s.filter(kind != 2).select("doctor_url", _say("f", _key("k")).alias("file"))
    stored = s.select("doctor_url", F.when(F.col("k") % 6 == 0, "x").alias("profile_sha256"))
    return repairs.local_import(s.select("doctor_url", F.lit(True).alias("is_active")), profiles, stored, files).select("doctor_url", "outcome")


@query("SELECT 'u' || s_suppkey AS doctor_url, CASE WHEN s_suppkey % 3 = 0 THEN 'unavailable' WHEN s_suppkey % 3 = 1 THEN 'pending' ELSE 'saved' END AS status FROM supplier")
def repaired_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved profiles whose captures were verification or missing pages."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), _say("u", _key("s_suppkey")).alias("doctor_url"))
    bad = s.filter("k % 3 < 2").select(F.col("doctor_url").alias("url"), F.when(F.col("k") % 3 == 0, "profile returned /404").otherwise("verification").alias("reason"))
    return repairs.repaired_challenges(s.select("doctor_url", F.lit("saved").alias("status"), F.lit(None).cast("string").alias("last_error")), bad).select("doctor_url", "status")


@query(f"SELECT url AS doctor_url, CASE WHEN k % 2 = 0 THEN 'page' END AS file, CASE WHEN k % 2 = 0 THEN 'saved' ELSE 'pending' END AS status FROM ({S})")
def repaired_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting profiles whose capture came under another URL."""
    s = suppliers(spark, sf_dir).select("k", _say(ORIGIN, _path("k")).alias("doctor_url"))
    found = s.filter("k % 2 = 0").select(F.col("doctor_url").alias("requested"), F.lit("page").alias("file"))
    return repairs.repaired_redirects(s.select("doctor_url", F.lit(None).cast("string").alias("file"), F.lit("pending").alias("status")), found)


@query(f"SELECT url AS doctor_url, 'supplier-' || k || '-' || (k % 3) || '.html' AS file FROM ({S})")
def newest_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per trailing id the newest file."""
    s = suppliers(spark, sf_dir).select("k", _say(ORIGIN, _path("k")).alias("doctor_url"))
    files = s.select("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") % 3)).alias("j"))
    held = files.select(_say("v", _key("j"), "-", _key("k"), "--0123abcd.html").alias("file"), F.col("j").alias("captured_at"))
    got = captures.newest_by_id(held)
    return got.join(s, F.col("_id") == F.col("k").cast("string")).select("doctor_url", F.regexp_replace("file_by_id", r"^v(\d+)-(\d+)--.*$", "supplier-$2-$1.html").alias("file"))


# ---- queues of pages and profiles


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages: a third each retry_pending, saved and pending, some retried already."""
    k = F.col("c_custkey")
    status = F.when(k % 3 == 0, "retry_pending").when(k % 3 == 1, "saved").otherwise("pending")
    return read(spark, sf_dir, "customer").select(k.alias("k"), _say(ORIGIN + "/dentists/t-", _key("c_custkey"), "pm").alias("url"), status.alias("status"), (k % 4).cast("int").alias("retry_count"), F.when(k % 2 == 0, "parsed").alias("trace_status"), F.col("c_mktsegment").alias("specialty_slug"))


C = "SELECT c_custkey AS k, 'https://www.example.org/dentists/t-' || c_custkey || 'pm' AS url, CASE c_custkey % 3 WHEN 0 THEN 'retry_pending' WHEN 1 THEN 'saved' ELSE 'pending' END AS status, c_custkey % 4 AS retry_count, c_custkey % 2 = 0 AS traced, c_mktsegment AS slug FROM customer"


@query(f"SELECT url, CASE WHEN status = 'retry_pending' THEN 'pending' ELSE status END AS status FROM ({C})")
def activated_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.activate_retries(_queue(spark, sf_dir)).select("url", "status")


@query(f"SELECT url, CASE WHEN k % 5 = 0 AND status IN ('pending', 'retry_pending') THEN 'saved' ELSE status END AS status FROM ({C}) WHERE status <> 'retry_pending'")
def reconciled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting pages whose files have turned up count as saved."""
    pages_ = _queue(spark, sf_dir).filter("status <> 'retry_pending'").withColumn("_slug", U.safe_slug(F.col("url")))
    return queue.reconcile(pages_, pages_.filter("k % 5 = 0").select(F.col("_slug").alias("file")), "_slug").select("url", "status")


@query(f"SELECT url FROM ({C}) WHERE NOT traced AND k % 3 = 0")
def pages_to_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a capture that aren't traced yet."""
    pages_ = _queue(spark, sf_dir)
    return trace.unparsed(pages_, pages_.filter("k % 3 = 0").select(U.safe_slug(F.col("url")).alias("file"))).select("url")


@query(f"SELECT count(*) AS n, sum(k) AS bytes FROM ({C}) WHERE traced AND status = 'saved'")
def captures_to_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that may go: those of saved pages whose trace is committed."""
    pages_ = _queue(spark, sf_dir)
    return trace.cleanup(pages_, pages_.select(U.safe_slug(F.col("url")).alias("file"), F.col("k").alias("bytes"))).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


@query(f"SELECT url, CASE WHEN k % 6 = 1 THEN CASE WHEN k % 4 >= 2 THEN 'exhausted' ELSE 'missing_capture' END ELSE 'retry_zero' END AS finding FROM ({C}) WHERE status = 'saved' AND k % 6 IN (1, 4) AND (k % 6 = 1 OR k % 7 > 0)")
def audited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved pages without a capture, or whose capture holds no provider."""
    pages_ = _queue(spark, sf_dir)
    held = pages_.filter("k % 6 <> 1").select(U.safe_slug(F.col("url")).alias("file"))
    results = pages_.select("url", F.when(F.col("k") % 7 > 0, "retry_zero").otherwise("valid").alias("class"))
    return repairs.audit_empty(pages_, results, held).select("url", "finding")


@query(f"SELECT url, CASE WHEN traced AND k % 3 = 0 OR traced THEN 'parsed' WHEN k % 3 = 1 THEN 'parsed' END AS trace_status FROM ({C})")
def pages_marked_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traced pages whose capture is gone."""
    pages_ = _queue(spark, sf_dir)
    t = pages_.filter("k % 3 < 2").select(F.col("url").alias("listing_url"))
    held = pages_.filter("k % 3 <> 1").select(U.safe_slug(F.col("url")).alias("file"))
    return repairs.mark_parsed(pages_, t, held).select("url", "trace_status")


@query(f"SELECT slug AS specialty_slug, url AS location_url FROM ({C}) WHERE k % 4 > 0")
def targets_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that a run has not completed."""
    targets = _queue(spark, sf_dir).select("k", "specialty_slug", F.col("url").alias("location_url"))
    done = targets.select(F.lit(7).cast("long").alias("run_id"), "specialty_slug", "location_url", F.when(F.col("k") % 4 == 0, "complete").otherwise("failed").alias("status"))
    return repairs.remaining_targets(targets.drop("k"), done, 7)


@query(f"SELECT slug AS specialty_slug, url AS location_url FROM ({C}) WHERE lower(slug) = 'building' AND k % 2 = 0")
def chosen_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of a specialty that have a snapshot."""
    declared = _queue(spark, sf_dir).select("k", "specialty_slug", F.col("specialty_slug").alias("specialty_name"), F.col("url").alias("location_url"))
    return repairs.select_targets(declared, declared.filter("k % 2 = 0").select("location_url"), [" Building"], True).select("specialty_slug", "location_url")


@query(f"SELECT url AS doctor_url FROM ({S}) WHERE k % 2 = 0 AND slug = 'dentists'")
def active_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers with an active membership in a specialty."""
    s = suppliers(spark, sf_dir).select("k", "r", _say(ORIGIN, _path("k")).alias("doctor_url"))
    members = s.select("doctor_url", (F.col("k") % 2 == 0).alias("is_active"), F.when(F.col("r") % 2 == 0, "dentists").otherwise("doctors").alias("specialty_slug"))
    return trace.by_membership(s.select("doctor_url"), members, ["dentists"])


@query(f"SELECT url AS doctor_url, CASE WHEN k % 3 = 0 THEN 'own' WHEN k % 3 = 1 THEN 'other-' || k || '--0123abcd.html' END AS file FROM ({S})")
def profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture of a profile: the one under its slug, else the newest one with its number."""
    s = suppliers(spark, sf_dir).select("k", _say(ORIGIN, _path("k")).alias("doctor_url"))
    own = s.filter("k % 3 = 0").select(U.safe_slug(F.col("doctor_url")).alias("file"), F.lit(0).alias("captured_at"))
    other = s.filter("k % 3 = 1").select(_say("other-", _key("k"), "--0123abcd.html").alias("file"), F.lit(1).alias("captured_at"))
    got = captures.profile_captures(s.select("doctor_url"), own.unionByName(other))
    return got.select("doctor_url", F.when(F.col("file") == U.safe_slug(F.col("doctor_url")), "own").otherwise(F.col("file")).alias("file"))


@query(f"SELECT url || 'x' AS requested, url || 'x-' || (k + 1000) AS canonical FROM ({S}) WHERE k % 2 = 0")
def redirected_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested profiles and the one captured URL that they redirect to; where there are two, none."""
    s = suppliers(spark, sf_dir).select("k", _say(ORIGIN, _path("k"), "x").alias("doctor_url"))
    to = lambda more: _say(F.col("doctor_url"), "-", (F.col("k") + more).cast("string"))
    found = s.select(to(1000).alias("url"), _say("f", _key("k")).alias("file")).unionByName(s.filter("k % 2 = 1").select(to(2000).alias("url"), _say("g", _key("k")).alias("file")))
    return captures.redirects(s.select("doctor_url"), found).select("requested", "canonical")


@query(f"SELECT 'p' || k AS provider_id, j::INTEGER AS place, lkey AS provider_location_key FROM ({L})")
def stored_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles stored as JSON and expanded again."""
    back = providers.from_payloads(providers.payloads(rows(spark, sf_dir)))
    return back.filter("error IS NULL").select("provider_id", F.col("loc_seq").cast("int").alias("place"), "provider_location_key")


__all__ = ["appearances", "listing_pages", "profile_pages", "rows"]
