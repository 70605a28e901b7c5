"""Page parsers on invented pages."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import url as U
from millrace.sources import captures, links, pages
from millrace.sources.dom import first, parse, select
from millrace.sources.state import Providers, embedded_state, profile_provider

ORIGIN = "https://www.example.org"


def state_script(value, quote='"'):
    text = json.dumps(value)
    body = json.dumps(text)[1:-1] if quote == '"' else text.replace("\\", "\\\\").replace("'", "\\'")
    return f"<script>window.__REDUX_STATE__ = JSON.parse({quote}{body}{quote});</script>"


def card(path, name, extra=""):
    return f'<article data-test="search-result-item"><a data-test="doctor-card-info-name" href="{path}">{name}</a>{extra}</article>'


LISTING = (
    '<div data-test="selection-criteria-header"><h1>12 verified Dentists in Springfield, XY</h1><br></div>'
    + card("/dentist/ada-lovelace-dmd-11?x=1", "Dr. Ada Lovelace", '<div data-test="doctor-card-info-location"><span itemprop="postalCode">01234</span><span itemprop="streetAddress">1 Main St,</span></div><i data-test="video-visits-text"></i>')
    + '<p><a data-test="doctor-card-info-name" href="/dentist/alan-turing-22">Alan <b>Turing</b></a>'
    + '<nav data-test="search-results-pagination"><a href="/dentists/springfield-5pm/3">3</a><a href="/dentists/springfield-5pm/2">2</a><a href="/other/town-6pm/2">x</a></nav>'
)
PAGE = ORIGIN + "/dentists/springfield-5pm"


def test_tree_closes_what_html_leaves_open():
    tree = parse("<ul><li>a<li>b<br>c</ul><p>d<p>e<img src=x>f</div>")
    assert [n.text() for n in select(tree, "li")] == ["a", "b c"]
    assert [n.text() for n in select(tree, "p")] == ["d", "e f"]
    assert first(parse('<div data-x="ab"></div>'), 'div[data-x^="a"]') is not None


def test_listing_links_pages_and_total():
    got = pages.listing(LISTING, PAGE)
    assert [d["doctor_url"] for d in got["doctors"]] == [ORIGIN + "/dentist/ada-lovelace-dmd-11", ORIGIN + "/dentist/alan-turing-22"]
    assert got["doctors"][1]["doctor_name"] == "Alan Turing"
    assert got["pagination_urls"] == [PAGE + "/2", PAGE + "/3"]
    assert got["advertised_total"] == 12


def test_appearances_use_the_best_structured_match_and_keep_unknown_flags():
    place = {"id": "7|9", "provider": {"profileUrl": "/dentist/ada-lovelace-dmd-11", "id": 7, "acceptsNewPatients": True}, "location": {"id": "9", "zipCode": "01234"}}
    other = {"id": "7|8", "provider": {"profileUrl": "/dentist/ada-lovelace-dmd-11", "id": 7}, "location": {"zipCode": "99999"}}
    rows = pages.occurrences(LISTING + state_script({"listing": [other, place]}), PAGE)
    assert [r["card_index"] for r in rows] == [1, 2]
    assert rows[0]["provider_location_key"] == "7|9" and rows[0]["structured_accepts_new_patients"] is True
    assert rows[0]["structured_offers_telemedicine"] is None and rows[0]["listing_offers_video_visits"] is True
    assert rows[0]["address_line_1"] == "1 Main St" and rows[1]["doctor_name"] == "Alan Turing"


@pytest.mark.parametrize("quote", ['"', "'"])
def test_state_in_either_kind_of_quotes(quote):
    value = {"a": 'say "hi"\n', "b": ["it's", "\\", "é"]}
    assert embedded_state(state_script(value, quote)) == value


def test_state_skips_what_cannot_be_read():
    assert embedded_state("<script>window.__REDUX_STATE__ = 1</script>" + state_script({"k": 1})) == {"k": 1}
    assert embedded_state(state_script([1])) is None
    assert embedded_state("window.__REDUX_STATE__ JSON.parse(oops") is None


def test_equal_scores_keep_the_first_candidate():
    p = lambda n: {"provider": {"profileUrl": "/dentist/x-1", "npi": n}}
    assert Providers([p("first"), p("second")]).best(ORIGIN + "/dentist/x-1")[0]["npi"] == "first"


def test_order_of_preference_among_sightings():
    """Same ZIP, then an entry for one location, then any entry, then the fuller object by itself."""
    url = "/dentist/x-1"
    bare = {"profileUrl": url, "npi": "bare"}
    full = {"profileUrl": url, "npi": "full", "id": 1, "monolithId": 2, "averageRating": 5, "reviewCount": 1, "approvedLocations": [], "offersTelemedicine": True, "approvedFullName": "X"}
    entry = {"provider": {"profileUrl": url, "npi": "entry"}}
    one_place = {"id": "1|2", "provider": {"profileUrl": url, "npi": "one place"}}
    near = {"provider": {"profileUrl": url, "npi": "near"}, "location": {"zip": "01234"}}
    worst_first = [bare, full, entry, one_place, near]
    for k in range(1, 6):
        for order in (worst_first[:k], worst_first[:k][::-1]):
            assert Providers(order).best(ORIGIN + url, "01234")[0]["npi"] == ["bare", "full", "entry", "one place", "near"][k - 1]
    assert Providers([near, one_place]).best(ORIGIN + url)[0]["npi"] == "one place"
    assert Providers(worst_first).best(ORIGIN + "/dentist/y-2") == ({}, {})


def test_profile_places_come_before_the_fullest_object():
    full = {"profileUrl": "/doctor/a-1", "npi": "elsewhere", "firstName": "A", "lastName": "B", "statement": "s"}
    state = {"other": [{"profileUrl": "/doctor/a-1", "npi": "thin"}, full], "provider": {"npi": "third"}, "profile": {"provider": {"npi": "second"}}}
    assert profile_provider(state, ORIGIN + "/doctor/a-1")["npi"] == "second"
    del state["profile"]
    assert profile_provider(state, ORIGIN + "/doctor/a-1")["npi"] == "third"
    state["provider"] = {"firstName": "no identity"}
    assert profile_provider(state, ORIGIN + "/doctor/a-1")["npi"] == "elsewhere"


PROFILE_STATE = {
    "profile": {
        "data": {
            "provider": {
                "id": "p1", "npi": "123", "profileUrl": "/doctor/grace-hopper-md-5", "approvedFullName": "Dr. Grace Hopper, MD", "isBookable": False, "reviewCount": 0,
                "hospitalAffiliations": [{"name": "General"}, "General", {"title": "County"}], "relevantSpecialty": {"name": "Surgeon"},
                "approvedLocations": [{"id": "l1", "address1": "2 Oak Rd", "city": "Springfield", "state": "XY", "zipCode": "00501"}, {"id": "l2", "isVirtual": True, "virtualVisitType": "VIDEO"}, {"id": "l2", "isVirtual": True}, {"phone": "1"}],
            }
        }
    },
    "places": [{"id": "p1|l1", "provider": {"id": "p1"}, "location": {"id": "l1"}}],
}


def test_profile_fields_flags_and_locations():
    got = pages.profile(state_script(PROFILE_STATE) + '<link rel="canonical" href="/doctor/grace-hopper-md-5">', ORIGIN + "/doctor/grace-hopper")
    assert got["profile_url"] == ORIGIN + "/doctor/grace-hopper-md-5"
    assert got["full_name"] == "Dr. Grace Hopper, MD" and got["review_count"] == "0" and got["is_bookable"] is False
    assert got["hospital_affiliations"] == ["General", "County"] and got["accepts_new_patients"] is None
    assert [x["location_id"] for x in got["locations"]] == ["l1", "l2"]
    assert got["locations"][0]["profile_key"] == "p1|l1" and got["locations"][1]["profile_key"] == ""


def test_profile_from_markup_alone():
    got = pages.profile('<h1 data-test="provider-name">Jo Doe</h1><meta property="og:image" content="//img.example.org/p"><p>Office: Springfield, XY 12345</p>Read 1,024 reviews', ORIGIN + "/doctor/jo-doe")
    assert got["full_name"] == "Jo Doe" and got["review_count"] == "1024" and not got["provider_found"]
    assert [(x["city"], x["state"], x["postal_code"]) for x in got["locations"]] == [("Springfield", "XY", "12345")]


def test_provider_of_another_page_is_not_taken():
    state = {"profile": {"provider": {"id": 1, "profileUrl": "/doctor/else-9"}}}
    assert profile_provider(state, ORIGIN + "/doctor/jo-doe") == {}


def _pages(spark, *htmls):
    return spark.createDataFrame([(f"{ORIGIN}/specialty?{k}", h) for k, h in enumerate(htmls)], "url string, html string")


def test_catalog_is_bounded_and_refuses_fragments(spark):
    items = [f'<li><a href="/kind-{k}">Kind {k}</a></li>' for k in range(10)] + ['<li><a href="/eye-clinics">Eye  Clinics</a></li>', '<li><a href="/kind-3?again">Other name</a></li>', '<li><a href="/a/b">Two</a><a href="/none"> </a></li>']
    page = lambda inside: f'<header><a href="/login">x</a></header><h2>Browse All Specialties</h2>{inside}<footer><a href="/about">y</a></footer>'
    whole, spread = page(f"<ul>{''.join(items)}</ul><a href='/after'>z</a>"), page(f"<ul>{items[0]}</ul>" + "".join(items[1:]))
    got = captures.catalog(_pages(spark, whole, spread, page("".join(items[:9])), "<p>nothing</p>", None)).collect()
    of = lambda k: [r for r in got if r.url.endswith(f"?{k}")]
    for k in (0, 1):
        assert {r.specialty_slug for r in of(k)} == {*(f"kind-{i}" for i in range(10)), "eye-clinics"} and len(of(k)) == 11 and not any(r.error for r in of(k))
        assert {r.specialty_slug: r.specialty_name for r in of(k)}["kind-3"] == "Kind 3"
        assert [r.specialty_name for r in of(k) if r.entity_type == "facility_or_clinic"] == ["Eye Clinics"]
    assert [(r.error, r.specialty_url) for r in of(2)] == [("only 9 catalog entries", None)]
    assert all(len(of(k)) == 1 and "heading" in of(k)[0].error for k in (3, 4))


def test_landing_by_state_and_fallback():
    section = lambda s, *ls: f'<div data-test="expandable-list-section-{s}"><div role="button">{s}</div><div data-test="expandable-list-section-list">{"".join(ls)}</div></div>'
    link = lambda p, n: f'<a href="{p}">{n}</a>'
    html = '<div data-test="tab-panel-location">' + section("Ohio", link("/dentists/b-2pm", "B"), link("/dentists/b-2pm", "B")) + section("Iowa", link("/dentists/a-1pm", "A"), link("/other/c-3pm", "C")) + "</div>"
    got = pages.landing(html, ORIGIN + "/dentists")
    assert [(r["state_group"], r["location"]) for r in got["locations"]] == [("Iowa", "A"), ("Ohio", "B")]
    assert [r["location"] for r in pages.landing(link("/dentists/a-1pm", "A"), ORIGIN + "/dentists")["locations"]] == ["A"]
    with pytest.raises(ValueError):
        pages.landing("", ORIGIN + "/specialty")


def test_verified_counts(spark):
    """The likeliest place first, then the strictest wording; what is hidden or names nothing doesn't count."""
    htmls = [
        "<h1>1,305 verified  Eye Doctors in Springfield, XY </h1>",
        "<script>3 verified A in B</script><p>nothing</p>",
        "<title>9 verified Other in Place, QQ</title><h2>8 verified Dentists in Town, XY</h2><p>7 verified X in Y</p>",
        "<p>5 verified Dentists in Springfield, XY Sort by distance</p><b>4 verified Y in Z</b>",
        '<div data-test="selection-criteria-header">2 verified ,. in Q</div><h1>6 verified Doctors in R.</h1>',
        "<p>11 verified</p> <p>Dentists in</p> <p>Far Town Book now</p>",
    ]
    got = {int(r.url[-1]): (r["specialty"], r["location"], r["count"]) for r in captures.verified_counts(_pages(spark, *htmls)).collect()}
    assert got == {
        0: ("eye doctors", "Springfield, XY", 1305), 1: (None, None, None), 2: ("dentists", "Town, XY", 8), 3: ("dentists", "Springfield, XY Sort by distance", 5), 4: ("doctors", "R", 6), 5: ("dentists", "Far Town Book now", 11),
    }


def test_dot_segments_go_as_in_python(spark):
    base = "https://www.example.org/a/b/c?q=1"
    hrefs = ["../d", "../../../d/", "./e/./f", "/x/../../y/./z", "g/../..", "?k=/../v", "#f", "//other.org/p/../q", "http://h.org/a/../b", "h//i/../j", "..", ".", "/", "a/../../b/./c", "mailto:x@y.z"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", U.absolute_url(F.col("h"), F.lit(base)).alias("u"))
    assert {r.h: r.u for r in df.collect()} == {h: links.absolute(h, base) for h in hrefs}


def test_links_algebra():
    assert links.normal(" HTTPS://Example.org/a//?q#f ") == "https://Example.org/a"
    assert links.base_of(ORIGIN + "/a/b-1pm/12") == ORIGIN + "/a/b-1pm" and links.page_of(ORIGIN + "/a/b-1pm/12/") == 12
    assert links.is_profile(ORIGIN + "/doctor/x") and not links.is_profile(ORIGIN + "/blog/x") and not links.is_profile("https://else.example/doctor/x")


def test_titles_are_read_as_their_sql_reads_them(spark, tmp_path):
    """Cut references and others than `&amp;` stay; the parser itself resolves them all."""
    import duckdb

    from millrace.plans import catalogue

    titles = ["a &amp; b", "ver&amp", "token = &quot;1f&quot;", "x&amp;&amp;amp;", "A&B &#38; c", ""]
    rows = [(i, "http://h/", f"<html><title>{t}</title><body><p>x &quot;y&quot;</p></body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, catalogue.QUERIES["page_signals"](spark, str(tmp_path)).collect())) == sorted(con.sql(catalogue.SQL["page_signals"]).fetchall())
    assert pages.signals(rows[2][2])["title"] == 'token = "1f"'
