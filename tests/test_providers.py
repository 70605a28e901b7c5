"""From captures to provider rows, and the datasets made of them, on invented pages."""

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import url as U
from millrace.operators import trace
from millrace.plans import providers
from millrace.sources import captures
from tests.test_pages import LISTING, ORIGIN, PAGE, PROFILE_STATE, state_script

URL = ORIGIN + "/doctor/grace-hopper-md-5"


@pytest.fixture(scope="module")
def appearances(spark):
    other = {"id": "p1|l2", "provider": {"profileUrl": "/doctor/grace-hopper-md-5", "id": "p1", "acceptsNewPatients": True, "canHaveAppointments": None}, "location": {}}
    more = '<article data-test="search-result-item"><a data-test="doctor-card-info-name" href="/doctor/grace-hopper-md-5">Grace</a></article>' + state_script({"x": [other]})
    df = spark.createDataFrame([(PAGE, LISTING, "a.html"), (PAGE + "/2", more, "b.html"), (PAGE + "/3", None, "c.html")], "url string, html string, file string")
    return captures.trace_rows(df.withColumn("specialty_slug", F.lit("dentists")))


@pytest.fixture(scope="module")
def rows(spark, appearances):
    html = state_script(PROFILE_STATE)
    df = spark.createDataFrame([(URL, URL, html), (ORIGIN + "/doctor/no-one-1", ORIGIN + "/doctor/no-one-1", "<h1>No One</h1>")], "doctor_url string, url string, html string")
    return providers.provider_rows(captures.profiles(df), appearances)


def test_trace_has_its_columns_and_all_appearances(appearances):
    assert appearances.columns == schema.TRACE_COLUMNS and len(schema.TRACE_COLUMNS) == 29
    got = {(r.listing_page_no, r.card_index): r for r in appearances.collect()}
    assert sorted(got) == [(1, 1), (1, 2), (2, 1)]
    assert got[2, 1].listing_specialty_slug == "dentists" and got[2, 1].structured_offers_telemedicine is None


def test_rows_resolve_evidence_without_inventing_no(rows):
    assert len(schema.FINAL_COLUMNS) == 35 and len(schema.UNIQUE_COLUMNS) == 21
    got = {r.location_id: r for r in rows.filter(F.col("doctor_url") == URL).collect()}
    assert set(got) == {"l1", "l2"}
    one, two = got["l1"], got["l2"]
    assert one.provider_location_key == "p1|l1" and two.provider_location_key == "p1|l2"
    assert one.accepts_new_patients is True and one.only_sees_children is None
    assert one.can_have_appointments is False and one.can_have_appointments_source == "bookable"
    assert one.offers_telemedicine is True and one.telemedicine_evidence == "profile.location.isVirtual=true; profile.location.virtualVisitType"
    assert one.source_zip == "00501" and one.first_name == "Grace" and one.postnominal == "MD" and one.num_locations == 2
    blank = rows.filter(F.col("full_name") == "No One").collect()
    assert len(blank) == 1 and blank[0].can_have_appointments_source == "unresolved" and blank[0].accepts_new_patients is None


def test_final_rows_and_derived_sets(rows):
    final = providers.final_rows(rows.unionByName(rows)).cache()
    assert final.count() == 3
    out = providers.derive(final)
    assert out["unique_providers"].count() == 2 and out["unique_providers"].columns == schema.UNIQUE_COLUMNS
    assert [out[k].count() for k in ("virtual_locations", "physical_locations", "unknown_locations")] == [1, 0, 2]


def test_zip_inputs(spark):
    df = spark.createDataFrame([("xy", "501.0"), ("XY", "00501-1234"), ("AB", "501"), ("", "12345"), ("AB", "x 77777 y"), ("AB", "00000")], "state string, postal_code string")
    out = providers.zip_inputs(df)
    assert [tuple(r) for r in out["long"].collect()] == [("AB", "00501"), ("AB", "77777"), ("XY", "00501")]
    assert [tuple(r) for r in out["conflicts"].collect()] == [("00501", "AB,XY", 2)]
    assert [tuple(r) for r in out["wide"].collect()] == [("00501", "00501"), ("77777", None)]


def test_delivery_is_ready_only_without_doubt(spark, rows):
    cohort = spark.createDataFrame([("dentists", URL)], "specialty_slug string, doctor_url string")
    nothing = spark.createDataFrame([], "specialty_slug string, k string")
    ready = providers.delivery(cohort, rows, nothing, nothing)
    assert ready["summary"].first().ready and ready["rows"].count() == 2
    waiting = spark.createDataFrame([("dentists", "p")], "specialty_slug string, k string")
    assert not providers.delivery(cohort, rows, waiting, nothing)["summary"].first().ready
    changed = rows.unionByName(rows.withColumn("bio", F.lit("other")))
    assert not providers.delivery(cohort, changed, nothing, nothing)["summary"].first().ready


def test_guard(spark):
    done, open_ = spark.createDataFrame([("saved",)], "status string"), spark.createDataFrame([("pending",)], "status string")
    providers.guard(done, done)
    providers.guard(done, open_, allow_partial=True)
    with pytest.raises(ValueError):
        providers.guard(done, open_)


def test_overrides_need_agreement(spark):
    aliases = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c"), ("h", "d")], "group_id string, doctor_url string")
    rows = spark.createDataFrame([("a", "1", "9", 1, ["x", "y"]), ("b", "1", "9", 2, ["y", "x"]), ("c", "1", "8", 1, ["x"]), ("d", "2", "8", 2, ["x"])], "doctor_url string, provider_id string, npi string, saved_at int, offices array<string>")
    assert {tuple(r) for r in providers.overrides(rows, aliases).collect()} == {("g", "b", True), ("h", "d", False)}


def test_profile_captures_by_slug_then_newest_id(spark):
    urls = spark.createDataFrame([(URL,), (ORIGIN + "/doctor/other-7",)], "doctor_url string")
    exact = spark.createDataFrame([(URL,)], "u string").select(U.safe_slug(F.col("u"))).first()[0]
    files = spark.createDataFrame([(exact, 1), ("doctor__old-7--00000000.html", 1), ("doctor__new-7--11111111.html", 2)], "file string, captured_at int")
    got = {r.doctor_url: r.file for r in captures.profile_captures(urls, files).collect()}
    assert got == {URL: exact, ORIGIN + "/doctor/other-7": "doctor__new-7--11111111.html"}


def test_redirects_need_one_target(spark):
    asked = spark.createDataFrame([(ORIGIN + "/Doctor/ann",), (ORIGIN + "/doctor/bob",)], "doctor_url string")
    seen = spark.createDataFrame([(ORIGIN + "/doctor/Ann-12", "f1"), (ORIGIN + "/doctor/bob-1", "f2"), (ORIGIN + "/doctor/bob-2", "f3")], "url string, file string")
    assert [r.file for r in captures.redirects(asked, seen).collect()] == ["f1"]


def test_summary_and_specialty_filters(appearances):
    got = {r.doctor_url: r for r in trace.summary(appearances.unionByName(appearances)).collect()}
    assert got[URL].listing_occurrences == 2 and got[URL].listing_pages == 1 and got[URL].provider_id == "p1"
    assert trace.by_specialty(appearances, appearances, ["Dentists"]).count() == 3
    assert trace.by_specialty(appearances, appearances, ["else"]).count() == 0


def test_parse_errors_become_rows(spark):
    df = spark.createDataFrame([("u", "<p>no catalog</p>")], "url string, html string")
    got = captures.catalog(df).collect()
    assert len(got) == 1 and "heading" in got[0].error and got[0].specialty_url is None
