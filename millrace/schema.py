"""Schemas: the canonical provider-location row, listing appearances, and the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _I, _TS = T.StringType(), T.BooleanType(), T.IntegerType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, _S)


#: A location of a provider, as parsed.
LOCATION = struct(
    **texts("location_id", "location_name", "address_line_1", "address_line_2", "city", "state", "postal_code", "phone"),
    is_virtual_location=_B, can_have_appointments=_B, has_new_patient_availability=_B, **texts("virtual_visit_type", "practice_name"),
)

STRUCTURED_FLAGS = ["structured_accepts_new_patients", "structured_offers_telemedicine", "structured_has_virtual_locations", "structured_can_have_appointments", "structured_has_new_patient_availability"]
LISTING_FLAGS = ["listing_offers_video_visits", "listing_accepts_new_patients"]

#: What a listing parser says of one appearance.
APPEARANCE = struct(
    card_index=_I,
    **texts("doctor_url", "doctor_name", "specialty_name", "provider_id", "monolith_id", "npi", "provider_location_key", "average_rating", "review_count", "address_line_1", "city", "state", "postal_code"),
    **dict.fromkeys([*LISTING_FLAGS, *STRUCTURED_FLAGS], _B),
)
PAGE_COLUMNS = ["listing_url", "listing_state_group", "listing_location", "listing_page_no", "listing_file", "listing_specialty_url", "listing_specialty_name", "listing_specialty_slug"]
#: The 29 columns of the trace: whose listing, then the appearance.
TRACE_COLUMNS = [*PAGE_COLUMNS, *APPEARANCE.names]

#: What a listing parser says of the page.
LISTING = struct(doctors=T.ArrayType(struct(**texts("doctor_url", "doctor_name"))), pagination_urls=T.ArrayType(_S), advertised_total=_I)
SIGNALS = struct(**texts("text", "title", "visible"), has_name=_B, has_provider=_B, has_frame=_B)
LANDING = struct(**texts("specialty_url", "specialty_slug", "specialty_id", "procedure_id", "search_query"), locations=T.ArrayType(struct(**texts("state_group", "location", "listing_url"))))

PROFILE_TEXTS = ["profile_url", "full_name", "first_name", "last_name", "prenominal", "postnominal", "specialty_name", "practice_name", "npi", "provider_id", "monolith_id", "average_rating", "review_count", "bio", "photo_url"]
PROFILE_FLAGS = ["state_found", "provider_found", "accepts_new_patients", "offers_telemedicine", "has_virtual_locations", "only_sees_children", "is_bookable", "is_preview", "marketplace_enabled", "has_new_patient_availability"]
#: What a profile parser says, before evidence from listings (fixed values: its names).
PROFILE = struct(
    **texts(*PROFILE_TEXTS), **dict.fromkeys(PROFILE_FLAGS, _B), hospital_affiliations=T.ArrayType(_S),
    locations=T.ArrayType(T.StructType([*LOCATION.fields, T.StructField("profile_key", _S)])),
)

LOCATION_LEVEL = ["state", "address_line_1", "address_line_2", "city", "postal_code", "phone", "location_id", "location_name", "can_have_appointments", "is_virtual_location", "has_new_patient_availability", "provider_location_key", "source_zip", "source_zip_state"]
#: The 35 columns of a provider at a location, in their published order.
FINAL_COLUMNS = [
    "state", "full_name", "specialty_name", "practice_name", "npi", "provider_id", "monolith_id", "first_name", "last_name", "prenominal", "postnominal", "average_rating", "review_count", "profile_url",
    "accepts_new_patients", "offers_telemedicine", "only_sees_children", "hospital_affiliations", "bio", "num_locations", "address_line_1", "address_line_2", "city", "postal_code", "phone", "location_id",
    "location_name", "can_have_appointments", "is_virtual_location", "has_new_patient_availability", "photo_url", "provider_location_key", "locations", "source_zip", "source_zip_state",
]
#: Their types; everything that isn't named here is text.
FINAL = T.StructType([
    T.StructField(c, {
        "hospital_affiliations": T.ArrayType(_S), "locations": T.ArrayType(T.StructType([*LOCATION.fields, T.StructField("provider_location_key", _S)])), "num_locations": _I,
        **dict.fromkeys(["accepts_new_patients", "offers_telemedicine", "only_sees_children", "can_have_appointments", "is_virtual_location", "has_new_patient_availability"], _B),
    }.get(c, _S))
    for c in FINAL_COLUMNS
])
UNIQUE_COLUMNS = [c for c in FINAL_COLUMNS if c not in LOCATION_LEVEL]

PAGES = struct(**texts("url", "base_location_url", "state_group", "location"), page_no=_I, **texts("source", "status"), advertised_total=_I, **texts("specialty_url", "specialty_name", "specialty_slug", "provider_set_hash", "trace_status"), retry_count=_I, discovered_at=_TS, saved_at=_TS)
MEMBERSHIPS = struct(**texts("specialty_slug", "location_url", "doctor_url"), is_active=_B, missing_streak=_I, first_seen_at=_TS, last_seen_at=_TS, inactive_at=_TS, name=_S)
PROFILES = struct(**texts("doctor_url", "doctor_name", "status", "file", "claimed_by"), discovered_at=_TS, saved_at=_TS, claimed_at=_TS, attempt_count=_I, last_error=_S)
MANIFEST = struct(event_at=_TS, **texts("status", "page_type", "url", "title", "file"), bytes=T.LongType(), error=_S)
STATE_TABLES = {"pages": PAGES, "memberships": MEMBERSHIPS, "profiles": PROFILES, "manifest": MANIFEST}
