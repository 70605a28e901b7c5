"""Text, tri-state and domain values as native column expressions.

Unknown and false are different everywhere: a tri-state value is a nullable boolean. Missing text is
the empty string, missing numbers, flags and times are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Java's \s alone is ASCII.
SPACE = r"[\s\x{85}\p{Z}\x1c-\x1f]+"

#: Words that mark a catalog entry as a place, not a kind of provider.
FACILITY_MARKERS = ("facility", "facilities", "clinic", "clinics", "urgent care")


def text(x: Column) -> Column:
    """Missing is empty."""
    return F.coalesce(x.cast("string"), F.lit(""))


def strip(x: Column) -> Column:
    return F.regexp_replace(text(x), f"^{SPACE}|{SPACE}$", "")


def collapse(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text(x), SPACE, " "))


def tri_bool(x: Column) -> Column:
    """Text as true, false or unknown; numbers 0 and 1 count through tri_number."""
    low = F.lower(strip(x))
    return F.when(low.isin("true", "1", "yes", "y"), True).when(low.isin("false", "0", "no", "n"), False)


def tri_number(x: Column) -> Column:
    return F.when(x == 1, True).when(x == 0, False)


def export_bool(x: Column) -> Column:
    """The narrower reading of exported files: y and n are unknown."""
    low = F.lower(strip(x))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


def first_nonempty(*xs: Column) -> Column:
    """The first text that is neither null nor empty; 0 and false count as values."""
    return F.coalesce(*(F.nullif(x.cast("string"), F.lit("")) for x in xs), F.lit(""))


def first_nonempty_array(*xs: Column) -> Column:
    return F.coalesce(*(F.when(F.size(x) > 0, x) for x in xs))


def normalize_state(x: Column) -> Column:
    """Two letters, upper-cased, else null."""
    up = F.upper(strip(x))
    return F.when(up.rlike("^[A-Z]{2}$"), up)


def normalize_zip(x: Column) -> Column:
    """Five digits: short numbers padded, `.0` cut off, else the first five-digit number; 00000 is null."""
    raw = F.regexp_replace(strip(x), r"^([0-9]+)\.0+$", "$1")
    inner = F.regexp_extract(raw, r"(?<![0-9])([0-9]{5})(?:-[0-9]{4})?(?![0-9])", 1)
    code = F.when(raw.rlike("^[0-9]{1,5}$"), F.lpad(raw, 5, "0")).otherwise(F.nullif(inner, F.lit("")))
    return F.nullif(code, F.lit("00000"))


def split_name(x: Column) -> Column:
    """first_name, last_name, prenominal, postnominal of a full name."""
    whole = strip(x)
    title = F.regexp_extract(whole, rf"(?i)^(Dr\.|Mr\.|Ms\.|Mrs\.){SPACE}", 1)
    rest = F.regexp_replace(whole, rf"(?i)^(?:Dr\.|Mr\.|Ms\.|Mrs\.){SPACE}", "")
    tokens = F.filter(F.split(collapse(F.substring_index(rest, ",", 1)), " "), lambda t: t != "")
    return F.struct(
        F.coalesce(F.get(tokens, F.lit(0)), F.lit("")).alias("first_name"),
        F.when(F.size(tokens) > 1, F.element_at(tokens, -1)).otherwise("").alias("last_name"),
        title.alias("prenominal"),
        strip(F.regexp_extract(rest, "(?s)^[^,]*,(.*)$", 1)).alias("postnominal"),
    )


def assemble_name(prefix: Column, full: Column, suffix: Column) -> Column:
    """Prefix and name with a space, the suffix glued on."""
    joined = F.concat_ws(" ", F.nullif(text(prefix), F.lit("")), F.nullif(text(full), F.lit("")))
    return F.concat(joined, text(suffix))


def photo_url(x: Column) -> Column:
    t = strip(x)
    return F.when(t.startswith("//"), F.concat(F.lit("https:"), t)).otherwise(t)


def affiliation_names(x: Column) -> Column:
    """An array of (name, display_name, hospital_name, title) structs as distinct names in order."""
    names = F.transform(x, lambda s: first_nonempty(s["name"], s["display_name"], s["hospital_name"], s["title"]))
    return distinct_texts(F.coalesce(names, F.array().cast("array<string>")))


def distinct_texts(x: Column) -> Column:
    """Non-empty texts, each once, in order of first appearance."""
    return F.array_distinct(F.filter(x, lambda s: s.isNotNull() & (s != "")))


def entity_type(name: Column) -> Column:
    low = F.lower(collapse(name))
    hit = low.rlike("|".join(FACILITY_MARKERS))
    return F.when(hit, "facility_or_clinic").otherwise("provider_specialty")


def normalize_location(x: Column) -> Column:
    return F.regexp_replace(collapse(x), "^[ .,;:]+|[ .,;:]+$", "")


def normalize_specialty(x: Column) -> Column:
    return F.lower(normalize_location(x))


def runner_token(x: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(strip(x), r"[^\p{Alnum}\p{L}\p{N}_-]", "-"), F.lit("")), F.lit("runner"))


def selector(values: list[str] | tuple[str, ...]) -> list[str]:
    """Names to filter by: trimmed, lower-cased, blanks dropped, each once."""
    return list(dict.fromkeys(v.strip().lower() for v in values if v and v.strip()))


def matches_selector(values: list[str], *columns: Column) -> Column:
    """Whether any of the columns is one of the values; no values select all."""
    wanted = selector(values)
    if not wanted:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.lower(strip(c)).isin(*wanted)
    return hit


def csv_value(x: Column, nested: bool = False) -> Column:
    """A cell: nested values as JSON, null as empty."""
    return F.coalesce(F.to_json(x) if nested else x.cast("string"), F.lit(""))
