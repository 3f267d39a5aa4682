"""Fixed values.

These literals must equal the pipeline being rebuilt for results to match: NULL spellings of the
landing format, category thresholds and names, classifier labels, prompt texts, data-quality
check identifiers / names / messages / bounds, the enrichment sample size, the audit look-back
and the manual smoke row. They are kept here, in natural order, and nowhere else.
"""

from __future__ import annotations

import datetime as _dt

# --- landing CSV format ---------------------------------------------------------------
NULL_SPELLINGS = ("", "NULL", "null")
CSV_QUOTE = '"'
CSV_HEADER_LINES = 1

# --- curated derivations --------------------------------------------------------------
ROUTE_KEY_SEPARATOR = "-"
# distance_km < 1500 -> SHORT, < 4000 -> MEDIUM, else (including NULL) LONG
DISTANCE_CATEGORIES = ((1500, "SHORT"), (4000, "MEDIUM"))
DISTANCE_CATEGORY_ELSE = "LONG"

# --- enrichment -----------------------------------------------------------------------
ROUTE_LABELS = ("DOMESTIC_SHORT", "DOMESTIC_LONG", "INTERNATIONAL_REGIONAL", "INTERNATIONAL_LONG_HAUL")
COMPLETION_MODEL = "claude-4-sonnet"
# Classification prompt:
#   'Route from ', origin_city, ', ', origin_country, ' to ', destination_city, ', ',
#   destination_country, '. Distance: ', distance_km, ' km.'
CLASSIFY_PROMPT_TEMPLATE = (
    "Route from ", "{origin_city}", ", ", "{origin_country}",
    " to ", "{destination_city}", ", ", "{destination_country}",
    ". Distance: ", "{distance_km}", " km.",
)
# Summary prompt:
#   'In one sentence, describe this flight route: ', airline_name, ' flight ', flight_number,
#   ' from ', origin_city, ' (', origin_country, ')', ' to ', destination_city,
#   ' (', destination_country, ')', ', distance ', distance_km, ' km, ',
#   seats, ' seats on ', aircraft_type, '.'
SUMMARY_PROMPT_TEMPLATE = (
    "In one sentence, describe this flight route: ",
    "{airline_name}", " flight ", "{flight_number}",
    " from ", "{origin_city}", " (", "{origin_country}", ")",
    " to ", "{destination_city}", " (", "{destination_country}", ")",
    ", distance ", "{distance_km}", " km, ",
    "{seats}", " seats on ", "{aircraft_type}", ".",
)
ENRICH_SAMPLE_ROWS = 20

# --- data-quality checks --------------------------------------------------------------
# (check_id, check_name, layer, count column, message). Ids, names, the RAW / CURATED layers and the
# first three messages are fixed; the count-column names are lower-cased; messages of the six checks the
# audit log did not record before are our wording.
CHECK_RAW_NOT_EMPTY = ("CHK_RAW_NOT_EMPTY", "Raw table has rows", "RAW", "row_count", "Expected > 0 rows")
CHECK_CLEAN_NOT_EMPTY = ("CHK_CLEAN_NOT_EMPTY", "Clean table has rows", "CURATED", "row_count", "Expected > 0 rows")
CHECK_NO_NULL_KEYS = (
    "CHK_NO_NULL_KEYS", "Curated: no nulls in keys", "CURATED", "null_count", "Expected 0 null-key rows",
)
CHECK_NO_DUPLICATES = (
    "CHK_NO_DUPLICATES", "Curated: no duplicate flight rows", "CURATED", "duplicates", "Expected 0 duplicate rows",
)
CHECK_DISTANCE_VALID = (
    "CHK_DISTANCE_VALID", "Distance within 0–20000 km", "CURATED", "invalid_count", "Expected 0 invalid rows",
)
CHECK_FLIGHT_DATE_SANE = (
    "CHK_FLIGHT_DATE_SANE", "Flight dates between 1970–2030", "CURATED", "invalid_count", "Expected 0 invalid rows",
)
CHECK_COORDINATES_VALID = (
    "CHK_COORDINATES_VALID", "Origin/dest coordinates valid", "CURATED", "invalid_count", "Expected 0 invalid rows",
)
CHECK_CURATED_TRACES_TO_RAW = (
    "CHK_CURATED_TRACES_TO_RAW", "All curated rows traceable to raw", "CURATED", "orphan_count",
    "Expected 0 orphan rows",
)
CHECK_INTERNATIONAL_LOGIC = (
    "CHK_INTERNATIONAL_LOGIC", "IS_INTERNATIONAL matches country diff", "CURATED", "mismatch_count",
    "Expected 0 mismatched rows",
)
DISTANCE_MIN_EXCLUSIVE = 0
DISTANCE_MAX = 20000
FLIGHT_DATE_MIN = _dt.date(1970, 1, 1)
FLIGHT_DATE_MAX = _dt.date(2030, 12, 31)
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)
RESULT_PASS = "PASS"
RESULT_FAIL = "FAIL"
AUDIT_LOOKBACK_MINUTES = 5

# --- incremental cadence --------------------------------------------------------------
INCREMENTAL_INTERVAL = "5 minutes"

# --- manual smoke row -----------------------------------------------------------------
SMOKE_ROW = (
    "AA", "American Airlines", "AA100",
    "JFK", "New York", "USA", "North America",
    40.6413, -73.7781,
    "LHR", "London", "United Kingdom", "Europe",
    51.4700, -0.4543,
    5541.0, 220, "B77W", 0, 0,
    _dt.date(2026, 4, 21), 2026, 4, 2,
)
SMOKE_SOURCE_FILE = "manual_test_insert"
