"""Table schemas and named column groups of the route pipeline.

Every operator takes column names as parameters; the tuples below are only the
defaults for the route tables (raw, curated, enriched, audit).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source columns of a landing file, in file order (positional binding).
# ---------------------------------------------------------------------------
_S, _D, _N, _DT = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()

SOURCE_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("airline_code", _S),
    ("airline_name", _S),
    ("flight_number", _S),
    ("origin_airport", _S),
    ("origin_city", _S),
    ("origin_country", _S),
    ("origin_region", _S),
    ("origin_latitude", _D),
    ("origin_longitude", _D),
    ("destination_airport", _S),
    ("destination_city", _S),
    ("destination_country", _S),
    ("destination_region", _S),
    ("destination_latitude", _D),
    ("destination_longitude", _D),
    ("distance_km", _D),
    ("seats", _N),
    ("aircraft_type", _S),
    ("codeshare", _N),
    ("stops", _N),
    ("flight_date", _DT),
    ("flight_year", _N),
    ("flight_month", _N),
    ("flight_quarter", _N),
)
SOURCE_COLUMNS: tuple[str, ...] = tuple(n for n, _ in SOURCE_FIELDS)

# Metadata columns
LOAD_TIMESTAMP = "load_timestamp"
SOURCE_FILE = "source_file"
# Storage-only partition column of the layer tables: one value per load / micro-batch,
# which makes every write an idempotent overwrite of its own directory.
LOAD_ID = "load_id"

# Derived curated columns
ROUTE_KEY = "route_key"
IS_INTERNATIONAL = "is_international"
DISTANCE_CATEGORY = "distance_category"


def _fields(pairs) -> list[T.StructField]:
    return [T.StructField(n, t, True) for n, t in pairs]


# Landing file read as text first: ragged rows stay rows, typing happens afterwards.
LANDING_TEXT_SCHEMA = T.StructType([T.StructField(n, _S, True) for n in SOURCE_COLUMNS])

RAW_SCHEMA = T.StructType(
    _fields(SOURCE_FIELDS)
    + [T.StructField(LOAD_TIMESTAMP, T.TimestampType(), True), T.StructField(SOURCE_FILE, _S, True)]
)
RAW_COLUMNS: tuple[str, ...] = tuple(RAW_SCHEMA.names)


def full_width(schema: T.StructType) -> T.StructType:
    """``schema`` with whole numbers of up to 38 digits in place of 64 bits."""
    wide = T.DecimalType(38, 0)
    return T.StructType([T.StructField(f.name, wide if isinstance(f.dataType, T.LongType) else f.dataType, f.nullable) for f in schema.fields])


def landing_fields(schema: T.StructType) -> tuple[tuple[str, T.DataType], ...]:
    """The columns of a table that its landing files hold, in file order: all but those that the load adds."""
    return tuple((f.name, f.dataType) for f in schema.fields if f.name not in (LOAD_TIMESTAMP, SOURCE_FILE))


CURATED_SCHEMA = T.StructType(
    _fields(SOURCE_FIELDS)
    + [
        T.StructField(ROUTE_KEY, _S, True),
        T.StructField(IS_INTERNATIONAL, T.BooleanType(), True),
        T.StructField(DISTANCE_CATEGORY, _S, True),
        T.StructField(LOAD_TIMESTAMP, T.TimestampType(), True),
        T.StructField(SOURCE_FILE, _S, True),
    ]
)
CURATED_COLUMNS: tuple[str, ...] = tuple(CURATED_SCHEMA.names)

ENRICHED_COLUMNS: tuple[str, ...] = (
    "airline_code",
    "airline_name",
    "flight_number",
    "route_key",
    "origin_city",
    "origin_country",
    "destination_city",
    "destination_country",
    "distance_km",
    "seats",
    "aircraft_type",
    "is_international",
    "distance_category",
    "route_classification",
    "route_summary",
    "enriched_at",
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("check_id", _S, True),
        T.StructField("check_name", _S, True),
        T.StructField("layer", _S, True),
        T.StructField("result", _S, True),
        T.StructField("actual_count", _N, True),
        T.StructField("expected_min", _N, True),
        T.StructField("expected_max", _N, True),
        T.StructField("message", _S, True),
        T.StructField("run_at", T.TimestampType(), True),
    ]
)
AUDIT_COLUMNS: tuple[str, ...] = tuple(AUDIT_SCHEMA.names)

# ---------------------------------------------------------------------------
# Column groups used by the curation step.
# ---------------------------------------------------------------------------
# Codes: trimmed and upper-cased.
CODE_COLUMNS: tuple[str, ...] = (
    "airline_code",
    "flight_number",
    "origin_airport",
    "destination_airport",
    "aircraft_type",
)
# Free text: trimmed, case kept.
TEXT_COLUMNS: tuple[str, ...] = (
    "airline_name",
    "origin_city",
    "origin_country",
    "origin_region",
    "destination_city",
    "destination_country",
    "destination_region",
)
# A raw row must have all of these (tested on the untrimmed value) to be curated.
REQUIRED_COLUMNS: tuple[str, ...] = ("airline_code", "flight_date", "origin_airport", "destination_airport")
# Business key of a flight row (duplicate check).
FLIGHT_KEY_COLUMNS: tuple[str, ...] = (
    "airline_code",
    "flight_number",
    "flight_date",
    "origin_airport",
    "destination_airport",
)
# Keys a curated row is traced back to raw by.
TRACE_KEY_COLUMNS: tuple[str, ...] = ("airline_code", "flight_number", "flight_date")
LATITUDE_COLUMNS: tuple[str, ...] = ("origin_latitude", "destination_latitude")
LONGITUDE_COLUMNS: tuple[str, ...] = ("origin_longitude", "destination_longitude")


def type_of(name: str) -> T.DataType:
    """Target type of a source column."""
    return dict(SOURCE_FIELDS)[name]
