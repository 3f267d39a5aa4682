"""The pipeline's tables and views in a SQL catalog: raw, curated and enriched rows, an inbox for inserts, and four stored views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from routeflow.operators import views as V
from routeflow.plans.layers import Layers
from routeflow.schemas import CURATED_SCHEMA, ENRICHED_COLUMNS, LOAD_TIMESTAMP, RAW_SCHEMA, SOURCE_FILE
from routeflow.sources.catalog_tables import Names, declare_slices, declare_table, refresh_slices, store_view
from routeflow.streaming.incremental import take_inserts

RAW, CURATED, ENRICHED, INBOX = "raw_routes", "curated_routes", "enriched_routes", "raw_routes_inbox"

#: What an insert leaves out is filled by these.
INBOX_DEFAULTS = {LOAD_TIMESTAMP: "current_timestamp()", SOURCE_FILE: "'sql_insert'"}

_ENRICHED_OTHER = {f: T.StringType() for f in ("route_classification", "route_summary")} | {"enriched_at": T.TimestampType()}
ENRICHED_SCHEMA = T.StructType(
    [T.StructField(c, _ENRICHED_OTHER.get(c) or CURATED_SCHEMA[c].dataType, True) for c in ENRICHED_COLUMNS]
)


def grouped(source: str, keys: Sequence[str], measures: Mapping[str, str]) -> str:
    """An aggregate query: key columns, then the measures under their names."""
    shown = [*keys, *(f"{how} AS {name}" for name, how in measures.items())]
    return f"SELECT {', '.join(shown)} FROM {source} GROUP BY {', '.join(keys)}"


def view_queries(names: Names) -> dict[str, str]:
    """The four reporting views over the catalog's tables, equal to those of ``operators/views.py``."""
    curated = names.of(CURATED)
    carrier = ("airline_code", "airline_name")
    legs = grouped(
        curated,
        (*carrier, "route_key", "origin_country"),
        {"n": "count(*)", "km": "sum(distance_km)", "with_km": "count(distance_km)", "abroad": "count_if(is_international)"},
    )
    ends = ", ".join(f"struct({e}_airport AS airport_code, {e}_city AS city, {e}_country AS country)" for e in ("origin", "destination"))
    keys = ("route_key", "flight_number")
    shown = [f"c.{x}" for x in V.DASHBOARD_CURATED] + [f"e.{x}" for x in V.DASHBOARD_ENRICHED]
    return {
        "v_route_summary": grouped(
            curated,
            V.ROUTE_GROUP,
            {
                "avg_distance_km": "round(avg(distance_km), 1)",
                "flight_count": "count(*)",
                "airline_count": "count(DISTINCT airline_code)",
                "total_seats": "sum(seats)",
                "first_flight": "min(flight_date)",
                "last_flight": "max(flight_date)",
            },
        ),
        "v_airline_stats": grouped(
            f"({legs})",
            carrier,
            {
                "total_flights": "sum(n)",
                "unique_routes": "count(DISTINCT route_key)",
                "countries_served": "count(DISTINCT origin_country)",
                "avg_distance_km": "round(try_divide(sum(km), sum(with_km)), 1)",
                "international_flights": "sum(abroad)",
                "pct_international": "round(CAST(100.0D * sum(abroad) / sum(n) AS DOUBLE), 1)",
            },
        ),
        "v_busiest_airports": grouped(
            f"(SELECT route_key, at.* FROM (SELECT route_key, explode(array({ends})) AS at FROM {curated}))",
            ("airport_code", "city", "country"),
            {"total_appearances": "count(*)", "unique_routes": "count(DISTINCT route_key)"},
        ),
        "v_enriched_routes_dashboard": f"SELECT {', '.join(shown)} FROM {curated} c LEFT JOIN {names.of(ENRICHED)} e ON "
        + " AND ".join(f"c.{k} = e.{k}" for k in keys),
    }


def declare(spark: SparkSession, layers: Layers, database: str) -> Names:
    """Tables and views of a pipeline instance under SQL names, kept in its root (``catalog_tables.attach`` brings them back)."""
    names = Names(database, f"{layers.root}/catalog")
    declare_slices(spark, names, RAW, layers.raw, RAW_SCHEMA)
    declare_slices(spark, names, CURATED, layers.curated, CURATED_SCHEMA)
    declare_table(spark, names, ENRICHED, ENRICHED_SCHEMA, path=layers.enriched)
    declare_table(spark, names, INBOX, RAW_SCHEMA, INBOX_DEFAULTS)
    for name, query in view_queries(names).items():
        store_view(spark, names, name, query)
    return names


def refresh(spark: SparkSession, layers: Layers, names: Names) -> None:
    """Let SQL see what was committed since."""
    refresh_slices(spark, names, RAW, layers.raw)
    refresh_slices(spark, names, CURATED, layers.curated)
    spark.catalog.refreshTable(names.of(ENRICHED))


def take_inbox(spark: SparkSession, layers: Layers, names: Names) -> None:
    """Rows inserted through SQL since the last call become slices of the raw table, once."""
    take_inserts(spark, names.data(INBOX), layers.raw, RAW_SCHEMA, layers.checkpoint("inbox"))
    refresh_slices(spark, names, RAW, layers.raw)
