"""Mergeable states of views and checks: each new slice of a table is read once, and results are merged from what was kept of it.

The state job follows the table's ledger and writes, for each micro-batch, one slice of small tables, committed as a whole:

* for every view, its sums, extremes and counts by group *and* by the value whose distinct count the view shows (carrier of a route, route and
  country of a carrier, route of an airport). Merging adds up the rest and counts the distinct values, exactly;
* for the checks, one row of counters, and the key tuples with their number of rows (as 128-bit digests of complete tuples);
* of the raw table, the row count and the distinct digests of the cleaned trace keys.

Views and checks read these states only. They equal the full aggregations of ``views`` and ``quality`` over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.functions import columns as C
from routeflow.operators import quality as Q
from routeflow.operators import views as V
from routeflow.schemas import CURATED_SCHEMA, FLIGHT_KEY_COLUMNS, RAW_SCHEMA, TRACE_KEY_COLUMNS
from routeflow.sources import ledger
from routeflow.sources.tables import read_slices, stage_slice
from routeflow.streaming.incremental import drain, slice_folders, stream_tag

#: Check counters a state row holds, besides its number of rows.
COUNTERS = {check_id: predicate for check_id, predicate in Q.ROW_PREDICATES.items()}


def key_digest(columns: Sequence[Column | str]) -> Column:
    """128-bit digest of a tuple; NULL if a part is NULL."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.when(C.all_of(p.isNotNull() for p in parts), F.unhex(F.md5(F.to_json(F.array(*(p.cast("string") for p in parts))))))


# --- states of one slice ------------------------------------------------------------------------


def route_state(curated: DataFrame) -> DataFrame:
    return curated.groupBy(*V.ROUTE_GROUP, "airline_code").agg(
        F.sum("distance_km").alias("km"),
        F.count("distance_km").alias("with_km"),
        F.count(F.lit(1)).alias("n"),
        F.sum("seats").alias("seats"),
        F.min("flight_date").alias("first_flight"),
        F.max("flight_date").alias("last_flight"),
    )


def airline_state(curated: DataFrame) -> DataFrame:
    return curated.groupBy("airline_code", "airline_name", "route_key", "origin_country").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(C.as_flag(F.col("is_international"))).cast("long").alias("abroad"),
        F.sum("distance_km").alias("km"),
        F.count("distance_km").alias("with_km"),
    )


def airport_state(curated: DataFrame) -> DataFrame:
    return V.airport_roles(curated).groupBy("airport_code", "city", "country", "route_key").agg(F.count(F.lit(1)).alias("n"))


def check_state(curated: DataFrame) -> DataFrame:
    return curated.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(p()).alias(check) for check, p in COUNTERS.items()))


def tuple_state(curated: DataFrame) -> DataFrame:
    """Complete flight key tuples, once each."""
    return curated.select(key_digest(FLIGHT_KEY_COLUMNS).alias("flight")).where("flight IS NOT NULL").distinct()


def trace_state(curated: DataFrame) -> DataFrame:
    """Curated rows by trace key; those with an incomplete key, which trace to nothing, under NULL."""
    return curated.groupBy(key_digest(TRACE_KEY_COLUMNS).alias("trace")).agg(F.count(F.lit(1)).alias("n"))


def raw_trace_state(raw: DataFrame) -> DataFrame:
    _, keys = Q.trace_keys(raw, raw)
    return keys.select(key_digest(TRACE_KEY_COLUMNS).alias("trace")).where("trace IS NOT NULL").distinct()


def raw_count_state(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("n"))


CURATED_STATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "route": route_state, "airline": airline_state, "airport": airport_state, "checks": check_state, "tuples": tuple_state, "trace": trace_state,
}
RAW_STATES: dict[str, Callable[[DataFrame], DataFrame]] = {"count": raw_count_state, "trace": raw_trace_state}


# --- keeping and reading them -------------------------------------------------------------------


def update_states(
    spark: SparkSession, table: str, schema: T.StructType, states: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, max_slices: int | None = None
) -> None:
    """Bring the states at ``path`` up to the table's last committed slice; slices read before are not read again."""
    tag = stream_tag(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load_id = f"state-{tag}-{batch_id:010d}"
        folders = slice_folders(batch)
        if not folders or ledger.holds(ledger.entries(session, path), load_id):
            return
        rows = read_slices(session, table, schema, folders)
        ledger.commit(session, path, load_id, stage_slice({name: of(rows) for name, of in states.items()}, path, load_id))

    drain(spark, table, checkpoint, write_batch, max_slices)


def update_all(spark: SparkSession, layers) -> None:
    """States of the raw and the curated table of a pipeline instance."""
    update_states(spark, layers.raw, RAW_SCHEMA, RAW_STATES, layers.states("raw"), layers.checkpoint("raw-states"))
    update_states(spark, layers.curated, CURATED_SCHEMA, CURATED_STATES, layers.states("curated"), layers.checkpoint("curated-states"))


def read_state(spark: SparkSession, path: str, part: str, states: dict[str, Callable[[DataFrame], DataFrame]], schema: T.StructType) -> DataFrame:
    """All kept rows of one state."""
    shape = states[part](spark.createDataFrame([], schema)).schema
    return read_slices(spark, path, shape, [e.folder for e in ledger.live(ledger.entries(spark, path))], part)


def _curated(spark: SparkSession, layers, part: str) -> DataFrame:
    return read_state(spark, layers.states("curated"), part, CURATED_STATES, CURATED_SCHEMA)


def _raw(spark: SparkSession, layers, part: str) -> DataFrame:
    return read_state(spark, layers.states("raw"), part, RAW_STATES, RAW_SCHEMA)


# --- views and checks from states ---------------------------------------------------------------


def _mean(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(count)), 1)


def route_summary(spark: SparkSession, layers) -> DataFrame:
    return _curated(spark, layers, "route").groupBy(*V.ROUTE_GROUP).agg(
        _mean("km", "with_km").alias("avg_distance_km"),
        F.sum("n").alias("flight_count"),
        F.countDistinct("airline_code").alias("airline_count"),
        F.sum("seats").alias("total_seats"),
        F.min("first_flight").alias("first_flight"),
        F.max("last_flight").alias("last_flight"),
    )


def airline_stats(spark: SparkSession, layers) -> DataFrame:
    return _curated(spark, layers, "airline").groupBy("airline_code", "airline_name").agg(
        F.sum("n").alias("total_flights"),
        F.countDistinct("route_key").alias("unique_routes"),
        F.countDistinct("origin_country").alias("countries_served"),
        _mean("km", "with_km").alias("avg_distance_km"),
        F.sum("abroad").alias("international_flights"),
        F.round((F.lit(100.0) * F.sum("abroad") / F.sum("n")).cast("double"), 1).alias("pct_international"),
    )


def busiest_airports(spark: SparkSession, layers) -> DataFrame:
    return _curated(spark, layers, "airport").groupBy("airport_code", "city", "country").agg(
        F.sum("n").alias("total_appearances"), F.countDistinct("route_key").alias("unique_routes")
    )


def run_checks(spark: SparkSession, layers) -> DataFrame:
    """All nine checks, as ``quality.run_checks`` gives them, from states."""
    sums = _curated(spark, layers, "checks").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *COUNTERS)))
    checks = [Q.CLEAN_NOT_EMPTY, *(c for c in Q.ALL_CHECKS if c.check_id in COUNTERS)]
    named = sums.select(*(F.col("n" if c is Q.CLEAN_NOT_EMPTY else c.check_id).alias(f"_n{i}") for i, c in enumerate(checks)))
    out = Q.rows_from_counts(named, checks)

    raw = _raw(spark, layers, "count").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_n0"))
    out = out.unionByName(Q.rows_from_counts(raw, [Q.RAW_NOT_EMPTY]))

    distinct = _curated(spark, layers, "tuples").agg(F.countDistinct("flight").alias("tuples"))
    repeats = sums.crossJoin(distinct).select((F.col("n") - F.col("tuples")).alias("_n0"))  # one row each
    out = out.unionByName(Q.rows_from_counts(repeats, [Q.NO_DUPLICATES]))

    tagged = _curated(spark, layers, "trace").select("trace", "n", F.lit(0).alias("raw")).unionByName(
        _raw(spark, layers, "trace").select("trace", F.lit(0).cast("long").alias("n"), F.lit(1).alias("raw"))
    )
    per_key = tagged.groupBy("trace").agg(F.sum("n").alias("n"), F.max("raw").alias("raw"))
    orphans = per_key.where("raw = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_n0"))
    return out.unionByName(Q.rows_from_counts(orphans, [Q.CURATED_TRACES_TO_RAW]))
