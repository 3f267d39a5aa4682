"""Data-quality checks over the layers and the append-only audit log.

Design for scale:

* the row-level checks on one table (non-empty, NULL keys, duplicates, distance, dates,
  coordinates, flag logic) are **fused into one aggregation**: one scan, ``count_if`` per check and
  a single distinct count, then ``stack`` into one row per check;
* the trace check (every curated row has a raw row with the same keys) is a **co-grouped
  aggregation** instead of a join: both sides are reduced map-side to one row per key before the
  single shuffle, so neither a hot key nor a huge raw table creates a skewed join;
* only one-row aggregates ever reach the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow import fixed_values as FV
from routeflow.functions import columns as C
from routeflow.sources.tables import new_load_id, read_layer, write_layer
from routeflow.schemas import (
    AUDIT_COLUMNS,
    AUDIT_SCHEMA,
    FLIGHT_KEY_COLUMNS,
    LATITUDE_COLUMNS,
    LONGITUDE_COLUMNS,
    REQUIRED_COLUMNS,
    TRACE_KEY_COLUMNS,
)


@dataclass(frozen=True)
class Check:
    """One check: an id, a name, the layer it looks at, the name of its count, a message and the
    accepted range of the count (``expected_min``/``expected_max``; NULL = unbounded)."""

    check_id: str
    check_name: str
    layer: str
    count_name: str
    message: str
    expected_min: int | None
    expected_max: int | None

    @classmethod
    def of(cls, fixed: tuple, expected_min: int | None, expected_max: int | None) -> "Check":
        return cls(*fixed, expected_min, expected_max)

    def passes(self, count: Column) -> Column:
        conds = []
        if self.expected_min is not None:
            conds.append(count >= F.lit(self.expected_min))
        if self.expected_max is not None:
            conds.append(count <= F.lit(self.expected_max))
        return C.all_of(conds) if conds else F.lit(True)


RAW_NOT_EMPTY = Check.of(FV.CHECK_RAW_NOT_EMPTY, 1, None)
CLEAN_NOT_EMPTY = Check.of(FV.CHECK_CLEAN_NOT_EMPTY, 1, None)
NO_NULL_KEYS = Check.of(FV.CHECK_NO_NULL_KEYS, 0, 0)
NO_DUPLICATES = Check.of(FV.CHECK_NO_DUPLICATES, 0, 0)
DISTANCE_VALID = Check.of(FV.CHECK_DISTANCE_VALID, 0, 0)
FLIGHT_DATE_SANE = Check.of(FV.CHECK_FLIGHT_DATE_SANE, 0, 0)
COORDINATES_VALID = Check.of(FV.CHECK_COORDINATES_VALID, 0, 0)
CURATED_TRACES_TO_RAW = Check.of(FV.CHECK_CURATED_TRACES_TO_RAW, 0, 0)
INTERNATIONAL_LOGIC = Check.of(FV.CHECK_INTERNATIONAL_LOGIC, 0, 0)

ALL_CHECKS = (
    RAW_NOT_EMPTY,
    CLEAN_NOT_EMPTY,
    NO_NULL_KEYS,
    NO_DUPLICATES,
    DISTANCE_VALID,
    FLIGHT_DATE_SANE,
    COORDINATES_VALID,
    CURATED_TRACES_TO_RAW,
    INTERNATIONAL_LOGIC,
)
# The three checks the original audit insert records (with NULL expected bounds).
REFERENCE_LOGGED = (RAW_NOT_EMPTY, CLEAN_NOT_EMPTY, NO_NULL_KEYS)


# --- row predicates (a row "fails" when the predicate is TRUE; NULL never fails) --------------


def null_key_rows(keys: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    return C.any_null(keys)


def bad_distance(distance: str = "distance_km") -> Column:
    d = F.col(distance)
    return (d <= F.lit(FV.DISTANCE_MIN_EXCLUSIVE)) | (d > F.lit(FV.DISTANCE_MAX))


def bad_flight_date(flight_date: str = "flight_date") -> Column:
    d = F.col(flight_date)
    return (d < F.lit(FV.FLIGHT_DATE_MIN)) | (d > F.lit(FV.FLIGHT_DATE_MAX))


def bad_coordinates(lat: Sequence[str] = LATITUDE_COLUMNS, lon: Sequence[str] = LONGITUDE_COLUMNS) -> Column:
    return C.any_of(
        [C.outside(c, *FV.LATITUDE_RANGE) for c in lat] + [C.outside(c, *FV.LONGITUDE_RANGE) for c in lon]
    )


def flag_mismatch(
    flag: str = "is_international", a: str = "origin_country", b: str = "destination_country"
) -> Column:
    return C.flag_contradicts(flag, a, b)


ROW_PREDICATES = {
    NO_NULL_KEYS.check_id: null_key_rows,
    DISTANCE_VALID.check_id: bad_distance,
    FLIGHT_DATE_SANE.check_id: bad_flight_date,
    COORDINATES_VALID.check_id: bad_coordinates,
    INTERNATIONAL_LOGIC.check_id: flag_mismatch,
}


# --- stand-alone checks (one query each, the original row shape) ------------------------------


def _single(df: DataFrame, check: Check, count: Column) -> DataFrame:
    """One row: check_id, check_name, <count_name>, result."""
    agg = df.agg(count.cast(T.LongType()).alias(check.count_name))
    return agg.select(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.check_name).alias("check_name"),
        F.col(check.count_name),
        C.verdict(check.passes(F.col(check.count_name))).alias("result"),
    )


def row_count_check(df: DataFrame, check: Check) -> DataFrame:
    return _single(df, check, F.count(F.lit(1)))


def predicate_check(df: DataFrame, check: Check, predicate: Column) -> DataFrame:
    """Rows matching ``predicate`` (a filter the scan can push down), counted."""
    return _single(df.where(predicate), check, F.count(F.lit(1)))


def duplicate_check(df: DataFrame, check: Check = NO_DUPLICATES, keys: Sequence[str] = FLIGHT_KEY_COLUMNS) -> DataFrame:
    """Rows minus distinct key tuples; a tuple holding a NULL is not counted as distinct."""
    return _single(df, check, F.count(F.lit(1)) - F.countDistinct(*[F.col(k) for k in keys]))


def trace_keys(curated: DataFrame, raw: DataFrame, keys: Sequence[str] = TRACE_KEY_COLUMNS,
               raw_codes: Sequence[str] = ("airline_code", "flight_number")) -> tuple[DataFrame, DataFrame]:
    """Curated keys as stored, raw keys as curation would have cleaned them."""
    raw_key_cols = [(C.code(k) if k in raw_codes else F.col(k)).alias(k) for k in keys]
    return curated.select(*keys), raw.select(*raw_key_cols)


def orphan_count(curated: DataFrame, raw: DataFrame, keys: Sequence[str] = TRACE_KEY_COLUMNS) -> Column | DataFrame:
    """Number of curated rows without a raw row on equal ``keys`` (a NULL key never matches).

    Co-grouped aggregation: tag both sides, group by key, keep keys with no raw member. Both sides
    are pre-aggregated before the shuffle, so repeated or hot keys collapse early.
    """
    c_keys, r_keys = trace_keys(curated, raw, keys)
    complete = C.all_not_null(keys)
    tagged = c_keys.select(*keys, F.lit(1).alias("_c"), F.lit(0).alias("_r")).unionByName(
        r_keys.where(complete).select(*keys, F.lit(0).alias("_c"), F.lit(1).alias("_r"))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("_c").alias("_c"), F.max("_r").alias("_r"))
    orphans = per_key.where(F.col("_r") == 0)
    return orphans.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast(T.LongType()).alias("orphans"))


#: Orphan keys that may be broadcast.
BROADCAST_KEYS = 400_000


def orphan_rows(curated: DataFrame, raw: DataFrame, keys: Sequence[str] = TRACE_KEY_COLUMNS) -> DataFrame:
    """The curated rows themselves that trace to no raw row (``NOT EXISTS``).

    Keys alone are compared, by a left anti join of the distinct complete ones of both sides. The orphan keys are counted first: while they
    are few they are broadcast, and no whole row is shuffled.
    """
    c_keys, r_keys = (side.where(C.all_not_null(keys)).distinct() for side in trace_keys(curated, raw, keys))
    lost = c_keys.join(r_keys, list(keys), "left_anti")
    lost = (F.broadcast(lost) if lost.count() <= BROADCAST_KEYS else lost).alias("_r")
    keyed = curated.where(C.all_not_null(keys))
    orphans = keyed.join(lost, [keyed[k] == F.col(f"_r.{k}") for k in keys], "left_semi")
    return orphans.unionByName(curated.where(C.any_null(keys)))  # a NULL key never matches: no need to shuffle those


def trace_check(curated: DataFrame, raw: DataFrame, check: Check = CURATED_TRACES_TO_RAW) -> DataFrame:
    counted = orphan_count(curated, raw)
    return counted.select(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.check_name).alias("check_name"),
        F.col("orphans").alias(check.count_name),
        C.verdict(check.passes(F.col("orphans"))).alias("result"),
    )


# --- fused run of all checks + audit ----------------------------------------------------------

RESULT_COLUMNS = ("check_id", "check_name", "layer", "result", "actual_count", "expected_min", "expected_max", "message")


def rows_from_counts(counts: DataFrame, checks: Sequence[Check], with_bounds: bool = True) -> DataFrame:
    """Turn a one-row frame with one count column per check into one row per check (``stack``)."""
    args = []
    for i, chk in enumerate(checks):
        args += [F.lit(chk.check_id), F.lit(chk.check_name), F.lit(chk.layer), F.col(f"_n{i}").cast(T.LongType()),
                 F.lit(chk.expected_min if with_bounds else None).cast(T.LongType()),
                 F.lit(chk.expected_max if with_bounds else None).cast(T.LongType()), F.lit(chk.message)]
    stacked = counts.select(
        F.stack(F.lit(len(checks)), *args).alias(
            "check_id", "check_name", "layer", "actual_count", "expected_min", "expected_max", "message"
        )
    )
    verdicts = None
    for chk in checks:
        ok = chk.passes(F.col("actual_count"))
        cond = F.col("check_id") == F.lit(chk.check_id)
        verdicts = F.when(cond, C.verdict(ok)) if verdicts is None else verdicts.when(cond, C.verdict(ok))
    return stacked.select(*[verdicts.alias("result") if c == "result" else F.col(c) for c in RESULT_COLUMNS])


def curated_check_counts(curated: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One aggregation over the curated table computing the count of every row-level check (one row per task is shuffled)."""
    aggs = []
    for i, chk in enumerate(checks):
        e = F.count(F.lit(1)) if chk.check_id == CLEAN_NOT_EMPTY.check_id else F.count_if(ROW_PREDICATES[chk.check_id]())
        aggs.append(e.alias(f"_n{i}"))
    return curated.agg(*aggs)


def run_checks(curated: DataFrame, raw: DataFrame, *, reference_subset: bool = False) -> DataFrame:
    """All checks as rows (check_id, check_name, layer, result, actual_count, expected_min,
    expected_max, message): the fused curated aggregation, the raw count and the trace check.

    ``reference_subset=True`` gives only the three checks the original audit recorded, with NULL
    expected bounds.
    """
    with_bounds = not reference_subset
    if reference_subset:
        raw_part = rows_from_counts(raw.agg(F.count(F.lit(1)).alias("_n0")), [RAW_NOT_EMPTY], with_bounds)
        cur_checks = [c for c in REFERENCE_LOGGED if c is not RAW_NOT_EMPTY]
        return raw_part.unionByName(rows_from_counts(curated_check_counts(curated, cur_checks), cur_checks, with_bounds))
    cur_checks = [c for c in ALL_CHECKS if c not in (RAW_NOT_EMPTY, CURATED_TRACES_TO_RAW, NO_DUPLICATES)]
    raw_part = rows_from_counts(raw.agg(F.count(F.lit(1)).alias("_n0")), [RAW_NOT_EMPTY])
    cur_part = rows_from_counts(curated_check_counts(curated, cur_checks), cur_checks)
    trace_part = rows_from_counts(
        orphan_count(curated, raw).select(F.col("orphans").alias("_n0")), [CURATED_TRACES_TO_RAW]
    )
    # the key tuples shuffle on their own, without the other counters riding along
    repeats = F.count(F.lit(1)) - F.countDistinct(*[F.col(k) for k in FLIGHT_KEY_COLUMNS])
    repeat_part = rows_from_counts(curated.agg(repeats.alias("_n0")), [NO_DUPLICATES])
    return raw_part.unionByName(cur_part).unionByName(repeat_part).unionByName(trace_part)


def _instant(moment: _dt.datetime | Column) -> Column:
    """A moment as a column; a datetime without a zone is read in the session's zone, not the driver process's."""
    if isinstance(moment, Column):
        return moment
    return F.lit(moment.isoformat(sep=" ")).cast(T.TimestampType())


def append_audit(results: DataFrame, audit_path: str, run_at: _dt.datetime | Column | None = None,
                 run_id: str | None = None) -> str:
    """Append check results to the audit log (created on first write, history never wiped).

    Each run is its own ``load_id=<run_id>`` slice written with overwrite, so a retried write of
    the same run replaces its rows instead of logging them twice. Returns the run id.
    """
    ts = F.current_timestamp() if run_at is None else _instant(run_at)
    out = results.withColumn("run_at", ts.cast(T.TimestampType())).select(*AUDIT_COLUMNS)
    return write_layer(out.coalesce(1), audit_path, run_id or new_load_id("audit"), AUDIT_SCHEMA)


def read_audit(spark, audit_path: str) -> DataFrame:
    return read_layer(spark, audit_path, AUDIT_SCHEMA)


def recent_audit(audit: DataFrame, as_of: _dt.datetime | Column | None = None,
                 minutes: int = FV.AUDIT_LOOKBACK_MINUTES) -> DataFrame:
    """Audit rows newer than ``as_of - minutes`` (strict), newest first."""
    now = F.current_timestamp() if as_of is None else _instant(as_of)
    since = now.cast(T.TimestampType()) - F.make_interval(mins=F.lit(minutes))
    return (
        audit.where(F.col("run_at") > since)
        .select("check_id", "check_name", "layer", "result", "actual_count", "run_at")
        .orderBy(F.desc("run_at"), F.asc("check_id"))
    )
