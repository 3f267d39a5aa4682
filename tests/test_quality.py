import datetime as dt

from conftest import route_row, routes_df
from pyspark.sql import functions as F

from routeflow.operators import quality as Q
from routeflow.operators.curate import curate


def _cur(spark, rows):
    return curate(routes_df(spark, rows))


def _count(df):
    return df.first()[2]


def test_not_empty_and_empty_input(spark):
    empty = _cur(spark, [route_row()]).where(F.lit(False))
    r = Q.row_count_check(empty, Q.CLEAN_NOT_EMPTY).first()
    assert (r["row_count"], r["result"]) == (0, "FAIL")
    r = Q.row_count_check(_cur(spark, [route_row()]), Q.CLEAN_NOT_EMPTY).first()
    assert (r["row_count"], r["result"]) == (1, "PASS")


def test_duplicates_count_null_tuples(spark):
    rows = [route_row(), route_row(), route_row(flight_number=None), route_row(flight_number=None), route_row(stops=3)]
    r = Q.duplicate_check(_cur(spark, rows)).first()
    # 5 rows, distinct complete tuples: 1 -> 4 duplicates (both NULL-number rows count)
    assert (r["duplicates"], r["result"]) == (4, "FAIL")


def test_distance_date_coordinates(spark):
    rows = [route_row(distance_km=d) for d in (0.0, -1.0, 20000.0, 20000.1, None, 1.0)]
    assert _count(Q.predicate_check(_cur(spark, rows), Q.DISTANCE_VALID, Q.bad_distance())) == 3
    dates = [dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2030, 12, 31), dt.date(2031, 1, 1)]
    rows = [route_row(flight_date=d) for d in dates]
    assert _count(Q.predicate_check(_cur(spark, rows), Q.FLIGHT_DATE_SANE, Q.bad_flight_date())) == 2
    rows = [route_row(origin_latitude=90.0), route_row(destination_latitude=-90.0), route_row(origin_latitude=95.0),
            route_row(origin_longitude=180.5), route_row(destination_longitude=None)]
    assert _count(Q.predicate_check(_cur(spark, rows), Q.COORDINATES_VALID, Q.bad_coordinates())) == 2


def test_international_logic_flipped_flag(spark):
    cur = _cur(spark, [route_row(), route_row(destination_country="USA"), route_row(origin_country=None)])
    assert _count(Q.predicate_check(cur, Q.INTERNATIONAL_LOGIC, Q.flag_mismatch())) == 0
    flipped = cur.withColumn("is_international", ~F.col("is_international"))
    r = Q.predicate_check(flipped, Q.INTERNATIONAL_LOGIC, Q.flag_mismatch()).first()
    assert (r["mismatch_count"], r["result"]) == (2, "FAIL")  # the NULL-country row never counts


def test_trace_check_and_orphan_rows(spark):
    raw = routes_df(spark, [route_row(airline_code=" aa ", flight_number="aa100 "), route_row(flight_number=None),
                            route_row(flight_number="AA200"), route_row(flight_number="AA200")])
    cur = curate(raw).unionByName(curate(routes_df(spark, [route_row(flight_number="ZZ9")])))
    r = Q.trace_check(cur, raw).first()
    # the NULL flight number row and the ZZ9 row are orphans
    assert (r["orphan_count"], r["result"]) == (2, "FAIL")
    assert Q.orphan_rows(cur, raw).count() == 2
    plan = Q.orphan_rows(cur, raw)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_fused_equals_separate(spark):
    rows = [route_row(), route_row(), route_row(distance_km=-1.0), route_row(origin_latitude=95.0),
            route_row(flight_number=None), route_row(flight_date=dt.date(2031, 1, 1))]
    raw = routes_df(spark, rows)
    cur = curate(raw)
    fused = {r["check_id"]: r for r in Q.run_checks(cur, raw).collect()}
    assert len(fused) == 9
    assert fused["CHK_NO_DUPLICATES"]["actual_count"] == _count(Q.duplicate_check(cur))
    assert fused["CHK_DISTANCE_VALID"]["actual_count"] == 1
    assert fused["CHK_COORDINATES_VALID"]["actual_count"] == 1
    assert fused["CHK_FLIGHT_DATE_SANE"]["actual_count"] == 1
    assert fused["CHK_CURATED_TRACES_TO_RAW"]["actual_count"] == 1
    assert fused["CHK_RAW_NOT_EMPTY"]["result"] == "PASS"
    assert fused["CHK_DISTANCE_VALID"]["expected_max"] == 0
    subset = Q.run_checks(cur, raw, reference_subset=True).collect()
    assert [r["check_id"] for r in subset] == ["CHK_RAW_NOT_EMPTY", "CHK_CLEAN_NOT_EMPTY", "CHK_NO_NULL_KEYS"]
    assert all(r["expected_min"] is None and r["expected_max"] is None for r in subset)


def test_fused_checks_scan_curated_once(spark, fresh):
    raw = routes_df(spark, [route_row()])
    curate(raw).write.parquet(fresh.curated)
    cur = spark.read.parquet(fresh.curated)
    counts = Q.curated_check_counts(cur, [c for c in Q.ALL_CHECKS if c not in (Q.RAW_NOT_EMPTY, Q.CURATED_TRACES_TO_RAW, Q.NO_DUPLICATES)])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Expand" not in plan and "hashpartitioning" not in plan  # counters shuffle one row per task


def test_audit_history_and_recent(spark, fresh):
    raw = routes_df(spark, [route_row()])
    cur = curate(raw)
    now = dt.datetime(2026, 12, 1, 12, 0, 0)
    Q.append_audit(Q.run_checks(cur, raw), fresh.audit, run_at=now - dt.timedelta(minutes=5))
    run = Q.append_audit(Q.run_checks(cur, raw, reference_subset=True), fresh.audit,
                         run_at=now - dt.timedelta(minutes=1))
    audit = Q.read_audit(spark, fresh.audit)
    assert audit.count() == 12
    # a retried write of the same run replaces it
    Q.append_audit(Q.run_checks(cur, raw, reference_subset=True), fresh.audit, run_at=now - dt.timedelta(minutes=1),
                   run_id=run)
    assert Q.read_audit(spark, fresh.audit).count() == 12
    recent = Q.recent_audit(Q.read_audit(spark, fresh.audit), as_of=now).collect()
    assert len(recent) == 3  # the run exactly 5 minutes old is excluded (strict)
    assert recent[0]["run_at"] == now - dt.timedelta(minutes=1)


def test_orphan_rows_shuffle_no_whole_row(spark):
    """Only keys meet before the few orphan keys are known; the rows of those, NULL keys and repeats included, come back whole."""
    from pyspark.sql import functions as F

    names = ["airline_code", "flight_number", "flight_date", "note"]
    curated = spark.createDataFrame([("A", "1", "d", "x"), ("A", "2", "d", "y"), ("A", "2", "d", "y"), ("A", None, "d", "z")], names)
    raw = spark.createDataFrame([(" a ", "1", "d"), (None, "2", "d")], names[:3])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.orphan_rows(curated, raw)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["note"] for r in out.collect()) == ["y", "y", "z"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in plan.split("\n"))
    assert Q.orphan_rows(curated.where("note = 'x'"), raw).count() == 0
    assert Q.orphan_rows(curated, raw.where(F.lit(False))).count() == 4
