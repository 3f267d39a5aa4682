from test_landing import GOOD, HEADER, _local, _write

from routeflow.plans.pipeline import run_once, start_continuous
from routeflow.sources.tables import read_curated


def test_run_once_end_to_end(spark, fresh):
    _write(_local(fresh.landing), "day1.csv", [HEADER, GOOD, GOOD.replace(",220,", ",bad,"),
                                               GOOD.replace("AA,American", ",American")])
    audit = {r["check_id"]: r for r in run_once(spark, fresh).collect()}
    assert len(audit) == 9
    assert audit["CHK_RAW_NOT_EMPTY"]["actual_count"] == 2  # one row rejected at load
    assert audit["CHK_CLEAN_NOT_EMPTY"]["actual_count"] == 1  # NULL airline code not curated
    assert spark.sql("SELECT count(*) FROM v_enriched_routes_dashboard").first()[0] == 1
    _write(_local(fresh.landing), "day2.csv", [HEADER, GOOD])
    audit = {r["check_id"]: r for r in run_once(spark, fresh).collect()}
    assert audit["CHK_CLEAN_NOT_EMPTY"]["actual_count"] == 2  # only the new file was processed
    assert audit["CHK_NO_DUPLICATES"]["result"] == "FAIL"


def test_continuous_mode(spark, fresh):
    _write(_local(fresh.landing), "a.csv", [HEADER, GOOD])
    queries = start_continuous(spark, fresh, interval="1 second")
    try:
        for q in queries:
            q.processAllAvailable()
        queries[1].processAllAvailable()
        assert read_curated(spark, fresh.curated).count() == 1
    finally:
        for q in queries:
            q.stop()


def test_empty_start_reports_instead_of_failing(spark, fresh):
    audit = {r["check_id"]: r["result"] for r in run_once(spark, fresh).collect()}
    assert len(audit) == 9 and audit["CHK_CLEAN_NOT_EMPTY"] == audit["CHK_RAW_NOT_EMPTY"] == "FAIL"
