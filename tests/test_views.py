import datetime as dt

from conftest import route_row, routes_df
from pyspark.sql import functions as F

from routeflow.operators import views as V
from routeflow.operators.curate import curate


def _curated(spark, rows):
    return curate(routes_df(spark, rows))


def test_route_summary_groups_by_category_too(spark):
    rows = [route_row(distance_km=1400.0), route_row(distance_km=1600.0, seats=100), route_row(distance_km=1700.0,
            airline_code="BA", flight_date=dt.date(2026, 5, 1))]
    out = {r["distance_category"]: r for r in V.route_summary(_curated(spark, rows)).collect()}
    assert set(out) == {"SHORT", "MEDIUM"}
    m = out["MEDIUM"]
    assert (m["flight_count"], m["airline_count"], m["total_seats"], m["avg_distance_km"]) == (2, 2, 320, 1650.0)
    assert (m["first_flight"], m["last_flight"]) == (dt.date(2026, 4, 21), dt.date(2026, 5, 1))


def test_airline_stats(spark):
    rows = [route_row(), route_row(destination_country="USA", destination_airport="LAX"), route_row(distance_km=None),
            route_row(airline_code="BA", airline_name="British")]
    out = V.airline_stats(_curated(spark, rows)).collect()
    assert [r["airline_code"] for r in out] == ["AA", "BA"]
    aa = out[0]
    assert (aa["total_flights"], aa["unique_routes"], aa["countries_served"]) == (3, 2, 1)
    assert (aa["international_flights"], aa["pct_international"], aa["avg_distance_km"]) == (2, 66.7, 5541.0)


def test_busiest_airports_union_equals_explode(spark):
    rows = [route_row(), route_row(destination_airport="JFK", destination_city="New York", destination_country="USA"),
            route_row(origin_airport="LHR", origin_city="London", origin_country="United Kingdom",
                      destination_airport="JFK", destination_city="New York", destination_country="USA")]
    cur = _curated(spark, rows)
    a = sorted(map(tuple, V.busiest_airports(cur, mode="union").collect()))
    b = sorted(map(tuple, V.busiest_airports(cur, mode="explode").collect()))
    assert a == b
    jfk = [r for r in a if r[0] == "JFK"][0]
    assert jfk[3] == 4  # the JFK-JFK row counts twice
    assert V.busiest_airports(cur, top_n=1).count() == 1


def test_explode_form_scans_once(spark, fresh):
    cur = _curated(spark, [route_row()])
    cur.write.parquet(fresh.curated)
    stored = spark.read.parquet(fresh.curated)
    plan_u = stored.transform(lambda d: V.busiest_airports(d, mode="union"))._jdf.queryExecution().executedPlan().toString()
    plan_e = stored.transform(lambda d: V.busiest_airports(d, mode="explode"))._jdf.queryExecution().executedPlan().toString()
    assert plan_u.count("FileScan parquet") == 2
    assert plan_e.count("FileScan parquet") == 1


def test_approx_distinct_close(spark):
    rows = [route_row(airline_code=f"A{i}") for i in range(50)]
    out = V.airline_stats(_curated(spark, rows), approx=True).agg(F.sum("unique_routes")).first()[0]
    assert out == 50


def _enriched(spark, rows):
    schema = "route_key string, flight_number string, route_classification string, route_summary string, enriched_at timestamp"
    return spark.createDataFrame(rows, schema)


def test_dashboard_fan_out_and_null_key(spark):
    cur = _curated(spark, [route_row(), route_row(), route_row(flight_number=None)])
    t = dt.datetime(2026, 1, 1)
    enr = _enriched(spark, [("JFK-LHR", "AA100", "X", "s1", t), ("JFK-LHR", "AA100", "Y", "s2", t + dt.timedelta(1)),
                            ("JFK-LHR", None, "Z", "s3", t)])
    plain = V.dashboard(cur, enr).collect()
    assert len(plain) == 5  # 2 x 2 fan-out + the NULL flight number row unmatched
    assert sum(r["route_classification"] is None for r in plain) == 1
    latest = V.dashboard(cur, enr, dedupe="latest").collect()
    assert len(latest) == 3
    assert sorted(r["route_classification"] or "-" for r in latest) == ["-", "Y", "Y"]


def test_dashboard_forces_no_broadcast(spark):
    cur = _curated(spark, [route_row()])
    enr = _enriched(spark, [("JFK-LHR", "AA100", "X", "s", dt.datetime(2026, 1, 1))])
    without = V.dashboard(cur, enr)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in without.lower()
