from conftest import route_row, routes_df

from routeflow.operators.curate import curate
from routeflow.schemas import CURATED_COLUMNS, LOAD_TIMESTAMP


def test_smoke_row(spark):
    out = curate(routes_df(spark, [route_row(source_file="manual_test_insert")])).first()
    assert out["route_key"] == "JFK-LHR"
    assert out["is_international"] is True
    assert out["distance_category"] == "LONG"
    assert out["source_file"] == "manual_test_insert"


def test_columns_in_declared_order(spark):
    cols = curate(routes_df(spark, [route_row()])).columns
    assert cols == [c for c in CURATED_COLUMNS if c != LOAD_TIMESTAMP]


def test_required_filter_and_standardise(spark):
    rows = [
        route_row(airline_code=" aa ", flight_number=" aa100", origin_airport="jfk ", aircraft_type="b77w"),
        route_row(airline_code=None),
        route_row(flight_date=None),
        route_row(origin_airport=None),
        route_row(destination_airport=None),
        route_row(flight_number=None),  # kept: not required
        route_row(airline_code="  "),  # kept: the test is on the untrimmed value
    ]
    out = curate(routes_df(spark, rows)).collect()
    assert len(out) == 3
    first = out[0]
    assert (first["airline_code"], first["flight_number"], first["origin_airport"], first["aircraft_type"]) == (
        "AA", "AA100", "JFK", "B77W")
    assert first["route_key"] == "JFK-LHR"
    assert out[1]["flight_number"] is None
    assert out[2]["airline_code"] == ""


def test_null_country_not_international_and_null_distance_long(spark):
    rows = [route_row(origin_country=None), route_row(destination_country=" USA ", origin_country="USA"),
            route_row(distance_km=None), route_row(distance_km=-1.0)]
    out = curate(routes_df(spark, rows)).collect()
    assert [r["is_international"] for r in out] == [False, False, True, True]
    assert [r["distance_category"] for r in out] == ["LONG", "LONG", "LONG", "SHORT"]


def test_action_filter(spark):
    from pyspark.sql import functions as F

    base = routes_df(spark, [route_row()])
    df = base.withColumn("action", F.lit("INSERT")).unionByName(base.withColumn("action", F.lit("DELETE")))
    assert curate(df, action_col="action").count() == 1
    assert curate(df).count() == 2
