"""Plan shape: what would still hold on a large cluster."""

from conftest import route_row, routes_df

from routeflow.operators import quality as Q
from routeflow.operators import views as V
from routeflow.operators.curate import curate


def _stored(spark, fresh, rows):
    curate(routes_df(spark, rows)).write.parquet(fresh.curated)
    return spark.read.parquet(fresh.curated)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_aggregate_map_side_before_shuffle(spark, fresh):
    # one carrier holds most rows: the hot key is pre-aggregated before the exchange
    cur = _stored(spark, fresh, [route_row()] * 30 + [route_row(airline_code="BA")])
    for df in (V.route_summary(cur), V.airline_stats(cur, ordered=False), V.busiest_airports(cur, ordered=False)):
        plan = _plan(df)
        assert "partial_count" in plan
        assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # partial sits below the exchange
    assert V.airline_stats(cur).first()["total_flights"] == 30


def test_curation_is_narrow(spark, fresh):
    raw_path = fresh.raw + "_plain"
    routes_df(spark, [route_row()]).write.parquet(raw_path)
    plan = _plan(curate(spark.read.parquet(raw_path)))
    assert "Exchange" not in plan
    assert "IsNotNull(airline_code)" in plan  # required-column filter pushed to the scan


def test_trace_check_pre_aggregates_both_sides(spark, fresh):
    cur = _stored(spark, fresh, [route_row()] * 5)
    raw = routes_df(spark, [route_row()] * 5)
    plan = _plan(Q.orphan_count(cur, raw))
    assert "Join" not in plan
    assert plan.count("partial_sum") >= 1 and "Union" in plan


def test_range_predicates_reach_the_scan(spark, fresh):
    cur = _stored(spark, fresh, [route_row()])
    plan = _plan(Q.predicate_check(cur, Q.DISTANCE_VALID, Q.bad_distance()))
    assert "PushedFilters: [Or(LessThanOrEqual(distance_km,0.0),GreaterThan(distance_km,20000.0))]" in plan
