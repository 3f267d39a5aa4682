import json

from conftest import route_row, routes_df
from test_enrich import rule_on_prompts

from routeflow import fixed_values as FV
from routeflow.operators import enrich as E
from routeflow.operators import views as V
from routeflow.operators.curate import curate
from routeflow.plans.layers import load_raw_rows
from routeflow.schemas import RAW_SCHEMA
from routeflow.sources.tables import insert_rows, read_raw, reset_layer


def test_insert_fills_defaults_and_reset_empties(spark, fresh):
    reset_layer(spark, fresh.raw, RAW_SCHEMA)
    assert read_raw(spark, fresh.raw).count() == 0
    load_raw_rows(routes_df(spark, [route_row(), route_row()]), fresh)
    insert_rows(spark, fresh.raw, [FV.SMOKE_ROW], RAW_SCHEMA, source_file=FV.SMOKE_SOURCE_FILE)
    raw = read_raw(spark, fresh.raw)
    assert raw.columns == RAW_SCHEMA.names
    assert raw.count() == 3
    assert raw.where("load_timestamp is null").count() == 0
    assert raw.where(f"source_file = '{FV.SMOKE_SOURCE_FILE}'").count() == 1
    reset_layer(spark, fresh.raw, RAW_SCHEMA)
    assert read_raw(spark, fresh.raw).count() == 0


def test_published_views_answer_sql(spark):
    cur = curate(routes_df(spark, [route_row(), route_row(airline_code="BA", flight_number="BA1")]))
    V.publish_all(cur, E.enrich(cur, limit=FV.ENRICH_SAMPLE_ROWS))
    top = spark.sql("SELECT airline_code, total_flights FROM v_airline_stats ORDER BY airline_code").collect()
    assert [(r[0], r[1]) for r in top] == [("AA", 1), ("BA", 1)]
    assert spark.sql("SELECT count(*) FROM v_enriched_routes_dashboard").first()[0] == 2
    assert spark.sql("SELECT total_appearances FROM v_busiest_airports WHERE airport_code = 'JFK'").first()[0] == 2


def test_provider_answering_json_objects(spark):
    cur = curate(routes_df(spark, [route_row(), route_row(destination_country="USA", distance_km=100.0)]))

    labels = rule_on_prompts()  # nested, so it travels by value

    def as_objects(prompts):
        return labels(prompts).map(lambda x: json.dumps({"label": x, "score": 0.9}))

    got = E.classify(cur, provider=E.BatchProvider(as_objects, field="label")).select("route_classification").collect()
    assert sorted(r[0] for r in got) == ["DOMESTIC_SHORT", "INTERNATIONAL_LONG_HAUL"]


def test_lines_move_while_they_hold_numbers(spark):
    """Where nothing is small enough to be broadcast unasked, lines are moved twice, without any name."""
    from routeflow.sources import fixtures as FX

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept, FX.SPREAD_ROWS = FX.SPREAD_ROWS, 0
    try:
        df = FX.routes_from_tables(spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        FX.SPREAD_ROWS = kept
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    order = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert sum("l_orderkey" in x or "l_partkey" in x for x in order) == 2
    assert not any("l_suppkey" in x or "s_suppkey" in x for x in order)
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_rows_for_loads_are_rendered_from_stored_lines(spark, monkeypatch):
    """Queries that only load rows write neither the fixture's raw nor its curated table; one that reads raw writes no curated one."""
    from routeflow.plans import layers as L
    from routeflow.sources import fixtures as FX

    monkeypatch.setattr(L, "_BUILT", {})
    sf = "/root/testdata/sf0.001"
    rows = L.fixture_rows(spark, sf)
    assert {key[0] for key in L._BUILT} == {"lines"}
    want = FX.routes_from_tables(spark, sf)
    assert rows.schema.simpleString() == want.schema.simpleString()
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    L.fixture_raw(spark, sf)
    assert {key[0] for key in L._BUILT} == {"lines", "raw"}


def test_slices_are_compressed_with_zstd(spark, fresh):
    import glob

    from routeflow.sources.tables import read_layer, write_layer

    df = spark.range(10).selectExpr("id", "concat('name ', id) AS name")
    write_layer(df, fresh.raw, "one")
    files = glob.glob(f"{fresh.raw.removeprefix('file:')}/data/*/rows/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert read_layer(spark, fresh.raw, df.schema).count() == 10
