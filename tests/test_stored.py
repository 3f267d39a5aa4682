"""Catalog tables with defaults, stored views, slices as partitions and the co-located trace."""

import subprocess
import sys
import textwrap

import pytest

from routeflow.operators import quality as Q
from routeflow.operators import trace as TR
from routeflow.operators import views as V
from routeflow.operators.enrich import enrich, write_enriched
from routeflow.plans import stored
from routeflow.plans.layers import load_raw_rows
from routeflow.schemas import CURATED_SCHEMA, RAW_SCHEMA, SOURCE_COLUMNS
from routeflow.sources import catalog_tables as K
from routeflow.sources.tables import insert_rows, read_curated, read_raw, reset_layer, stage_slice
from routeflow.streaming.incremental import run_curation
from tests.conftest import route_row, routes_df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def load(spark, layers, *found):
    load_raw_rows(routes_df(spark, [route_row(**r) for r in found]), layers)
    run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"))


def named(layers, prefix):
    return f"{prefix}_{layers.root.rsplit('-', 1)[-1]}"


def test_views_follow_loads_and_resets(spark, fresh):
    load(spark, fresh, {}, {"flight_number": "aa7 ", "distance_km": None}, {"airline_code": None})
    write_enriched(enrich(read_curated(spark, fresh.curated)), fresh.enriched)
    names = stored.declare(spark, fresh, named(fresh, "views"))
    load(spark, fresh, {"airline_code": "BB", "origin_city": "O'Hare\\x"})
    stage_slice({"rows": read_curated(spark, fresh.curated)}, fresh.curated, "torn")  # written, never committed
    stored.refresh(spark, fresh, names)
    curated = read_curated(spark, fresh.curated)
    assert curated.count() == 3
    assert rows(spark.table(names.of("v_route_summary"))) == rows(V.route_summary(curated))
    assert rows(spark.table(names.of("v_airline_stats"))) == rows(V.airline_stats(curated))
    assert rows(spark.table(names.of("v_busiest_airports"))) == rows(V.busiest_airports(curated))
    enriched = spark.read.parquet(fresh.enriched)
    assert rows(spark.table(names.of("v_enriched_routes_dashboard"))) == rows(V.dashboard(curated, enriched))
    reset_layer(spark, fresh.curated, CURATED_SCHEMA)
    stored.refresh(spark, fresh, names)
    assert spark.table(names.of("v_route_summary")).count() == 0


def test_insert_takes_defaults_and_reaches_raw_once(spark, fresh):
    names = stored.declare(spark, fresh, named(fresh, "insert"))
    t = names.of(stored.INBOX)
    spark.sql(f"INSERT INTO {t} (airline_code, seats) VALUES ('zz', 5), ('yy', NULL)")
    spark.sql(f"INSERT INTO {t} (airline_code, source_file) VALUES ('xx', 'mine'), ('ww', DEFAULT)")
    for _ in range(2):
        stored.take_inbox(spark, fresh, names)
    raw = read_raw(spark, fresh.raw)
    assert rows(raw.select("airline_code", "seats", "source_file")) == [
        ("ww", None, "sql_insert"), ("xx", None, "mine"), ("yy", None, "sql_insert"), ("zz", 5, "sql_insert"),
    ]
    assert raw.where("load_timestamp IS NULL").count() == 0
    assert rows(spark.table(names.of(stored.RAW)).select(*RAW_SCHEMA.names)) == rows(raw)
    spark.sql(f"INSERT INTO {t} (airline_code) VALUES ('vv')")
    stored.take_inbox(spark, fresh, names)
    assert read_raw(spark, fresh.raw).count() == 5


def test_definitions_are_kept_once_and_replaced(spark, fresh):
    names = stored.declare(spark, fresh, named(fresh, "defs"))
    before = K.definitions(spark, names)
    stored.declare(spark, fresh, names.database)
    assert K.definitions(spark, names) == before and len(before) == 8
    K.store_view(spark, names, "v_route_summary", "SELECT 1 AS one")
    K.detach(spark, names)
    assert not spark.catalog.tableExists(f"{names.database}.v_route_summary")
    K.attach(spark, names)
    assert rows(spark.table(names.of("v_route_summary"))) == [(1,)]
    with pytest.raises(ValueError):
        K.declare_table(spark, names, "t", RAW_SCHEMA, {"no_such_column": "1"})


def test_names_survive_the_session(spark, fresh):
    load(spark, fresh, {}, {})
    write_enriched(enrich(read_curated(spark, fresh.curated)), fresh.enriched)
    names = stored.declare(spark, fresh, named(fresh, "kept"))
    program = f"""
        from routeflow.session import build_session
        from routeflow.sources import catalog_tables as K
        spark = build_session()
        names = K.Names({names.database!r}, {names.root!r})
        K.attach(spark, names)
        spark.sql("INSERT INTO " + names.of("raw_routes_inbox") + " (airline_code) VALUES ('later')")
        print("FOUND", spark.table(names.of("v_route_summary")).head()["flight_count"])
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(program)], capture_output=True, text=True, timeout=120)
    assert "FOUND 2" in done.stdout, done.stderr[-2000:]
    stored.take_inbox(spark, fresh, names)
    assert rows(read_raw(spark, fresh.raw).where("airline_code = 'later'").select("source_file")) == [("sql_insert",)]


def key_tables(spark, layers):
    names = K.Names(named(layers, "trace"), f"{layers.root}/trace")
    TR.declare_keys(spark, names, buckets=4)
    return names


def test_colocated_trace_equals_the_full_one(spark, fresh):
    load(spark, fresh, {}, {}, {"flight_number": " aa7"}, {"flight_number": None})
    names = key_tables(spark, fresh)
    TR.update_keys(spark, names, fresh.raw, fresh.curated, buckets=4)
    load(spark, fresh, {"airline_code": "BB"}, {"airline_code": "BB"})
    reset_layer(spark, fresh.raw, RAW_SCHEMA)  # what was curated from the first loads traces to nothing now
    insert_rows(spark, fresh.raw, [tuple(route_row(airline_code="bb")[c] for c in SOURCE_COLUMNS)], source_file="t")
    for _ in range(2):
        TR.update_keys(spark, names, fresh.raw, fresh.curated, buckets=4)
    raw, curated = read_raw(spark, fresh.raw), read_curated(spark, fresh.curated)
    assert rows(TR.trace_check(spark, names)) == rows(Q.trace_check(curated, raw))
    assert TR.trace_check(spark, names).head()[2] == 4
    assert rows(TR.orphan_rows(spark, names, curated)) == rows(Q.orphan_rows(curated, raw))


def test_trace_moves_no_row(spark, fresh):
    load(spark, fresh, {}, {"airline_code": "BB"})
    names = key_tables(spark, fresh)
    TR.update_keys(spark, names, fresh.raw, fresh.curated, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = TR.orphan_keys(spark, names)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_buckets_grow_with_the_rows(spark, fresh):
    load(spark, fresh, {}, {"airline_code": "BB"}, {"airline_code": "CC"})
    assert TR.buckets_for(spark, fresh.raw, fresh.curated) == 8
    assert TR.buckets_for(spark, fresh.raw, fresh.curated, least=1, rows=2) == 3  # three rows in each table
    assert TR.buckets_for(spark, fresh.landing, fresh.audit) == 8  # nothing there


def test_empty_tables(spark, fresh):
    names = key_tables(spark, fresh)
    TR.update_keys(spark, names, fresh.raw, fresh.curated, buckets=4)
    assert TR.trace_check(spark, names).head()[2] == 0
    views = stored.declare(spark, fresh, named(fresh, "empty"))
    stored.take_inbox(spark, fresh, views)
    assert all(spark.table(views.of(v)).count() == 0 for v in V.VIEW_NAMES)
