from conftest import route_row, routes_df

from routeflow.operators.curate import curate
from routeflow.plans.layers import load_raw_rows
from routeflow.schemas import CURATED_COLUMNS, LOAD_TIMESTAMP, SOURCE_COLUMNS
from routeflow.sources.tables import read_curated, read_raw
from routeflow.streaming.incremental import create_change_stream, run_curation, run_ingest

OUT = [c for c in CURATED_COLUMNS if c != LOAD_TIMESTAMP]


def _batch(spark, tag, n):
    return routes_df(spark, [route_row(flight_number=f"{tag}{i}") for i in range(n)])


def test_curation_all_restart_and_no_new_data(spark, fresh):
    ckpt = fresh.checkpoint("curate")
    a, b = _batch(spark, "A", 5), _batch(spark, "B", 4)
    load_raw_rows(a, fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    assert read_curated(spark, fresh.curated).count() == 5
    load_raw_rows(b, fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)  # restart on the same checkpoint
    got = read_curated(spark, fresh.curated).select(*OUT)
    want = curate(a.unionByName(b)).select(*OUT)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    q = run_curation(spark, fresh.raw, fresh.curated, ckpt)  # nothing new: no batch, nothing added
    assert read_curated(spark, fresh.curated).count() == 9
    assert all(p["numInputRows"] == 0 for p in q.recentProgress) or not q.recentProgress


def test_curation_new_only_after_creation(spark, fresh):
    ckpt = fresh.checkpoint("curate")
    load_raw_rows(_batch(spark, "OLD", 6), fresh)
    create_change_stream(spark, fresh.raw, ckpt)
    b = _batch(spark, "NEW", 3)
    load_raw_rows(b, fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    got = read_curated(spark, fresh.curated)
    assert sorted(r["flight_number"] for r in got.collect()) == ["NEW0", "NEW1", "NEW2"]


def test_ingest_never_reloads_a_file(spark, fresh):
    import os

    from routeflow.sources.landing import CSV_WRITE_OPTIONS

    ckpt = fresh.checkpoint("ingest")
    text = _batch(spark, "C", 4).selectExpr(*[f"cast({c} as string) as {c}" for c in SOURCE_COLUMNS])
    text.write.mode("append").options(**CSV_WRITE_OPTIONS).csv(fresh.landing)
    run_ingest(spark, fresh.landing, fresh.raw, ckpt)
    run_ingest(spark, fresh.landing, fresh.raw, ckpt)
    assert read_raw(spark, fresh.raw).count() == 4
    text.write.mode("append").options(**CSV_WRITE_OPTIONS).csv(fresh.landing)
    run_ingest(spark, fresh.landing, fresh.raw, ckpt)
    raw = read_raw(spark, fresh.raw)
    assert raw.count() == 8
    assert raw.where("source_file like 'part-%'").count() == 8
    assert os.path.basename(fresh.raw) == "routes"


def test_processing_time_trigger_keeps_running(spark, fresh):
    ckpt = fresh.checkpoint("curate-timer")
    load_raw_rows(_batch(spark, "T", 3), fresh)
    q = run_curation(spark, fresh.raw, fresh.curated, ckpt, trigger="1 second", name="curate_timer_test")
    try:
        assert q.isActive
        q.processAllAvailable()
        load_raw_rows(_batch(spark, "U", 2), fresh)
        q.processAllAvailable()
        assert read_curated(spark, fresh.curated).count() == 5
        assert "curate_timer_test" in [s.name for s in spark.streams.active]
    finally:
        q.stop()


def test_replayed_slice_is_not_rewritten(spark, fresh):
    from routeflow.schemas import RAW_SCHEMA
    from routeflow.sources.tables import write_layer

    for _ in range(2):
        write_layer(_batch(spark, "R", 5), fresh.raw, "ingest-x", RAW_SCHEMA)
        run_curation(spark, fresh.raw, fresh.curated, fresh.checkpoint("curate"))
    assert read_raw(spark, fresh.raw).count() == read_curated(spark, fresh.curated).count() == 5
