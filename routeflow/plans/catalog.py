"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver's tables in ``sf_dir`` (through the fixture adapter) or layer tables
Spark built from them, over the whole data. Queries with side effects (loads, inserts, streams,
enrichment and audit writes) write into a fresh folder under the shared root on every call, so
repeated calls measure the full work and never see each other's output. Wall-clock columns
(``load_timestamp``, ``enriched_at``, ``run_at``) are left out of results.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeflow import fixed_values as FV
from routeflow.operators import enrich as E
from routeflow.operators import quality as Q
from routeflow.operators import states as S
from routeflow.operators import trace as TR
from routeflow.operators import views as V
from routeflow.operators.curate import curate
from routeflow.plans.layers import Layers, fixture_curated, fixture_landing, fixture_layers, fixture_raw, fixture_rows, land_files, load_raw_rows, new_layers
from routeflow.schemas import CURATED_COLUMNS, CURATED_SCHEMA, LOAD_TIMESTAMP, RAW_COLUMNS, RAW_SCHEMA, SOURCE_COLUMNS, SOURCE_FILE, full_width
from routeflow.sources.fixtures import age_files
from routeflow.sources.landing import (
    CSV_WRITE_OPTIONS,
    REJECTED_RECORD,
    REJECT_REASON,
    classify_landing,
    load_history,
    load_landing,
    read_landing,
    read_rejects,
    rejected_rows,
)
from routeflow.plans import stored
from routeflow.plans.pipeline import declare_layers
from routeflow.sources import catalog_tables
from routeflow.sources.tables import conform, insert_rows, new_load_id, read_curated, read_raw, stage_slice, write_layer
from routeflow.streaming.incremental import create_change_stream, has_data, run_curation, run_ingest, stream_tag

QueryFn = Callable[[SparkSession, str], DataFrame]

CURATED_OUT = [c for c in CURATED_COLUMNS if c != LOAD_TIMESTAMP]
RAW_OUT = [c for c in RAW_COLUMNS if c != LOAD_TIMESTAMP]


def _raw_first_half(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("codeshare") == 1)


def _raw_second_half(rows: DataFrame) -> DataFrame:
    return rows.where(~(F.col("codeshare") == 1) | F.col("codeshare").isNull())


def _land_text(spark: SparkSession, sf_dir: str, layers: Layers, part: int | None = None, line_breaks: bool = False) -> None:
    """Let the stored landing files of the fixture (one part or both) arrive in the landing folder."""
    source = fixture_landing(spark, sf_dir, line_breaks)
    for k in (part,) if part else (1, 2):
        land_files(spark, source, layers, k)


# --- sources / sinks --------------------------------------------------------------------------


def q_csv_roundtrip_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "csv-load")
    _land_text(spark, sf_dir, layers)
    load_landing(spark, layers.landing, layers.raw, new_load_id("copy"))
    return read_raw(spark, layers.raw).select(*SOURCE_COLUMNS)


def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "csv-rejects")
    _land_text(spark, sf_dir, layers)
    rejects = rejected_rows(classify_landing(read_landing(spark, layers.landing)))
    return rejects.groupBy(REJECT_REASON).agg(F.count(F.lit(1)).alias("rejected_rows"))


def q_csv_rejected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every rejected row, as the load keeps it."""
    layers = new_layers(spark, "csv-rejected-text")
    _land_text(spark, sf_dir, layers)
    load_landing(spark, layers.landing, layers.raw, new_load_id("copy"))
    stored = read_rejects(spark, layers.raw)
    return stored.select(*[F.get_json_object(REJECTED_RECORD, f"$.{c}").alias(c) for c in ("flight_number", "seats", "flight_date")])


def q_csv_load_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows by whether they carry their landing file's name and a load time of this load."""
    layers = new_layers(spark, "csv-defaults")
    _land_text(spark, sf_dir, layers)
    start = _dt.datetime.now(_dt.timezone.utc)
    load_landing(spark, layers.landing, layers.raw, new_load_id("copy"))
    end = _dt.datetime.now(_dt.timezone.utc)
    named = F.coalesce(F.col(SOURCE_FILE).rlike(r"^part-.*\.csv(\.gz)?$"), F.lit(False))
    stamped = F.coalesce(F.col(LOAD_TIMESTAMP).between(F.lit(start), F.lit(end)), F.lit(False))
    rows = read_raw(spark, layers.raw)
    return rows.groupBy(named.alias("has_file_name"), stamped.alias("stamped_by_load")).agg(F.count(F.lit(1)).alias("loaded_rows"))


def q_csv_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder is loaded under three ids while files arrive: every file is loaded once, whatever load took it."""
    layers = new_layers(spark, "csv-history")
    for part in (1, 2):
        _land_text(spark, sf_dir, layers, part=part)
        load_landing(spark, layers.landing, layers.raw, f"copy-{part}")
    load_landing(spark, layers.landing, layers.raw, "copy-3")
    files = load_history(spark, layers.raw).groupBy("load_id", F.element_at(F.split("path", "/"), -1).alias(SOURCE_FILE)).count()
    by_load = read_raw(spark, layers.raw).join(files, SOURCE_FILE).where(F.col("count") == 1)
    return by_load.groupBy("load_id", "codeshare").agg(F.count(F.lit(1)).alias("loaded_rows"))


def q_csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files hold records over three lines; those are read whole, the others line by line."""
    layers = new_layers(spark, "csv-breaks")
    for part in (1, 2):
        _land_text(spark, sf_dir, layers, part=part, line_breaks=True)
    load_landing(spark, layers.landing, layers.raw, new_load_id("copy"))
    return read_raw(spark, layers.raw).select(*SOURCE_COLUMNS)


#: Digits put behind every whole number of seats, so that it takes more than 64 bits.
WIDE_DIGITS = "00000000000000000007"


def q_csv_wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers beyond 64 bits load into a raw table of full width; the other rows round and fail as ever."""
    layers, source = new_layers(spark, "csv-wide"), fixture_landing(spark, sf_dir)
    text = read_landing(spark, [f"{source.landing}/{k}" for k in (1, 2)], source_file=None)
    wide = F.when(F.col("seats").rlike("^[0-9]+$"), F.concat("seats", F.lit(WIDE_DIGITS))).otherwise(F.col("seats"))
    text.withColumn("seats", wide).write.options(**CSV_WRITE_OPTIONS).csv(layers.landing)
    schema = full_width(RAW_SCHEMA)
    load_landing(spark, layers.landing, layers.raw, new_load_id("copy"), schema=schema)
    rows = read_raw(spark, layers.raw, schema)
    return rows.select("flight_number", F.col("stops").cast("long").alias("stops"), F.col("seats").cast("string").alias("seats_text"))


def q_manual_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "manual-insert")
    load_raw_rows(fixture_rows(spark, sf_dir), layers)
    insert_rows(spark, layers.raw, [FV.SMOKE_ROW], RAW_SCHEMA, source_file=FV.SMOKE_SOURCE_FILE)
    return read_raw(spark, layers.raw).select(*RAW_OUT)


# --- curation and streaming -------------------------------------------------------------------


def q_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(fixture_raw(spark, sf_dir))


def q_curate_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows that carry their action: only inserts are curated."""
    action = F.when(F.col("stops") > 0, F.lit("INSERT")).otherwise(F.lit("DELETE"))
    return curate(fixture_raw(spark, sf_dir).withColumn("action", action), action_col="action")


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "stream-ingest")
    ckpt = layers.checkpoint("ingest")
    _land_text(spark, sf_dir, layers, part=1)
    run_ingest(spark, layers.landing, layers.raw, ckpt)
    _land_text(spark, sf_dir, layers, part=2)
    run_ingest(spark, layers.landing, layers.raw, ckpt)
    return read_raw(spark, layers.raw).select(*SOURCE_COLUMNS)


def q_stream_curate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "stream-curate-all")
    ckpt = layers.checkpoint("curate")
    rows = fixture_rows(spark, sf_dir)
    load_raw_rows(_raw_first_half(rows), layers)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    load_raw_rows(_raw_second_half(rows), layers)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_stream_curate_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "stream-curate-new")
    ckpt = layers.checkpoint("curate")
    rows = fixture_rows(spark, sf_dir)
    load_raw_rows(_raw_first_half(rows), layers)
    create_change_stream(spark, layers.raw, ckpt)
    load_raw_rows(_raw_second_half(rows), layers)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_no_new_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = new_layers(spark, "stream-no-new-data")
    ckpt = layers.checkpoint("curate")
    load_raw_rows(fixture_rows(spark, sf_dir), layers)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_ingest_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half lands as files dated long before the first, which was ingested already."""
    layers = new_layers(spark, "stream-late-file")
    ckpt = layers.checkpoint("ingest")
    _land_text(spark, sf_dir, layers, part=1)
    run_ingest(spark, layers.landing, layers.raw, ckpt)
    _land_text(spark, sf_dir, layers, part=2)
    age_files(spark, layers.landing, days=30)
    run_ingest(spark, layers.landing, layers.raw, ckpt)
    return read_raw(spark, layers.raw).select(*SOURCE_COLUMNS)


def q_curate_after_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw slice is delivered again after it was curated, as after a crash before the stream's commit."""
    layers = new_layers(spark, "stream-replay")
    ckpt = layers.checkpoint("curate")
    rows = fixture_rows(spark, sf_dir)
    write_layer(rows, layers.raw, "ingest-replayed", RAW_SCHEMA)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    write_layer(rows, layers.raw, "ingest-replayed", RAW_SCHEMA)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_curate_after_torn_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load and a curation batch each die between writing their slice and committing it, and are run again."""
    layers = new_layers(spark, "stream-torn")
    ckpt = layers.checkpoint("curate")
    rows = fixture_rows(spark, sf_dir)
    stage_slice({"rows": conform(rows, RAW_SCHEMA)}, layers.raw, "ingest-torn")
    run_curation(spark, layers.raw, layers.curated, ckpt)  # must not see it
    write_layer(rows, layers.raw, "ingest-torn", RAW_SCHEMA)
    stage_slice({"rows": conform(curate(read_raw(spark, layers.raw)), CURATED_SCHEMA)}, layers.curated, f"curate-{stream_tag(ckpt)}-{0:010d}")
    run_curation(spark, layers.raw, layers.curated, ckpt)
    write_layer(rows, layers.raw, "ingest-torn", RAW_SCHEMA)
    run_curation(spark, layers.raw, layers.curated, ckpt)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_stream_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four committed slices, taken one per micro-batch by ledger position."""
    layers = new_layers(spark, "stream-ledger")
    rows = fixture_rows(spark, sf_dir)
    for k in range(4):
        load_raw_rows(rows.where(F.col("stops") % 4 == k), layers)
    run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"), max_slices_per_trigger=1)
    return read_curated(spark, layers.curated).select(*CURATED_OUT)


def q_has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the conditional task would run, and the curated rows so far: declared, after a load, after a run, after another load."""
    layers = new_layers(spark, "stream-has-data")
    ckpt = layers.checkpoint("curate")
    declare_layers(spark, layers)
    rows, seen = fixture_rows(spark, sf_dir), []

    def look(step: str) -> None:
        seen.append((step, has_data(spark, layers.raw, ckpt), read_curated(spark, layers.curated).count()))

    look("1 declared")
    load_raw_rows(_raw_first_half(rows), layers)
    look("2 loaded")
    run_curation(spark, layers.raw, layers.curated, ckpt)
    look("3 curated")
    load_raw_rows(_raw_second_half(rows), layers)
    look("4 loaded again")
    run_curation(spark, layers.raw, layers.curated, ckpt)
    look("5 curated again")
    return spark.createDataFrame(seen, "step string, has_data boolean, curated_rows long")


def q_clean_not_empty_on_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on a declared curated table whose source rows all fail the required filter."""
    layers = new_layers(spark, "declared-only")
    declare_layers(spark, layers)
    load_raw_rows(fixture_raw(spark, sf_dir).where(~(F.coalesce(F.length("airline_code"), F.lit(0)) > 0)), layers)
    run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"))
    return Q.row_count_check(read_curated(spark, layers.curated), Q.CLEAN_NOT_EMPTY)


# --- views ------------------------------------------------------------------------------------


def q_route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.route_summary(fixture_curated(spark, sf_dir))


def q_airline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.airline_stats(fixture_curated(spark, sf_dir))


def q_busiest_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.busiest_airports(fixture_curated(spark, sf_dir), mode="union")


def q_busiest_airports_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.busiest_airports(fixture_curated(spark, sf_dir), mode="explode")


def q_views_through_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published views answer SQL."""
    V.publish_all(fixture_curated(spark, sf_dir))
    return spark.sql("SELECT route_key, is_international, flight_count FROM v_route_summary WHERE flight_count > 1")


def _with_states(spark: SparkSession, sf_dir: str) -> Layers:
    """Two loads, curated and read into states one after the other."""
    layers, rows = new_layers(spark, "states"), fixture_rows(spark, sf_dir)
    for part in (_raw_first_half(rows), _raw_second_half(rows)):
        load_raw_rows(part, layers)
        run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"))
        S.update_all(spark, layers)
    return layers


def q_route_summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.route_summary(spark, _with_states(spark, sf_dir))


def q_airline_stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.airline_stats(spark, _with_states(spark, sf_dir))


def q_busiest_airports_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.busiest_airports(spark, _with_states(spark, sf_dir))


def q_checks_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.run_checks(spark, _with_states(spark, sf_dir))


def q_airline_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline view in its order, with the place of each row."""
    stats = V.airline_stats(fixture_curated(spark, sf_dir), ordered=False).select("airline_code", "airline_name", "total_flights")
    return V.with_rank(stats, [F.desc("total_flights"), F.asc_nulls_first("airline_code"), F.asc_nulls_first("airline_name")])


def q_airport_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport view in its order, with the place of each row."""
    busiest = V.busiest_airports(fixture_curated(spark, sf_dir), ordered=False)
    return V.with_rank(busiest, [F.desc("total_appearances"), *(F.asc_nulls_first(c) for c in ("airport_code", "city", "country"))])


# --- enrichment and dashboard -----------------------------------------------------------------


def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = fixture_curated(spark, sf_dir)
    return cur.select(
        *E.ENRICH_BASE_COLUMNS, E.classify_prompt().alias("classify_prompt"), E.summary_prompt().alias("summary_prompt")
    )


def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.classify(E.sample(fixture_curated(spark, sf_dir), None))


#: The batched classification labels routes by these countries.
COUNTRY_LABELS = ("UNITED_STATES", "UNITED_KINGDOM", "SAUDI_ARABIA", "CHINA")


def _country_provider(memo: str | None = None) -> E.BatchProvider:
    return E.BatchProvider(E.keyword_scorer(COUNTRY_LABELS), memo=memo, name="countries")


def q_classify_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.classify(E.sample(fixture_curated(spark, sf_dir), None), provider=_country_provider(), labels=COUNTRY_LABELS)


def q_classify_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished flights are labelled first, then all: the second run scores only prompts it has not seen."""
    memo = f"{new_layers(spark, 'memo').root}/ai/answers"
    rows = fixture_curated(spark, sf_dir)
    E.classify(E.sample(_raw_first_half(rows), None), provider=_country_provider(memo), labels=COUNTRY_LABELS)
    return E.classify(E.sample(rows, None), provider=_country_provider(memo), labels=COUNTRY_LABELS)


def q_memo_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts the provider is called for by each of three runs; the last sees no new one."""
    memo = f"{new_layers(spark, 'memo-calls').root}/ai/answers"
    provider, rows, calls = _country_provider(memo), fixture_curated(spark, sf_dir), []
    for run, part in enumerate((_raw_first_half(rows), rows, rows), start=1):
        prompts = part.select(E.classify_prompt().alias("prompt")).where("prompt IS NOT NULL").distinct()
        calls.append((run, E.score_unseen(prompts.select(provider.digest(F.col("prompt")).alias("digest"), "prompt"), provider)))
    return spark.createDataFrame(calls, "run int, prompts_scored long")


def q_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.complete(E.sample(fixture_curated(spark, sf_dir), None))


def q_complete_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = E.BatchProvider(E.fact_lister(), model="names")
    return E.complete(E.sample(fixture_curated(spark, sf_dir), None), provider=provider)


def _build_enriched(spark: SparkSession, sf_dir: str, limit: int | None) -> tuple[Layers, DataFrame]:
    layers = new_layers(spark, "enriched")
    E.write_enriched(E.enrich(fixture_curated(spark, sf_dir), limit=limit), layers.enriched)
    return layers, spark.read.parquet(layers.enriched)


def q_enriched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, enriched = _build_enriched(spark, sf_dir, FV.ENRICH_SAMPLE_ROWS)
    return enriched.drop("enriched_at")


def q_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, enriched = _build_enriched(spark, sf_dir, FV.ENRICH_SAMPLE_ROWS)
    out = V.dashboard(fixture_curated(spark, sf_dir), enriched)
    return out.drop("enriched_at")


def q_dashboard_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, enriched = _build_enriched(spark, sf_dir, None)
    out = V.dashboard(fixture_curated(spark, sf_dir), enriched, dedupe="latest")
    return out.drop("enriched_at")


def q_dashboard_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row was enriched twice, a day apart, with other labels: the later ones show. Hot keys are split."""
    rows = fixture_curated(spark, sf_dir)
    early = E.enrich(rows, classifier=E.KeywordClassifier(E.classify_prompt(), FV.ROUTE_LABELS)).withColumn("enriched_at", F.lit("2026-01-01").cast("timestamp"))
    late = E.enrich(rows).withColumn("enriched_at", F.lit("2026-01-02").cast("timestamp"))
    early = early.withColumn("route_classification", F.lit("ZZ_EARLY")).withColumn("route_summary", F.lit("zz early"))
    return V.dashboard(rows, early.unionByName(late), dedupe="latest", split_hot_keys=True)


def q_audit_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two audit runs at different times, newest first, with the place of each row."""
    cur, raw = _cur_raw(spark, sf_dir)
    layers = new_layers(spark, "audit-rank")
    as_of = _dt.datetime(2026, 1, 1, 12, 0)
    Q.append_audit(Q.run_checks(cur, raw, reference_subset=True), layers.audit, run_at=as_of)
    Q.append_audit(Q.run_checks(cur, raw, reference_subset=True), layers.audit, run_at=as_of - _dt.timedelta(minutes=3))
    recent = Q.recent_audit(Q.read_audit(spark, layers.audit), as_of=as_of + _dt.timedelta(minutes=1))
    return V.with_rank(recent, [F.desc("run_at"), F.asc("check_id")]).select("rank", "check_id", "actual_count", F.date_format("run_at", "HH:mm").alias("run_minute"))


# --- quality ----------------------------------------------------------------------------------


def _cur_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixture_curated(spark, sf_dir), fixture_raw(spark, sf_dir)


def q_raw_not_empty(spark, sf_dir):
    return Q.row_count_check(fixture_raw(spark, sf_dir), Q.RAW_NOT_EMPTY)


def q_clean_not_empty(spark, sf_dir):
    return Q.row_count_check(fixture_curated(spark, sf_dir), Q.CLEAN_NOT_EMPTY)


def q_no_null_keys(spark, sf_dir):
    return Q.predicate_check(fixture_curated(spark, sf_dir), Q.NO_NULL_KEYS, Q.null_key_rows())


def q_no_duplicates(spark, sf_dir):
    return Q.duplicate_check(fixture_curated(spark, sf_dir))


def q_distance_valid(spark, sf_dir):
    return Q.predicate_check(fixture_curated(spark, sf_dir), Q.DISTANCE_VALID, Q.bad_distance())


def q_flight_date_sane(spark, sf_dir):
    return Q.predicate_check(fixture_curated(spark, sf_dir), Q.FLIGHT_DATE_SANE, Q.bad_flight_date())


def q_coordinates_valid(spark, sf_dir):
    return Q.predicate_check(fixture_curated(spark, sf_dir), Q.COORDINATES_VALID, Q.bad_coordinates())


def q_curated_traces_to_raw(spark, sf_dir):
    cur, raw = _cur_raw(spark, sf_dir)
    return Q.trace_check(cur, raw)


def q_international_logic(spark, sf_dir):
    return Q.predicate_check(fixture_curated(spark, sf_dir), Q.INTERNATIONAL_LOGIC, Q.flag_mismatch())


def q_orphan_rows(spark, sf_dir):
    cur, raw = _cur_raw(spark, sf_dir)
    return Q.orphan_rows(cur, raw).select(*CURATED_OUT)


def q_all_checks_fused(spark, sf_dir):
    cur, raw = _cur_raw(spark, sf_dir)
    return Q.run_checks(cur, raw)


def q_audit_append(spark, sf_dir):
    cur, raw = _cur_raw(spark, sf_dir)
    layers = new_layers(spark, "audit")
    Q.append_audit(Q.run_checks(cur, raw), layers.audit)
    return Q.read_audit(spark, layers.audit).drop("run_at")


def q_recent_audit(spark, sf_dir):
    cur, raw = _cur_raw(spark, sf_dir)
    layers = new_layers(spark, "audit-recent")
    as_of = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    Q.append_audit(Q.run_checks(cur, raw), layers.audit, run_at=as_of - _dt.timedelta(minutes=10))
    Q.append_audit(Q.run_checks(cur, raw, reference_subset=True), layers.audit, run_at=as_of)
    recent = Q.recent_audit(Q.read_audit(spark, layers.audit), as_of=as_of)
    return recent.drop("run_at")


def _stored(spark: SparkSession, layers: Layers) -> catalog_tables.Names:
    """The instance's names, declared, forgotten and brought back from their kept definitions."""
    database = f"routes_{layers.root.rsplit('-', 1)[-1]}"
    names = stored.declare(spark, layers, database)
    catalog_tables.detach(spark, names)
    catalog_tables.attach(spark, names)
    return names


def q_sql_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``INSERT (columns)`` through SQL: what is left out takes the column defaults, and the rows reach raw and curated once."""
    layers = new_layers(spark, "sql-insert")
    names = _stored(spark, layers)
    fixture_rows(spark, sf_dir).createOrReplaceTempView("_new_routes")
    cols = ", ".join(SOURCE_COLUMNS)
    spark.sql(f"INSERT INTO {names.of(stored.INBOX)} ({cols}) SELECT {cols} FROM _new_routes")
    for _ in range(2):  # the second time finds nothing new
        stored.take_inbox(spark, layers, names)
        run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"))
    stored.refresh(spark, layers, names)
    out = [c for c in CURATED_OUT if c != SOURCE_FILE]
    filled = f"{SOURCE_FILE} = 'sql_insert' AND {LOAD_TIMESTAMP} IS NOT NULL"
    return spark.sql(f"SELECT {', '.join(out)}, {filled} AS defaults_filled FROM {names.of(stored.CURATED)}")


def _stored_fixture(spark: SparkSession, sf_dir: str) -> catalog_tables.Names:
    """Stored names over the fixture's layers and a sample of enriched rows."""
    layers = fixture_layers(spark, sf_dir)
    E.write_enriched(E.enrich(read_curated(spark, layers.curated), limit=FV.ENRICH_SAMPLE_ROWS), layers.enriched)
    return _stored(spark, layers)


def _stored_view(view: str, without: tuple[str, ...] = ()) -> QueryFn:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(_stored_fixture(spark, sf_dir).of(view)).drop(*without)

    return read


def _trace_names(spark: SparkSession, sf_dir: str) -> catalog_tables.Names:
    """Key tables over the fixture's layers."""
    layers = fixture_layers(spark, sf_dir)
    base = new_layers(spark, "trace")
    names = catalog_tables.Names(f"trace_{base.root.rsplit('-', 1)[-1]}", base.root)
    buckets = TR.buckets_for(spark, layers.raw, layers.curated)
    TR.declare_keys(spark, names, buckets=buckets)
    TR.update_keys(spark, names, layers.raw, layers.curated, buckets=buckets)
    return names


def q_trace_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.trace_check(spark, _trace_names(spark, sf_dir))


def q_orphans_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.orphan_rows(spark, _trace_names(spark, sf_dir), fixture_curated(spark, sf_dir)).select(*CURATED_OUT)


QUERIES: dict[str, QueryFn] = {
    "s_csv_roundtrip_load": q_csv_roundtrip_load,
    "s_csv_rejects": q_csv_rejects,
    "s_csv_rejected_text": q_csv_rejected_text,
    "s_csv_load_defaults": q_csv_load_defaults,
    "s_csv_load_history": q_csv_load_history,
    "s_csv_quoted_breaks": q_csv_quoted_breaks,
    "s_csv_wide_numbers": q_csv_wide_numbers,
    "k_manual_insert": q_manual_insert,
    "k_views_through_sql": q_views_through_sql,
    "k_sql_insert_defaults": q_sql_insert,
    "k_stored_route_summary": _stored_view("v_route_summary"),
    "k_stored_airline_stats": _stored_view("v_airline_stats"),
    "k_stored_busiest_airports": _stored_view("v_busiest_airports"),
    "k_stored_dashboard": _stored_view("v_enriched_routes_dashboard", ("enriched_at",)),
    "p_curate": q_curate,
    "p_curate_inserts": q_curate_inserts,
    "t_stream_ingest": q_stream_ingest,
    "t_stream_curate_all": q_stream_curate_all,
    "t_stream_curate_new": q_stream_curate_new,
    "t_no_new_data": q_no_new_data,
    "t_ingest_late_file": q_ingest_late_file,
    "t_curate_after_replay": q_curate_after_replay,
    "t_curate_after_torn_commit": q_curate_after_torn_commit,
    "t_stream_by_ledger": q_stream_by_ledger,
    "t_has_data": q_has_data,
    "a_route_summary": q_route_summary,
    "a_airline_stats": q_airline_stats,
    "a_busiest_airports": q_busiest_airports,
    "a_busiest_airports_explode": q_busiest_airports_explode,
    "a_route_summary_incremental": q_route_summary_incremental,
    "a_airline_stats_incremental": q_airline_stats_incremental,
    "a_busiest_airports_incremental": q_busiest_airports_incremental,
    "o_airline_rank": q_airline_rank,
    "o_airport_rank": q_airport_rank,
    "o_audit_rank": q_audit_rank,
    "e_prompts": q_prompts,
    "e_classify": q_classify,
    "e_classify_batched": q_classify_batched,
    "e_classify_memo": q_classify_memo,
    "e_memo_calls": q_memo_calls,
    "e_complete": q_complete,
    "e_complete_batched": q_complete_batched,
    "e_enriched_table": q_enriched_table,
    "j_dashboard": q_dashboard,
    "j_dashboard_latest": q_dashboard_latest,
    "j_dashboard_newest": q_dashboard_newest,
    "q_checks_incremental": q_checks_incremental,
    "q_raw_not_empty": q_raw_not_empty,
    "q_clean_not_empty": q_clean_not_empty,
    "q_clean_not_empty_on_empty": q_clean_not_empty_on_empty,
    "q_no_null_keys": q_no_null_keys,
    "q_no_duplicates": q_no_duplicates,
    "q_distance_valid": q_distance_valid,
    "q_flight_date_sane": q_flight_date_sane,
    "q_coordinates_valid": q_coordinates_valid,
    "q_curated_traces_to_raw": q_curated_traces_to_raw,
    "q_international_logic": q_international_logic,
    "q_orphan_rows": q_orphan_rows,
    "q_trace_colocated": q_trace_colocated,
    "q_orphans_colocated": q_orphans_colocated,
    "q_all_checks_fused": q_all_checks_fused,
    "q_audit_append": q_audit_append,
    "q_recent_audit": q_recent_audit,
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice end to end: driver tables -> raw -> curated -> route summary."""
    return q_route_summary(spark, sf_dir)

