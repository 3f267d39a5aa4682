"""The whole pipeline over one set of layer tables: one pass, or kept running on a cadence.

``run_once`` processes what is waiting end to end: new landing files -> raw (+ rejects), new raw rows ->
curated, the enriched table rebuilt from curated, reporting views published, checks run and logged.
``start_continuous`` keeps ingest and curation running on a processing-time trigger (default every
5 minutes; a tick with no new files starts no batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from routeflow import fixed_values as FV
from routeflow.operators import enrich as E
from routeflow.operators import quality as Q
from routeflow.operators import views as V
from routeflow.plans.layers import Layers
from routeflow.schemas import AUDIT_SCHEMA, CURATED_SCHEMA, RAW_SCHEMA
from routeflow.sources.tables import ensure_layer, make_folder, read_curated, read_layer, read_raw
from routeflow.streaming.incremental import create_change_stream, has_data, run_curation, run_ingest


def create_streams(spark: SparkSession, layers: Layers) -> None:
    """Start the raw change stream *now* (rows already in raw are not curated)."""
    create_change_stream(spark, layers.raw, layers.checkpoint("curate"))


def declare_layers(spark: SparkSession, layers: Layers) -> None:
    """Make the landing folder and the raw, curated and audit tables exist, empty until the first row."""
    make_folder(spark, layers.landing)
    for path, schema in ((layers.raw, RAW_SCHEMA), (layers.curated, CURATED_SCHEMA), (layers.audit, AUDIT_SCHEMA)):
        ensure_layer(spark, path, schema)


def run_once(
    spark: SparkSession,
    layers: Layers,
    *,
    enrich_rows: int | None = None,
    classifier: E.Provider | None = None,
    summarizer: E.Provider | None = None,
    reference_audit: bool = False,
    dashboard: str | None = "latest",
) -> DataFrame:
    """One end-to-end pass; returns the audit rows of this run.

    ``enrich_rows`` limits the enriched table (all rows by default). ``dashboard="latest"`` joins the newest enriched row per key, None every one.
    """
    declare_layers(spark, layers)
    run_ingest(spark, layers.landing, layers.raw, layers.checkpoint("ingest"))
    if has_data(spark, layers.raw, layers.checkpoint("curate")):  # else the task is skipped
        run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"))
    curated, raw = read_curated(spark, layers.curated), read_raw(spark, layers.raw)
    E.write_enriched(
        E.enrich(curated, limit=enrich_rows, classifier=classifier, summarizer=summarizer), layers.enriched
    )
    V.publish_all(curated, spark.read.parquet(layers.enriched), dedupe=dashboard)
    run_id = Q.append_audit(Q.run_checks(curated, raw, reference_subset=reference_audit), layers.audit)
    audit = read_layer(spark, layers.audit, AUDIT_SCHEMA, with_load_id=True)
    mine = audit.where(audit.load_id == run_id)  # by run, however long the checks took
    return mine.select("check_id", "check_name", "layer", "result", "actual_count", "run_at").orderBy("check_id")


def start_continuous(
    spark: SparkSession, layers: Layers, interval: str = FV.INCREMENTAL_INTERVAL, max_files_per_trigger: int | None = None
) -> list[StreamingQuery]:
    """Keep ingest and curation running every ``interval``; returns the two running queries."""
    declare_layers(spark, layers)
    return [
        run_ingest(spark, layers.landing, layers.raw, layers.checkpoint("ingest"),
                   trigger=interval, max_files_per_trigger=max_files_per_trigger, name="routeflow_ingest"),
        run_curation(spark, layers.raw, layers.curated, layers.checkpoint("curate"),
                     trigger=interval, name="routeflow_curate"),
    ]
