"""Incremental ingest (landing CSV -> raw) and curation (raw -> curated) with Structured Streaming.

* The change stream of the raw table is its ledger (``sources/ledger_stream.py``): the checkpoint holds a ledger position, a
  micro-batch gets the slices committed after it and reads them with a Parquet scan. Uncommitted slices do not exist for it.
* The ingest stream delivers the names of new landing files; the batch loads them like a bulk load, history included.
* ``create_change_stream`` moves a checkpoint to the end of the raw ledger without reading any slice: later runs on that checkpoint see
  only slices committed after it.
* Every micro-batch commits one slice whose id is made of the stream and the batch number. Whatever step a run dies at, the replayed batch
  either finds its id committed and adds nothing, or commits its rows for the first time.
* ``trigger='available_now'`` processes what is waiting and stops; a run with nothing new starts no
  batch. ``trigger='5 minutes'`` (or any interval) keeps running on that cadence. ``has_data`` tells beforehand whether a run has
  anything to do.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from routeflow.operators.curate import curate
from routeflow.schemas import CURATED_SCHEMA, RAW_SCHEMA
from routeflow.sources import ledger
from routeflow.sources.landing import list_files, load_files
from routeflow.sources.ledger_stream import stream_slices
from routeflow.sources.tables import MAX_FILE_AGE, ensure_layer, make_folder, read_slices, write_layer


def stream_tag(checkpoint: str) -> str:
    """Stable short id of a stream (its checkpoint), used in the slice names it writes."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:10]


def _start(writer, checkpoint: str, trigger: str | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger in (None, "available_now"):
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def _run(query: StreamingQuery, trigger: str | None) -> StreamingQuery:
    if trigger in (None, "available_now"):
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return query


def raw_changes(spark: SparkSession, raw_path: str, checkpoint: str, max_slices: int | None = None) -> DataFrame:
    """The append-only change stream of the raw table: every committed slice, once, in order of commitment."""
    ensure_layer(spark, raw_path, RAW_SCHEMA)  # a stream can start before the first load
    return stream_slices(spark, raw_path, ledger.consumed(spark, checkpoint), max_slices)


def slice_folders(batch: DataFrame) -> list[str]:
    """The slices of a micro-batch (names only, bounded by ``max_slices``); none in the empty batch of a fresh stream without data."""
    return [s["folder"] for s in batch.where(batch.kind == ledger.APPEND).orderBy("position").collect()]


def drain(
    spark: SparkSession, raw_path: str, checkpoint: str, write_batch, max_slices: int | None = None, name: str | None = None
) -> StreamingQuery:
    """Run a table's change stream until it has read what was committed when it began.

    A run takes one batch, and after a crash that is the batch that died: so it is started again until the ledger's end is reached.
    """
    end = ledger.head(spark, raw_path)
    while True:
        writer = raw_changes(spark, raw_path, checkpoint, max_slices).writeStream.foreachBatch(write_batch)
        query = _run(_start(writer, checkpoint, "available_now", name), "available_now")
        if ledger.consumed(spark, checkpoint) > end:
            return query


def create_change_stream(spark: SparkSession, raw_path: str, checkpoint: str) -> None:
    """Start a change stream *now*: slices already in raw are marked consumed, not delivered."""
    drain(spark, raw_path, checkpoint, lambda batch, batch_id: None)


def has_data(spark: SparkSession, raw_path: str, checkpoint: str) -> bool:
    """Whether a curation run on this checkpoint would find new slices; starts no query."""
    return ledger.has_data(spark, raw_path, checkpoint)


def run_curation(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    checkpoint: str,
    *,
    trigger: str | None = "available_now",
    max_slices_per_trigger: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The incremental task: new raw rows -> filter, standardise, derive -> append to curated.

    Starts from all raw rows on a fresh checkpoint, or from the point ``create_change_stream``
    recorded. Returns the (finished, for ``available_now``) query.
    """
    tag = stream_tag(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folders = slice_folders(batch)
        if folders:
            rows = read_slices(batch.sparkSession, raw_path, RAW_SCHEMA, folders)
            write_layer(curate(rows), curated_path, f"curate-{tag}-{batch_id:010d}", CURATED_SCHEMA)

    if trigger in (None, "available_now"):
        return drain(spark, raw_path, checkpoint, write_batch, max_slices_per_trigger, name)
    changes = raw_changes(spark, raw_path, checkpoint, max_slices_per_trigger)
    return _start(changes.writeStream.foreachBatch(write_batch), checkpoint, trigger, name)


def run_ingest(
    spark: SparkSession,
    landing_path: str,
    raw_path: str,
    checkpoint: str,
    *,
    trigger: str | None = "available_now",
    max_files_per_trigger: int | None = None,
    csv_options: dict[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """New landing files -> typed raw rows (+ rejects); a file already loaded is never reloaded."""
    files = list_files(spark, landing_path, streaming=True, most=max_files_per_trigger)
    tag = stream_tag(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load_files(batch.sparkSession, batch.collect(), raw_path, f"ingest-{tag}-{batch_id:010d}", csv_options)

    return _run(_start(files.writeStream.foreachBatch(write_batch), checkpoint, trigger, name), trigger)


def take_inserts(
    spark: SparkSession, inbox: str, path: str, schema: T.StructType, checkpoint: str, *, trigger: str | None = "available_now", name: str | None = None
) -> StreamingQuery:
    """Rows that SQL inserts left in the inbox table -> slices of the layer table; a file of the inbox is taken once."""
    make_folder(spark, inbox)  # a stream can start before the first insert
    rows = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE).parquet(inbox)
    tag = stream_tag(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_layer(batch, path, f"inserts-{tag}-{batch_id:010d}", schema)

    return _run(_start(rows.writeStream.foreachBatch(write_batch), checkpoint, trigger, name), trigger)


__all__ = ["create_change_stream", "drain", "has_data", "raw_changes", "run_curation", "run_ingest", "slice_folders", "stream_tag", "take_inserts"]
