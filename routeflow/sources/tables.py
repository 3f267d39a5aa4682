"""Layer tables on shared storage: raw (with its rejects and load history), curated, enriched, audit.

A layer table is a folder of slices, one for every load, insert or micro-batch, and a ledger of those that are committed
(``sources/ledger.py``). A slice holds Parquet data in one or more parts (``rows`` and, for loads, ``rejects`` and ``files``) and is published
as a whole by one ledger entry. Readers take their folders from the ledger: what an unfinished or crashed write left behind is never
seen, and a load id is committed once, however often the write is repeated.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.schemas import AUDIT_SCHEMA, CURATED_SCHEMA, LOAD_ID, LOAD_TIMESTAMP, RAW_SCHEMA
from routeflow.sources import ledger

#: The file source forgets files this much older than the newest one; its default of 7 days loses late or restored files.
MAX_FILE_AGE = "36500d"

#: Layer tables repeat names and codes; where a column has too many for a dictionary, zstd takes about half of snappy's bytes.
COMPRESSION = "zstd"

DATA = "data"
ROWS = "rows"


def new_load_id(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex[:16]}"


def _with_load_id(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(LOAD_ID, T.StringType(), True)])


def read_slices(
    spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str], part: str = ROWS, with_load_id: bool = False
) -> DataFrame:
    """The rows of the given slices of a layer table."""
    full = _with_load_id(schema)
    paths = [f"{path.rstrip('/')}/{DATA}/{f}/{part}" for f in folders]
    df = spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)
    return df if with_load_id else df.select(*schema.names)


def read_layer(spark: SparkSession, path: str, schema: T.StructType, with_load_id: bool = False) -> DataFrame:
    """Batch scan of a layer table: its committed slices; no rows where there are none."""
    return read_slices(spark, path, schema, [e.folder for e in ledger.live(ledger.entries(spark, path))], with_load_id=with_load_id)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop, fs = ledger.file_system(spark, path)
    fs.mkdirs(hadoop)


def slice_committed(spark: SparkSession, path: str, load_id: str) -> bool:
    """Whether the ``load_id`` slice is part of the table."""
    return ledger.holds(ledger.entries(spark, path), load_id)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the declared columns and order: ``load_timestamp`` defaults to the write time, any other to NULL."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == LOAD_TIMESTAMP:
            cols.append(F.current_timestamp().alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stage_slice(parts: dict[str, DataFrame], path: str, load_id: str, prefix: str = "") -> str:
    """Write the parts of a slice into a folder of their own, unseen until committed; returns the folder."""
    folder = f"{prefix}{load_id}.{uuid.uuid4().hex[:8]}"
    for name, df in parts.items():
        df.withColumn(LOAD_ID, F.lit(load_id)).write.parquet(f"{path.rstrip('/')}/{DATA}/{folder}/{name}", compression=COMPRESSION)
    return folder


#: Slices that were not committed within a week of their last write are taken for abandoned.
ABANDONED_S = 7 * 86_400


def sweep(spark: SparkSession, path: str, abandoned_s: float = ABANDONED_S) -> list[str]:
    """Delete what crashed or outrun writers left in the table's folder; returns the slice folders that went.

    A slice folder goes if no ledger entry names it, those before a reset included, and nothing in it was written for
    ``abandoned_s`` seconds, which must be longer than any load takes. Folders are judged before the ledger is read, so a slice that is
    committed meanwhile stays. Temporary ledger files of that age go too. Data that readers or streams can see is never touched.
    """
    hadoop, fs = ledger.file_system(spark, f"{path.rstrip('/')}/{DATA}")
    log, _ = ledger.file_system(spark, f"{path.rstrip('/')}/{ledger.LEDGER}")
    limit = time.time() * 1000 - abandoned_s * 1000

    def newest(status) -> int:
        below = fs.listStatus(status.getPath()) if status.isDirectory() else []
        return max([status.getModificationTime(), *map(newest, below)])

    old = [f.getPath() for f in fs.listStatus(hadoop) if newest(f) <= limit] if fs.exists(hadoop) else []
    named = {e.folder for e in ledger.entries(spark, path)}
    gone = [p for p in old if p.getName() not in named]
    for p in gone:
        fs.delete(p, True)
    if fs.exists(log):
        for f in fs.listStatus(log):
            if ledger.is_temporary(f.getPath().getName()) and f.getModificationTime() <= limit:
                fs.delete(f.getPath(), False)
    return sorted(p.getName() for p in gone)


def write_layer(df: DataFrame, path: str, load_id: str, schema: T.StructType | None = None) -> str:
    """Append ``df`` as the ``load_id`` slice of a layer table; a slice committed before is left as it is.

    A replayed write (a micro-batch after a crash, a retried load) therefore adds nothing; one that crashed before its commit adds
    its rows exactly once.
    """
    spark = df.sparkSession
    if not slice_committed(spark, path, load_id):
        ledger.commit(spark, path, load_id, stage_slice({ROWS: conform(df, schema) if schema is not None else df}, path, load_id))
    return load_id


def reset_layer(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Declare the table empty (``CREATE OR REPLACE``): only on an explicit reset."""
    ledger.commit(spark, path, new_load_id("reset"), "", kind=ledger.RESET)


def ensure_layer(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """``CREATE TABLE IF NOT EXISTS``: make the table's folder exist without touching existing data."""
    make_folder(spark, f"{path.rstrip('/')}/{ledger.LEDGER}")


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    return read_layer(spark, path, schema)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, CURATED_SCHEMA)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, AUDIT_SCHEMA)


def insert_rows(spark: SparkSession, path: str, rows, schema: T.StructType = RAW_SCHEMA, source_file: str | None = None) -> str:
    """Append literal rows (``INSERT ... VALUES``); ``load_timestamp`` takes the write time.

    ``rows`` are tuples of the declared columns minus ``load_timestamp`` (and minus
    ``source_file`` when ``source_file`` is given).
    """
    names = [n for n in schema.names if n != LOAD_TIMESTAMP and not (source_file and n == "source_file")]
    lit_schema = T.StructType([schema[n] for n in names])
    df = spark.createDataFrame(list(rows), lit_schema)
    if source_file:
        df = df.withColumn("source_file", F.lit(source_file))
    return write_layer(df, path, new_load_id("insert"), schema)
