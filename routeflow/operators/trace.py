"""Trace of curated rows to raw rows from co-located key tables.

For each slice the key tables keep its distinct trace keys (128-bit digests): raw keys as curation would have cleaned them, curated keys with
their number of rows. Both are catalog tables in equally many buckets of the digest, so the anti join of the two moves no row: each task
joins one bucket of both. A key that holds a third of the rows is one row a slice.

A slice is one partition, written by ``INSERT OVERWRITE`` of that partition: repeating a write that died leaves the slice once. A session whose
catalog has forgotten the partitions (one without a shared metastore) writes them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.functions import columns as C
from routeflow.operators import quality as Q
from routeflow.operators.states import key_digest, raw_trace_state, trace_state
from routeflow.session import staged
from routeflow.schemas import CURATED_SCHEMA, RAW_SCHEMA, TRACE_KEY_COLUMNS
from routeflow.sources import ledger
from routeflow.sources.catalog_tables import SLICE, Names, declare_table, partitions
from routeflow.sources.tables import read_layer, read_slices

RAW_KEYS, CURATED_KEYS = "trace_raw_keys", "trace_curated_keys"
BUCKETS = 64
#: Rows of both tables whose keys one bucket, that is, one task, is to hold.
BUCKET_ROWS = 1_000_000

_KEY, _SLICE = T.StructField("trace", T.BinaryType()), T.StructField(SLICE, T.StringType())
KEY_TABLES = {
    RAW_KEYS: (T.StructType([_KEY, _SLICE]), RAW_SCHEMA, raw_trace_state),
    CURATED_KEYS: (T.StructType([_KEY, T.StructField("n", T.LongType()), _SLICE]), CURATED_SCHEMA, trace_state),
}


def declare_keys(spark: SparkSession, names: Names, buckets: int = BUCKETS) -> None:
    """The two key tables; the number of buckets is that of the first declaration."""
    for name, (schema, _, _) in KEY_TABLES.items():
        declare_table(spark, names, name, schema, options=f"PARTITIONED BY (`{SLICE}`) CLUSTERED BY (trace) INTO {buckets} BUCKETS")


def buckets_for(spark: SparkSession, raw_path: str, curated_path: str, least: int = 8, rows: int = BUCKET_ROWS) -> int:
    """Buckets in proportion to the rows of the two layer tables (counted from Parquet footers)."""
    held = read_layer(spark, raw_path, RAW_SCHEMA).count() + read_layer(spark, curated_path, CURATED_SCHEMA).count()
    return max(least, -(-held // rows))


def update_keys(spark: SparkSession, names: Names, raw_path: str, curated_path: str, buckets: int = BUCKETS) -> None:
    """Bring the key tables up to the committed slices; slices they hold are not read again, those a reset took out go."""
    for name, path in ((RAW_KEYS, raw_path), (CURATED_KEYS, curated_path)):
        _, schema, state = KEY_TABLES[name]
        committed = [e.folder for e in ledger.live(ledger.entries(spark, path))]
        held = partitions(spark, names, name)
        for folder in committed:
            if folder not in held:
                rows = state(read_slices(spark, path, schema, [folder])).repartition(buckets, "trace")  # a file a bucket
                rows.createOrReplaceTempView("_trace_slice")
                spark.sql(f"INSERT OVERWRITE TABLE {names.of(name)} PARTITION (`{SLICE}` = '{folder}') SELECT {', '.join(rows.columns)} FROM _trace_slice")
        for folder in sorted(held - set(committed)):
            spark.sql(f"ALTER TABLE {names.of(name)} DROP IF EXISTS PARTITION (`{SLICE}` = '{folder}')")


def orphan_keys(spark: SparkSession, names: Names) -> DataFrame:
    """(trace, n) of curated keys without a raw row; an incomplete key, which matches nothing, is NULL. No exchange."""
    curated, raw = spark.table(names.of(CURATED_KEYS)), spark.table(names.of(RAW_KEYS))
    return curated.select("trace", "n").join(raw.select("trace"), "trace", "left_anti")


def trace_check(spark: SparkSession, names: Names, check: Q.Check = Q.CURATED_TRACES_TO_RAW) -> DataFrame:
    """``quality.trace_check`` from the key tables."""
    counted = orphan_keys(spark, names).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
    return counted.select(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.check_name).alias("check_name"),
        F.col("orphans").alias(check.count_name),
        C.verdict(check.passes(F.col("orphans"))).alias("result"),
    )


def orphan_rows(spark: SparkSession, names: Names, curated: DataFrame) -> DataFrame:
    """``quality.orphan_rows``: the curated rows of the orphan keys. Only these keys meet the rows; written first, they are broadcast while few."""
    mark = "_trace"
    lost = staged(orphan_keys(spark, names).where("trace IS NOT NULL").select(F.col("trace").alias(mark)).distinct(), "orphan-keys")
    keyed = curated.where(C.all_not_null(TRACE_KEY_COLUMNS)).withColumn(mark, key_digest(TRACE_KEY_COLUMNS))
    return keyed.join(lost, mark, "left_semi").select(*curated.columns).unionByName(curated.where(C.any_null(TRACE_KEY_COLUMNS)))
