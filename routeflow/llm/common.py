"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.session import scratch_path

#: A word is a run of characters other than these six (space and U+0009 to U+000D).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str, compression: str = "snappy", batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before this table. ``batch_rows`` bounds the rows that Python
    workers get at once in this job, where rows hold texts: a batch is in the memory of both sides.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = int(spark.conf.get(BATCH_ROWS))
    if batch_rows:
        spark.conf.set(BATCH_ROWS, batch_rows if before <= 0 else min(before, batch_rows))
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column used in several places of one projection, or inside a lambda, may be evaluated at each
    of them; binding it as a lambda variable prevents that.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh_name(base: str, columns: Sequence[str]) -> str:
    """``base``, lengthened until no column has that name (names compare without case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: Column, n_rows: str, block_rows: int, rank: str) -> DataFrame:
    """Number the rows of each key from 1 without bringing a key's rows into one task.

    ``df`` carries ``n_rows``, the number of rows of the row's key. A key is split into blocks of about
    ``block_rows`` by ``spread`` (a hash); rows are numbered within their block in ``order`` (odd blocks
    backwards, so that neighbouring blocks join smoothly when the order is by size) and
    the block's offset, a running sum over block counts, is added. NULL keys count as one key.
    ``keys`` and the columns of ``order`` must not change between evaluations of ``df``.
    """
    block, found, before = (fresh_name(x, df.columns) for x in ("__block", "__found", "__before"))
    blocked = df.withColumn(block, F.pmod(spread, F.ceil(F.col(n_rows) / F.lit(block_rows)).cast("long")))
    sums = blocked.groupBy(*keys, block).agg(F.count(F.lit(1)).alias(found))
    by_key = Window.partitionBy(*keys).orderBy(block)
    sums = sums.withColumn(before, F.sum(found).over(by_key.rowsBetween(Window.unboundedPreceding, -1))).drop(found)
    within = Window.partitionBy(*keys, block).orderBy(*order)
    numbered = blocked.withColumn(rank, F.row_number().over(within))
    same = [numbered[k].eqNullSafe(sums[k]) for k in (*keys, block)]
    joined = numbered.join(sums, same, "left")
    kept = [numbered[c] for c in df.columns]
    return joined.select(*kept, (numbered[rank] + F.coalesce(sums[before], F.lit(0))).cast("long").alias(rank))


#: A side of at most this many short rows and array elements (ids and digests, some tens of MB in memory) may be broadcast.
BROADCAST_ROWS = 400_000


def small_side(rows: DataFrame) -> DataFrame:
    """A written table of short rows, with a broadcast hint if its counted size allows it.

    Beyond ``BROADCAST_ROWS`` the join is an ordinary one that AQE may split. The count reads Parquet footers only; where the
    rows hold arrays, whose lengths have no bound, every element counts as a row and the arrays are read.
    """
    arrays = [F.coalesce(F.size(f.name), F.lit(0)) for f in rows.schema if isinstance(f.dataType, T.ArrayType)]
    held = rows.agg(F.sum(sum(arrays, F.lit(1)).cast("long"))).head()[0] or 0 if arrays else rows.count()
    return F.broadcast(rows) if held <= BROADCAST_ROWS else rows
