"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after deleting white space; their SHA-256 is the key. A
Misra-Gries summary (Spark's ``approx_top_k`` keeps the frequent-items sketch of that family, merged
over partitions) names the digests that may hold many rows. Their exact winners are computed by a map-side
aggregation and broadcast (at most ``HEAVY_KEYS`` rows), so the copies of a frequent text leave the
flow before any shuffle. The remaining digests, each of few rows, meet in an ordinary shuffle.

Defined results: a NULL text counts as empty; of equal texts the row with the most code points stays,
then the smallest id (a NULL id comes last), then one row of those that agree in both; rows that repeat an
id are rows of their own; an empty table gives an empty result; other columns are carried unchanged
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeflow.llm.common import SPACE, staged

#: Size of the summary and the most heavy digests taken from it (bounds the broadcast).
SUMMARY_KEYS = 4096
HEAVY_KEYS = 512
#: A digest counts as heavy from this share of all rows on (one in so many).
HEAVY_ONE_IN = 1000


def normal_digest(text: Column) -> Column:
    """SHA-256, in lower-case hex, of the text without white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", ""), 256)


def _digests(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("doc"),
        normal_digest(F.col(text)).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"),
    )


def heavy_digests(rows: DataFrame) -> DataFrame:
    """Digests that the summary counts at least one in ``HEAVY_ONE_IN`` rows and twice; ``HEAVY_KEYS`` at most."""
    top = rows.agg(F.expr(f"approx_top_k(digest, {HEAVY_KEYS}, {SUMMARY_KEYS})").alias("top"), F.count(F.lit(1)).alias("n"))
    return (
        top.select("n", F.explode("top").alias("x"))
        .where((F.col("x.count") >= F.col("n") / HEAVY_ONE_IN) & (F.col("x.count") > 1))
        .select(F.col("x.item").alias("digest"))
    )


def _heavy_winners(rows: DataFrame) -> DataFrame:
    """The exact winner and size of each heavy digest: one row per digest, ``HEAVY_KEYS`` at most."""
    best = F.min(F.struct((-F.col("chars")).alias("fewer"), F.col("doc").isNull().alias("no_doc"), "doc", "row"))  # any orderable id
    found = rows.join(F.broadcast(heavy_digests(rows)), "digest", "left_semi").groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
    return found.select(
        "digest",
        (-F.col("b.fewer")).alias("win_chars"),
        F.col("b.doc").alias("win_doc"),
        F.col("b.row").alias("win_row"),
        "group_size",
    )


def _staged_digests(docs: DataFrame, text: str, key: str) -> DataFrame:
    return staged(_digests(docs, text, key).withColumn("row", F.monotonically_increasing_id()), "digests")


def annotate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256."""
    rows = _staged_digests(docs, text, key)
    winners = staged(_heavy_winners(rows), "heavy-winners")
    heavy = rows.join(F.broadcast(winners), "digest").select(
        F.col("doc").alias(key),
        F.col("win_doc").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("win_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    group = Window.partitionBy("digest")
    order = group.orderBy(F.desc("chars"), F.asc_nulls_last("doc"), "row")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        F.col("doc").alias(key),
        F.first("doc").over(order).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return heavy.unionByName(light)


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged.

    Copies of heavy digests other than the winner are removed before the shuffle that carries the texts.
    """
    winners = staged(_heavy_winners(_staged_digests(docs, text, key)), "heavy-winners")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        normal_digest(F.col(text)).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"),
        F.col(key).alias("doc"),
    )
    won = F.broadcast(winners.select("digest", "win_chars", "win_doc"))
    stays = F.col("win_chars").isNull() | ((F.col("chars") == F.col("win_chars")) & F.col("doc").eqNullSafe(F.col("win_doc")))
    order = Window.partitionBy("digest").orderBy(F.desc("chars"), F.asc_nulls_last("doc"), F.xxhash64("row"))
    best = rows.join(won, "digest", "left").where(stays).withColumn("place", F.row_number().over(order))
    return best.where("place = 1").select("row.*")
