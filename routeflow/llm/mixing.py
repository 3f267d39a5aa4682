"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: all words shared by weight, no target above ``cap`` times its source (the
excess goes to the others by weight until none is above). Every document of a source expects
target / source size copies. The prefix sum of expected copies within the source, plus one random offset
of the source, crosses integer boundaries; a document is emitted once per boundary crossed. Documents are
taken in order of size within blocks, so the words taken stay near the target.

The prefix sum is two-level: blocks of a source are numbered in parallel and a running sum over block counts gives
their offsets, so a source that holds a third of all rows is not one task.

Defined results: a NULL text has size 0; a NULL source is a source of its own, last in order; sources without
words get target 0 and no copies; rows that repeat an id are sampled as rows of their own; an empty table gives an
empty result; other columns are carried unchanged whatever their names (a column called like one
that is added, ``size`` for example, is replaced by ``mix_table`` and untouched by ``mix``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeflow.llm.common import ranked, staged, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 20240
#: Rows numbered by one task.
BLOCK_ROWS = 2_000
#: Random offsets are multiples of one over this, so that they add to prefix sums exactly.
OFFSETS = 1 << 20


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, n_docs, target) of rows (source, size): one row per source.

    Water level: with sources in order of cap / weight, the level is the words left after those that reach
    their cap, divided by the weight that is left. The windows here run over one row per source.
    """
    per = staged(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources"
    )
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")))
    per = per.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(everything)
    target = F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def _sampled(docs: DataFrame, text: str, source: str, key: str, weights: Sequence[float], cap: float, seed: int) -> DataFrame:
    """(row, key, size, source_size, target, copies) of every row; ``row`` holds all its columns."""
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    targets = staged(source_targets(sized.select("source", "size"), weights, cap), "targets").withColumnRenamed("source", "of")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    shuffled = F.xxhash64(F.lit(seed), F.col("key"), F.col("size"))
    snake = F.when(F.col("__block") % 2 == 0, F.col("size")).otherwise(-F.col("size"))
    numbered = ranked(joined, ["source"], [snake, shuffled, F.col("key")], shuffled, "n_docs", BLOCK_ROWS, "place")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.lit(OFFSETS)) / F.lit(float(OFFSETS))
    crossed = F.floor(offset + rate * F.col("place")) - F.floor(offset + rate * (F.col("place") - 1))
    copies = F.least(crossed, F.lit(-(-cap // 1)).cast("long"))
    return numbered.withColumn("copies", copies.cast("long"))


def mix_table(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: ``key``, size, source_size, target, copies, taken (words, repeats counted)."""
    return _sampled(docs, text, source, key, weights, cap, seed).select(
        F.col("key").alias(key),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """The mixture: each row as often as it is taken, columns unchanged."""
    rows = _sampled(docs, text, source, key, weights, cap, seed).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
