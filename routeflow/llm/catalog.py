"""Registered queries of this subpackage: opN_<name> over the driver's tables, and the corpus pipeline."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable

from pyspark import cloudpickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeflow.llm import (
    ann_scan,
    exact_dedup,
    fill_in_middle,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    substring_dedup,
    url_filter,
    warc,
)
from routeflow.llm.common import table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled(spark))
    out = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules decide of op2: the verdict is NULL where the model judges."""
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return op2_url_filter(spark, sf_dir).withColumn("verdict", ruled)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("clean_sha256"))


def op3_line_dedup_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), scaled=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("clean_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of op5, without what the sample takes."""
    return op5_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("clean_text", 256).alias("kept_sha256"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_table(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op8_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base kinds of op8, without the spans that the classifier adds."""
    return op8_personal_data(spark, sf_dir).select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.rewrite(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    )


def repeat_tail(doc_id: object, words: list[str]) -> list[str]:
    """op12's input: in documents whose id's CRC-32 is divisible by ten, the words from a drawn place on become periodic."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return (words[:a] + unit * -(-(n - a) // p))[:n]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.collapse_runs(table(spark, sf_dir, "documents"), rewrite=repeat_tail)
    best = periodic_runs.strongest(F.col("runs"))
    return out.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        periodic_runs.digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_scan.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository top; it imports the operators of this subpackage

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op2_url_rules": op2_url_rules,
    "op3_line_dedup": op3_line_dedup,
    "op3_line_dedup_scaled": op3_line_dedup_scaled,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op5_mixing_targets": op5_mixing_targets,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_personal_data": op8_personal_data,
    "op8_base_spans": op8_base_spans,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_nearest_neighbours": op13_nearest_neighbours,
    "pipeline": pipeline,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
