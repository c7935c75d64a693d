"""A corpus made ready for training: the stages, and their run over ``documents``.

Each stage takes what the one before kept, written down in the shared folder. All
return the columns they are given, whatever their names. NULL and empty texts fail the first;
the others let them pass. Rows that repeat each other share their fate, and an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontamination, mixing, near_dedup, quality, substring_dedup
from footfall.llm.tables import kept, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# What a task sends to Python at once: rows are whole texts, some of them of megabytes.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def in_small_batches(stage: Stage) -> Stage:
    """The stage, in a session whose batches are small from then on; results are lazy."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_sound(docs)


@in_small_batches
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


@in_small_batches
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that stand in another place too."""
    without = substring_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        without = without.withColumn("n_chars", F.length("text").cast(kind))
    return without


@in_small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


@in_small_batches
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup_stage),
    ("repeated strings", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
]

# Compression ratios have no form in SQL. Every stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
