"""Which partitions of a table may hold a key: a small table of key ranges and partitions.

It lies in the table's own folder and names, for every range of keys, all partitions that have
ever been given a key of it. Rows that went leave their entry behind, so what it names may
hold a key, and what it does not name does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.storage import files

FOLDER = "_key_ranges"  # Spark's readers leave such names out
SPAN = 1_000_000  # keys of a range
MOST_FILES = 64  # of the index, before it is written anew
_SCHEMA = "key_range bigint, folder string"


def folder_of(depth: int) -> Column:
    """The partition directory that a row was read from, as its file's path names it.

    The key column of a whole table passes here, and a pattern takes far longer per row.
    """
    last = F.substring_index(F.input_file_name(), "/", -depth - 1)
    return F.substring_index(last, "/", depth)


def _ranges(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    own = F.expr(f"`{key}` div {SPAN}").alias("key_range")
    return rows.select(own, *more).where("key_range IS NOT NULL").distinct()


def is_kept(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{FOLDER}")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{path}/{FOLDER}")


def add(spark: SparkSession, path: str, rows: DataFrame, key: str, depth: int) -> None:
    """Names the partitions of some stored rows, those of a batch or of the whole table.

    To be done before the rows of a batch get into the table.
    """
    entries = _ranges(rows, key, folder_of(depth).alias("folder"))
    if not is_kept(spark, path):
        # As a whole or not at all: an index that lacks a partition would be wrong.
        staged = f"{path.rstrip('/')}.keys"
        entries.coalesce(1).write.mode("overwrite").parquet(staged)
        files.move(spark, staged, f"{path}/{FOLDER}")
        return
    known = _read(spark, path)
    new = entries.join(known, ["key_range", "folder"], "left_anti")
    new.coalesce(1).write.mode("append").parquet(f"{path}/{FOLDER}")
    if len(files.names(spark, f"{path}/{FOLDER}")) > MOST_FILES:
        staged = f"{path.rstrip('/')}.keys"
        known.unionByName(new).distinct().coalesce(1).write.mode("overwrite").parquet(staged)
        # Without the index for a moment: then keys are sought in the whole table.
        files.delete(spark, f"{path}/{FOLDER}")
        files.move(spark, staged, f"{path}/{FOLDER}")


def folders(spark: SparkSession, path: str, batch: DataFrame, key: str) -> list[str]:
    """The partitions that may hold a key of the batch."""
    named = _read(spark, path).join(_ranges(batch, key), "key_range", "left_semi")
    return [row.folder for row in named.select("folder").distinct().collect()]
