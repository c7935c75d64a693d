"""The order-status history as a table.

Partitioned by ``valid_to`` and by the month of a column that rarely changes in the
life of a row. Closed versions never change: each run adds one ``valid_to`` partition.
Open versions are the ``valid_to`` NULL partition, of which a run rewrites only the
months it changes. A point-in-time read prunes all partitions that had ended.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from footfall.functions.time import ntz
from footfall.operators.history import changed_keys, first_versions, started_versions
from footfall.storage import files
from footfall.storage.tables import read_partitioned, recover, replace_partitions

MONTH = "version_month"
_PARTITIONS = ("valid_to", MONTH)
_NULL = "__HIVE_DEFAULT_PARTITION__"  # how Spark names a NULL partition
_OPEN = f"valid_to={_NULL}"
# Changed keys that may go to every task. Spark judges by the bytes of their file, where they are
# packed: millions of them pass for a small table and fill the driver.
_FEW = 100_000


def history_schema(source: StructType) -> StructType:
    moments = ("meta_updated_at", "valid_from", "valid_to")
    return StructType(
        [
            *source.fields,
            StructField("scd_id", StringType()),
            *[StructField(name, TimestampNTZType()) for name in moments],
            StructField(MONTH, StringType()),
        ]
    )


def read_history(
    spark: SparkSession, path: str, source: StructType, ended_after: datetime | None = None
) -> DataFrame:
    """The history, without its layout column; empty if there is none yet.

    With ``ended_after`` only versions still open or ended later; the folders of all
    others, one per past run, are not listed.
    """
    schema = history_schema(source)
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema).drop(MONTH)
    only = None
    if ended_after is not None:
        only = [
            name
            for name in files.partitions(spark, path, 1)
            if name == _OPEN or _ended(name) > ended_after
        ]
    return read_partitioned(spark, path, schema, only).drop(MONTH)


def _ended(folder: str) -> datetime:
    return datetime.fromisoformat(unquote(folder.removeprefix("valid_to=")))


def read_any_history(spark: SparkSession, path: str) -> DataFrame:
    """The history of a source whose columns are not known beforehand."""
    # Spark would take the folder names of valid_to for moments in the session's zone.
    kinds = {"valid_to": TimestampNTZType(), MONTH: StringType()}
    found = spark.read.parquet(path).schema
    schema = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    return spark.read.schema(schema).parquet(path).drop(MONTH)


def update_snapshot(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: str,
    check: Sequence[str],
    run_ts: datetime,
    month_of: str,
) -> None:
    """Records the state of ``source`` at ``run_ts``.

    Running again on the same state adds nothing. Runs must move forward in time, and
    the source must hold a key once. Rows whose ``month_of`` is NULL make up a month of
    their own.

    Finding the changes takes the key and the compared columns of all open versions
    and of the whole source; whole rows are read for the months of the changes only.
    """
    recover(spark, path, len(_PARTITIONS))
    schema = history_schema(source.schema)
    dated = source.withColumn(MONTH, F.date_format(F.col(month_of), "yyyyMM"))
    if not files.exists(spark, path):
        versions = first_versions(dated, key, run_ts)
        replace_partitions(spark, versions, path, _PARTITIONS, [key])
        return

    has_open = files.exists(spark, f"{path}/{_OPEN}")
    open_versions = read_partitioned(spark, path, schema, only=[_OPEN] if has_open else [])
    staged = f"{path.rstrip('/')}.changes"
    changed_keys(open_versions, dated, key, check, MONTH).write.mode("overwrite").parquet(staged)
    changes = spark.read.parquet(staged)
    months = _months(changes)
    if months:
        latest = open_versions.agg(F.max("valid_from")).head()[0]
        if latest is not None and latest >= run_ts:
            raise ValueError(f"history already reaches {latest}; cannot record {run_ts}")
        keys = changes.select(key)
        if changes.count() > _FEW:
            keys = keys.hint("merge")
        in_months = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            in_months = F.col(MONTH).isNull() | in_months
        changed_rows = dated.where(in_months).join(keys, key, "left_semi")
        versions = started_versions(changed_rows, key, run_ts).select(*schema.fieldNames())

        open_months = [f"{_OPEN}/{MONTH}={_NULL if m is None else m}" for m in months]
        present = files.partitions(spark, f"{path}/{_OPEN}", 1)
        touched = [name for name in open_months if name.removeprefix(f"{_OPEN}/") in present]
        if touched:
            marks = keys.withColumn("ends", F.lit(True))
            marked = read_partitioned(spark, path, schema, only=touched).join(marks, key, "left")
            ended = marked.withColumn("valid_to", F.when(F.col("ends"), ntz(run_ts)))
            versions = versions.unionByName(ended.drop("ends"))
        replace_partitions(spark, versions, path, _PARTITIONS, [key], also_empty=open_months)
    files.delete(spark, staged)


def _months(changes: DataFrame) -> list[str | None]:
    """Months in which open versions end or start: as many as the history has, at most."""
    ends = changes.where("had").select(F.col(f"old_{MONTH}").alias("month"))
    starts = changes.select(F.col(f"new_{MONTH}").alias("month"))
    return [row.month for row in ends.unionByName(starts).distinct().collect()]
