"""Versioned history of a keyed table (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions.time import ntz, valid_at


def _version(key: Column, run_ts: datetime) -> dict[str, Column]:
    """Columns that a version starting at ``run_ts`` has beside those of its row."""
    now = ntz(run_ts)
    return {
        "scd_id": F.md5(F.concat_ws("|", key.cast("string"), now.cast("string"))),
        "meta_updated_at": now,
        "valid_from": now,
        "valid_to": F.lit(None).cast("timestamp_ntz"),
    }


def _unique(source: DataFrame, key: str) -> DataFrame:
    """``source``, stopping the job where a key occurs twice.

    Rows are placed and sorted by key as a join on it needs them, so before such a
    join this costs no shuffle.
    """
    copy = F.row_number().over(W.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"{key} occurs more than once: "), F.col(key).cast("string"))
    single = F.when(F.col("copy") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return source.withColumn("copy", copy).where(single).drop("copy")


def first_versions(source: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """Every row of ``source`` as an open version that starts at ``run_ts``."""
    return started_versions(_unique(source, key), key, run_ts)


def started_versions(source: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """``first_versions`` of rows known to have unique keys."""
    version = _version(F.col(key), run_ts)
    return source.select("*", *[column.alias(name) for name, column in version.items()])


def _compare(
    versions: DataFrame,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    old_columns: Sequence[str],
    new_columns: Sequence[str],
) -> DataFrame:
    """Structs ``old`` and ``new`` side by side, and whether a version starts now.

    ``old`` is NULL for keys new in the source; ``new`` is NULL for keys gone from it
    and for closed versions, which meet nothing. Only the ``check`` columns decide;
    NULL equals NULL.
    """
    is_open = F.col("valid_to").isNull().alias("is_open")
    packed = F.struct(*old_columns).alias("old")
    old = versions.select(F.col(key).alias("old_key"), is_open, packed)
    single = _unique(source.select(key, F.struct(*new_columns).alias("new")), key)
    new = single.withColumnRenamed(key, "new_key")
    differs = reduce(or_, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check])
    starts = F.col("new").isNotNull() & (F.col("old").isNull() | differs)
    joined = old.join(new, (F.col("old_key") == F.col("new_key")) & F.col("is_open"), "full")
    return joined.select(
        F.coalesce("old_key", "new_key").alias(key), "old", "new", starts.alias("starts")
    )


def changed_keys(
    open_versions: DataFrame, source: DataFrame, key: str, check: Sequence[str], also: str
) -> DataFrame:
    """Keys whose version starts now, with column ``also`` of the open and the new row.

    ``had`` tells an open row whose ``also`` is NULL from no open row.

    Shuffles the key, the ``check`` columns and ``also``, and nothing else of either side.
    """
    columns = [*check, also]
    compared = _compare(open_versions, source, key, check, columns, columns)
    return compared.where("starts").select(
        key,
        F.col("old").isNotNull().alias("had"),
        F.col(f"old.{also}").alias(f"old_{also}"),
        F.col(f"new.{also}").alias(f"new_{also}"),
    )


def merge_versions(
    history: DataFrame, source: DataFrame, key: str, check: Sequence[str], run_ts: datetime
) -> DataFrame:
    """The whole history after a run, from one pass over the join with its source.

    Changed keys get their open version closed and a new one started, new keys
    start one, all others stay, including keys gone from the source. Both sides are
    read once, so runs can be chained lazily. For a history kept as a table use
    ``storage.history``, which rewrites only what changes.
    """
    columns = history.columns
    compared = _compare(history, source, key, check, columns, source.columns)

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].alias(c) for c in columns])

    old = {c: F.col(f"old.{c}") for c in columns}
    new = {c: F.col(f"new.{c}") for c in source.columns}
    had, starts = F.col("old").isNotNull(), F.col("starts")
    versions = F.array(
        F.when(had & ~starts, row(old)),
        F.when(had & starts, row({**old, "valid_to": ntz(run_ts)})),
        F.when(starts, row({**new, **_version(F.col(key), run_ts)})),
    )
    present = F.filter(versions, lambda version: version.isNotNull())
    return compared.select(F.explode(present).alias("row")).select("row.*")


def as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """The versions in force at one moment: at most one per key."""
    return history.where(valid_at(ntz(moment), F.col("valid_from"), F.col("valid_to")))


def as_of_join(
    facts: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str]
) -> DataFrame:
    """Each fact with the ``columns`` of the version in force at its own ``moment``.

    Versions of a key do not overlap, so a fact meets at most one and none is
    repeated; facts before the first version keep NULLs. A key has at most one
    version per snapshot run, and the many side is the outer side, which Spark's
    skew handling splits when one key holds too many facts.
    """
    versions = history.select(
        F.col(key).alias("version_key"),
        F.col("valid_from").alias("version_from"),
        F.col("valid_to").alias("version_to"),
        *[F.col(c).alias(f"version_{c}") for c in columns],
    )
    matches = (F.col(key) == F.col("version_key")) & valid_at(
        F.col(moment), F.col("version_from"), F.col("version_to")
    )
    joined = facts.join(versions, matches, "left")
    return joined.select(
        *facts.columns, *[F.col(f"version_{c}").alias(f"{c}_as_of") for c in columns]
    )
