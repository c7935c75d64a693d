"""Batch filter and keyed replacement."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.time import in_interval
from footfall.params import RunParams
from footfall.storage import grain


def batch_filter(
    df: DataFrame, moment: str, params: RunParams, day: str | None = None
) -> DataFrame:
    """Rows of the batch interval.

    ``day`` names a partition column holding the calendar day of ``moment``. A
    filter on ``moment`` alone does not prune a separate day column, so the same
    interval is stated for it too, and for the column of a longer span beside it.
    """
    kept = df.where(in_interval(F.col(moment), params.start, params.end))
    if day is not None:
        first, last = params.start.date(), (params.end - timedelta(microseconds=1)).date()
        kept = kept.where(F.col(day).between(F.lit(first), F.lit(last)))
        span = grain.found(day, df.columns)
        if span != grain.DAY:
            spans = F.col(grain.column(day, span))
            kept = kept.where(spans.between(F.lit(grain.first(first, span)), F.lit(last)))
    return kept


def without_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``; NULL keys compare as equal."""
    batch_keys = batch.select([F.col(k).alias(f"batch_{k}") for k in keys])
    same_key = [F.col(k).eqNullSafe(F.col(f"batch_{k}")) for k in keys]
    return target.join(batch_keys, same_key, "left_anti")


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every key of ``batch`` replaced by the rows of ``batch``.

    Keys that do not come back in the batch survive, also inside the interval
    that is processed again. Rows sharing a key within the batch all go in.
    """
    return without_keys(target, batch, keys).unionByName(batch)
