"""Sums of daily metrics over several look-back horizons at once."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.time import days_until

# Look-back horizons in days; None reaches back without limit.
HORIZONS: tuple[int | None, ...] = (1, 7, 30, None)


def suffix(horizon: int | None) -> str:
    return "total" if horizon is None else f"{horizon}d"


def names(metric: str, horizons: Sequence[int | None] = HORIZONS) -> list[str]:
    return [f"{metric}_{suffix(h)}" for h in horizons]


def up_to(df: DataFrame, job_date: date, day: str = "activity_date") -> DataFrame:
    """Days up to and including ``job_date``."""
    return df.where(F.col(day) <= F.lit(job_date))


def horizon_sums(
    df: DataFrame,
    keys: Sequence[str],
    job_date: date,
    metrics: Mapping[str, Column],
    also: Mapping[str, Column] | None = None,
    day: str = "activity_date",
    horizons: Sequence[int | None] = HORIZONS,
    tried: Collection[str] = (),
) -> DataFrame:
    """Per key: each metric summed over each horizon that ends on ``job_date``.

    A horizon of h days holds the day distances 0 .. h-1. ``also`` adds further
    aggregates to the same pass. A key with rows but none inside a horizon gets 0.
    Sums of the metrics ``tried`` are NULL where they are too large.
    """
    distance = days_until(job_date, F.col(day))

    def total(metric: str, value: Column, h: int | None) -> Column:
        inside = value if h is None else F.when(distance < h, value).otherwise(0)
        return (F.try_sum if metric in tried else F.sum)(inside)

    sums = [
        total(metric, value, h).alias(f"{metric}_{suffix(h)}")
        for metric, value in metrics.items()
        for h in horizons
    ]
    return (
        up_to(df, job_date, day)
        .groupBy(*keys)
        .agg(*[value.alias(name) for name, value in (also or {}).items()], *sums)
    )
