"""Partitions by day, month or year, as a table's bytes ask for.

A partition per day suits a table that gains much a day; of a small one over many days it
makes thousands of small files. The first load counts the bytes of a day, and the choice is
recorded in the table's folder. The partition column then holds the first day of its span.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from footfall.storage import files

MARK = "_grain"  # Spark's readers leave such names out
DAY, MONTH, YEAR = "day", "month", "year"
# Days of a span, and what Spark calls it.
_SPANS = {DAY: (1, "DD"), MONTH: (30, "MM"), YEAR: (365, "YEAR")}
PARTITION_BYTES = 16 << 20  # that a partition should have at least


def chosen(size: int, days: int) -> str:
    """The shortest span that has ``PARTITION_BYTES``, of a table with ``size`` in ``days``."""
    a_day = size / max(1, days)
    return next((g for g in (DAY, MONTH) if a_day * _SPANS[g][0] >= PARTITION_BYTES), YEAR)


def of(spark: SparkSession, path: str) -> str:
    """The span of a stored table; tables without a record have days."""
    mark = f"{path}/{MARK}"
    return files.read_text(spark, mark) if files.exists(spark, mark) else DAY


def start(day: Column, grain: str) -> Column:
    """The first day of the span that a day lies in."""
    return day if grain == DAY else F.trunc(day, _SPANS[grain][1])


def first(day: date, grain: str) -> date:
    """``start`` of a date."""
    if grain == DAY:
        return day
    return day.replace(day=1) if grain == MONTH else day.replace(month=1, day=1)


def column(day: str, grain: str) -> str:
    """What a reader calls the partition column of a span longer than a day."""
    return f"{day}_{grain}"


def found(day: str, columns: list[str]) -> str:
    """The span of the partition column beside ``day`` among a reader's columns."""
    return next((g for g in (MONTH, YEAR) if column(day, g) in columns), DAY)
