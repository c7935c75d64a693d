"""Time expressions. All moments are TIMESTAMP_NTZ, so no session zone is involved."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; folded at planning time, so filters on it push down."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def activity_day(moment: Column) -> Column:
    return F.to_date(moment)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; ``unix_timestamp`` reads a zoneless value as it stands."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def days_until(job_date: date, moment: Column) -> Column:
    """Midnights crossed from ``moment`` to ``job_date``."""
    return F.datediff(F.lit(job_date), moment).cast("long")


def in_interval(moment: Column, start: datetime, end: datetime) -> Column:
    """Half-open: ``start <= moment < end``."""
    return (moment >= ntz(start)) & (moment < ntz(end))


def valid_at(moment: Column, valid_from: Column, valid_to: Column) -> Column:
    """Whether a version was in force: ``valid_from <= moment < valid_to``, NULL = open end."""
    return (valid_from <= moment) & ((valid_to > moment) | valid_to.isNull())
