"""Order-status and churn rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.time import days_until

# The two statuses that are counted, and the churn limit in days.
COMPLETED = "Completed"
CANCELLED = "Cancelled"
CHURN_DAYS = 90


def became(status: Column, previous: Column, target: str) -> Column:
    """The order has ``target`` now and had another status, or none, before."""
    return (status == target) & ~previous.eqNullSafe(F.lit(target))


def is_churned(last_event: Column, job_date: date) -> Column:
    """More than 90 days without an event; FALSE for customers without events."""
    return F.coalesce(days_until(job_date, last_event) > CHURN_DAYS, F.lit(False))
