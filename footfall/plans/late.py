"""Rows that are loaded after their day has run.

A batch takes the rows of its interval, so a row of an earlier day that is loaded later is
missed until that day runs again. Every load notes the days that it brought rows for; the
days before a run that have gained rows since the run before are late, and run again. Daily
rows are replaced by key, so running a day once more changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from footfall.params import RunParams
from footfall.plans.daily import STEPS, Targets, run_daily
from footfall.sources.registry import Sources
from footfall.sources.schemas import TABLES
from footfall.storage import changes, files

# Raw table -> the step that reads it by day.
_READ_BY = {"events": "int_daily_user_events", "orders": "int_daily_user_orders"}


@dataclass(frozen=True)
class Late:
    """Days of a raw table that are to run again, and the last note that told so."""

    table: str
    step: str
    days: tuple[date, ...]
    seen: int

    @property
    def spans(self) -> list[tuple[datetime, datetime]]:
        """Runs of days that follow each other; orders run day by day, as history does."""
        found: list[tuple[datetime, datetime]] = []
        for day in self.days:
            start = datetime.combine(day, time())
            end = start + timedelta(days=1)
            if found and self.table == "events" and found[-1][1] == start:
                found[-1] = (found[-1][0], end)
            else:
                found.append((start, end))
        return found


def _all_days(sources: Sources, table: str) -> list[str]:
    (day,) = TABLES[table].days
    found = sources[table].select(F.col(day).cast("string")).distinct()
    return [row[0] for row in found.collect() if row[0] is not None]


def late_days(
    spark: SparkSession, sources: Sources, targets: Targets, before: date
) -> list[Late]:
    """The days before ``before`` that gained rows since the last run with late days.

    Of a raw table that was overwritten that is every day. Tables that were not given as
    folders of loads, and steps that have not been built yet, have no late days.
    """
    found = []
    for table, step in _READ_BY.items():
        stored = sources.noted(table)
        if stored is None:
            continue
        seen = changes.seen(spark, targets.state(f"late/{table}"))
        told = changes.since(spark, stored, seen or 0)
        if seen is None or not files.exists(spark, targets.path(step)):
            gained = []
        else:
            gained = _all_days(sources, table) if told.gained is None else told.gained
        days = sorted(day for x in gained if (day := date.fromisoformat(x)) < before)
        found.append(Late(table, step, tuple(days), told.last))
    return found


def run_with_late(
    spark: SparkSession,
    sources: Sources,
    targets: Targets,
    params: RunParams,
    steps: Sequence[str] = STEPS,
    full_refresh: bool = False,
) -> list[Late]:
    """``run_daily``, and before the features the late days; returns those.

    Call it for every run: what the loads since the last call brought for the days before
    ``params.start`` is late. A late order meets the history as it was on its day, as with
    any older interval that runs again. Late days are marked as done at the end, so a run
    that dies repeats them.
    """
    found = [
        late
        for late in late_days(spark, sources, targets, params.start.date())
        if late.step in steps
    ]
    last = STEPS[-1]
    rolled_up = [step for step in steps if step != last]
    run_daily(spark, sources, targets, params, rolled_up, full_refresh)
    for late in [] if full_refresh else found:
        for start, end in late.spans:
            run_daily(spark, sources, targets, RunParams(start, end, params.job_date), [late.step])
    if last in steps:
        run_daily(spark, sources, targets, params, [last])
    for late in found:
        changes.set_seen(spark, targets.state(f"late/{late.table}"), late.seen)
    return found
