"""Totals of the days before a window, carried from one run to the next.

Features look back 30 days and without limit. What lies before the window is summed up per
user once, and each day that leaves the window is added, so that a run reads the days of its
window and not the whole table. When a day that the totals hold is replaced, totals are made
anew from sums per month: the months of such days are summed up again, the others are not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.storage import changes, files
from footfall.storage.tables import rebuild_partitioned, recover, replace_partitions

_MONTH = "month"


@dataclass(frozen=True)
class Daily:
    """A stored daily table whose changes are kept.

    ``read`` gives the rows of its partitions by name. ``summed`` gives the totals of such
    rows by their keys and further ones; totals can be summed again among rows.
    """

    path: str
    read: Callable[[list[str]], DataFrame]
    summed: Callable[..., DataFrame]
    day: str = "activity_date"


def _days(partition: str) -> tuple[date, date] | None:
    """First and last day of a partition by day or month; None where it has no day."""
    value = partition.partition("=")[2]
    if value.startswith("__"):
        return None
    if len(value) == 6:
        first = date(int(value[:4]), int(value[4:]), 1)
        return first, _next_month(first) - timedelta(days=1)
    day = date.fromisoformat(value)
    return day, day


def _next_month(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1)


def between(spark: SparkSession, table: Daily, first: date | None, last: date) -> DataFrame:
    """Rows of the days ``first`` to ``last``; other partitions are not even listed."""
    spans = {name: _days(name) for name in files.partitions(spark, table.path, 1)}
    names = [
        name
        for name, span in spans.items()
        if span and span[0] <= last and (first is None or span[1] >= first)
    ]
    rows = table.read(names)
    inside = F.col(table.day) <= F.lit(last)
    if first is not None:
        inside &= F.col(table.day) >= F.lit(first)
    return rows.where(inside)


def with_totals(
    spark: SparkSession, table: Daily, job_date: date, window: int, path: str
) -> DataFrame:
    """Rows up to ``job_date``: those of the last ``window`` days, and totals of all before.

    Totals stand for a day just before the window. Where totals have moved past it, as for
    an older job date, all rows are read.
    """
    through = job_date - timedelta(days=window)
    totals = totals_through(spark, table, through, path)
    if totals is None:
        return between(spark, table, None, job_date)
    recent = between(spark, table, through + timedelta(days=1), job_date)
    before = totals.withColumn(table.day, F.lit(through))
    return recent.select(*before.columns).unionByName(before)


def totals_through(
    spark: SparkSession, table: Daily, through: date, path: str
) -> DataFrame | None:
    """Totals of all days up to ``through``, kept at ``path``; None if they have moved past it.

    The folder of kept totals tells their last day and the last change that they hold, so
    that both become valid in one move.
    """
    known = _kept(spark, path)
    seen = known[1] if known else 0
    found = changes.since(spark, table.path, seen)
    if known and known[0] > through:
        return None
    if known and found.touched is not None:
        dirty = [span for name in found.touched if (span := _days(name)) and span[0] <= known[0]]
        if not dirty and known == (through, found.last):
            return spark.read.parquet(_folder(path, *known))
        if dirty:
            rows = _from_months(spark, table, through, path, dirty)
        else:
            before = spark.read.parquet(_folder(path, *known))
            later = between(spark, table, known[0] + timedelta(days=1), through)
            rows = before.unionByName(table.summed(later))
    else:
        # A new table, or one that was replaced as a whole.
        files.delete(spark, f"{path}/months")
        rows = between(spark, table, None, through)
    folder = _folder(path, through, found.last)
    table.summed(rows).write.mode("overwrite").parquet(f"{path}/next")
    files.delete(spark, folder)
    files.move(spark, f"{path}/next", folder)
    if known and known != (through, found.last):
        files.delete(spark, _folder(path, *known))
    return spark.read.parquet(folder)


def _folder(path: str, through: date, seen: int) -> str:
    return f"{path}/totals/{through.isoformat()}.{seen}"


def _kept(spark: SparkSession, path: str) -> tuple[date, int] | None:
    """The last day and change of the totals there are; the newest of two, if a run died."""
    found = [name.rpartition(".") for name in files.names(spark, f"{path}/totals")]
    return max(
        ((date.fromisoformat(day), int(seen)) for day, _, seen in found),
        key=lambda known: (known[1], known[0]),
        default=None,
    )


def _from_months(
    spark: SparkSession, table: Daily, through: date, path: str, dirty: list[tuple[date, date]]
) -> DataFrame:
    """Rows that sum up to the totals, from sums per month.

    Sums of all months before that of ``through`` are brought up to date first: those that
    are not there yet, and those that hold a day that was replaced.
    """
    months = f"{path}/months"
    recover(spark, months, 1)
    current = through.replace(day=1)

    def month_sums(rows: DataFrame) -> DataFrame:
        name = F.date_format(F.col(table.day), "yyyyMM")
        return table.summed(rows.withColumn(_MONTH, name), _MONTH)

    if not files.exists(spark, months):
        rows = between(spark, table, None, current - timedelta(days=1))
        rebuild_partitioned(spark, month_sums(rows), months, [_MONTH])
    else:
        spans = [_days(name) for name in files.partitions(spark, table.path, 1)]
        held = set(files.partitions(spark, months, 1))
        stale = {first.replace(day=1) for first, _ in dirty}
        missing = {s[0].replace(day=1) for s in spans if s} - {_days(m)[0] for m in held}
        again = sorted(m for m in stale | missing if m < current)
        if again:
            parts = [between(spark, table, m, _next_month(m) - timedelta(days=1)) for m in again]
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            names = [f"{_MONTH}={m:%Y%m}" for m in again]
            replace_partitions(spark, month_sums(rows), months, [_MONTH], also_empty=names)
    this_month = table.summed(between(spark, table, current, through))
    if not files.partitions(spark, months, 1):
        return this_month
    held = spark.read.schema(this_month.schema).parquet(months)
    return held.select(*this_month.columns).unionByName(this_month)
