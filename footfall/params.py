"""Typed parameters of one daily run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta


@dataclass(frozen=True)
class RunParams:
    """One batch interval ``[start, end)`` and the day the features describe.

    ``as_of`` is the moment whose recorded order history counts as "the state
    before this batch". It defaults to ``start``, so re-running an old interval
    sees the history of that interval and not of today. History recorded after
    ``as_of`` is invisible to the run.
    """

    start: datetime
    end: datetime
    job_date: date
    as_of: datetime | None = None

    def __post_init__(self) -> None:
        if self.as_of is None:
            object.__setattr__(self, "as_of", self.start)
        for name in ("start", "end", "as_of"):
            moment = getattr(self, name)
            if not isinstance(moment, datetime) or moment.tzinfo is not None:
                raise TypeError(f"{name} must be a datetime without a zone, got {moment!r}")
        if not isinstance(self.job_date, date) or isinstance(self.job_date, datetime):
            raise TypeError(f"job_date must be a date, got {self.job_date!r}")
        if self.start >= self.end:
            raise ValueError(f"empty interval [{self.start}, {self.end})")

    @classmethod
    def for_day(cls, day: date) -> RunParams:
        """The interval a daily schedule gives: midnight to midnight."""
        start = datetime.combine(day, time())
        return cls(start=start, end=start + timedelta(days=1), job_date=day)
