"""Clickstream roll-ups: events -> sessions -> days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.ids import in_order
from footfall.functions.time import activity_day, seconds_between

DAY_KEYS = ("user_id", "activity_date", "browser", "traffic_source")
SESSION_KEYS = (*DAY_KEYS, "session_id")


def _last() -> Column:
    """Aggregate: the latest event, the largest such struct.

    Sequence number and id settle equal times, so the answer does not depend on row order.
    """
    ordered = in_order(F.col("id")).alias("id")
    return F.max(F.struct("created_at", "sequence_number", ordered, "event_type", "uri"))


def _with_day(events: DataFrame) -> DataFrame:
    return events.withColumn("activity_date", activity_day(F.col("created_at")))


def session_durations(events: DataFrame) -> DataFrame:
    """Seconds from first to last event per session within a day and cell."""
    return (
        _with_day(events)
        .groupBy(*SESSION_KEYS)
        .agg(
            seconds_between(F.min("created_at"), F.max("created_at")).alias("session_duration")
        )
    )


def _session_rollup(events: DataFrame) -> DataFrame:
    last = _last()
    return (
        _with_day(events)
        .groupBy(*SESSION_KEYS)
        .agg(
            F.count("*").alias("event_count"),
            last.alias("last"),
            seconds_between(F.min("created_at"), last["created_at"]).alias("session_duration"),
        )
    )


def daily_user_events(events: DataFrame) -> DataFrame:
    """One row per user, day, browser and traffic source.

    Sessions are rolled up first and days from sessions, so events are read once
    and never joined to their own sessions. Counting distinct sessions is
    counting rows. Both steps combine before they shuffle: a user, or one
    session, that holds a large share of all events arrives as one row per task.
    """
    return (
        _session_rollup(events)
        .groupBy(*DAY_KEYS)
        .agg(
            F.sum("event_count").alias("event_count"),
            F.max("last").alias("last"),
            F.count("session_id").alias("session_count"),
            F.sum("session_duration").alias("total_session_duration"),
        )
        .select(
            *DAY_KEYS,
            "event_count",
            F.col("last.created_at").alias("last_event_time"),
            F.col("last.event_type").alias("last_event_type"),
            F.col("last.uri").alias("last_event_uri"),
            "session_count",
            "total_session_duration",
        )
    )


def as_joined_per_event(daily: DataFrame) -> DataFrame:
    """``daily_user_events`` as if each event had been joined to every session of its cell.

    That join repeats a cell's events once per session and its session durations
    once per event. Both effects are products of columns already here, so the
    rows are never multiplied out.
    """
    return daily.withColumns(
        {
            "event_count": F.col("event_count") * F.col("session_count"),
            "total_session_duration": F.col("event_count") * F.col("total_session_duration"),
        }
    )


def last_event_per_user_day(events: DataFrame) -> DataFrame:
    """Type and address of the latest event per user and day."""
    return (
        _with_day(events)
        .groupBy("user_id", "activity_date")
        .agg(_last().alias("last"))
        .select(
            "user_id",
            "activity_date",
            F.col("last.created_at").alias("last_event_time"),
            F.col("last.event_type").alias("last_event_type"),
            F.col("last.uri").alias("last_event_uri"),
        )
    )
