"""Per-customer aggregates and the assembled feature row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.money import amount, average, exact, settled, total
from footfall.functions.status import is_churned
from footfall.functions.time import days_until
from footfall.operators.horizons import HORIZONS, horizon_sums, names, suffix
from footfall.operators.top_category import rankings, top_category

EVENT_METRICS = {
    "events": "event_count",
    "total_session_duration": "total_session_duration",
}
SESSION_METRIC = {"sessions": "session_count"}
ORDER_COUNTS = {
    "completed_orders": "completed_order_count",
    "cancelled_orders": "cancelled_order_count",
}
ORDER_AMOUNTS = {
    "total_completed_amount": "total_completed_order_amount",
    "total_cancelled_amount": "total_cancelled_order_amount",
}
# average -> (amount, number of orders)
AVERAGES = {
    "avg_completed_order_amount": ("total_completed_amount", "completed_orders"),
    "avg_cancelled_order_amount": ("total_cancelled_amount", "cancelled_orders"),
}


def _columns(metrics: dict[str, str]) -> dict[str, Column]:
    return {name: F.col(column) for name, column in metrics.items()}


def traffic_source_stats(daily_events: DataFrame, job_date: date) -> DataFrame:
    """Sessions per user and traffic source over each horizon."""
    return horizon_sums(
        daily_events, ("user_id", "traffic_source"), job_date, _columns(SESSION_METRIC)
    )


def _popularity(horizon: int | None) -> tuple[str, ...]:
    """Scores that decide the most popular source; the total settles equal horizons."""
    score = f"sessions_{suffix(horizon)}"
    return (score,) if horizon is None else (score, "sessions_total")


def _most_popular(horizons: tuple[int | None, ...] = HORIZONS) -> list[Column]:
    return [
        top_category("traffic_source", _popularity(h)).alias(
            f"most_popular_traffic_source_{suffix(h)}"
        )
        for h in horizons
    ]


def traffic_source_rankings(stats: DataFrame) -> DataFrame:
    """Rank of each traffic source of a user, per horizon."""
    specs = {f"rank_{suffix(h)}": _popularity(h) for h in HORIZONS}
    return rankings(stats, ("user_id",), "traffic_source", specs)


def most_popular_sources(stats: DataFrame) -> DataFrame:
    """The top traffic source of a user, per horizon."""
    return stats.groupBy("user_id").agg(*_most_popular())


def user_event_agg(daily_events: DataFrame, job_date: date) -> DataFrame:
    """Event counts and session time per user over each horizon, and the last event."""
    return horizon_sums(
        daily_events,
        ("user_id",),
        job_date,
        _columns(EVENT_METRICS),
        also={"last_event_time": F.max("last_event_time")},
    )


def user_event_features(daily_events: DataFrame, job_date: date) -> DataFrame:
    """``user_event_agg`` and the favourite sources from one read of the daily rows.

    Daily rows are summed to (user, source) with every horizon, then to the user.
    """
    per_source = horizon_sums(
        daily_events,
        ("user_id", "traffic_source"),
        job_date,
        _columns(EVENT_METRICS | SESSION_METRIC),
        also={"last_event_time": F.max("last_event_time")},
    )
    totals = [F.sum(n).alias(n) for metric in EVENT_METRICS for n in names(metric)]
    # The 1-day favourite is not part of the feature row.
    return per_source.groupBy("user_id").agg(
        F.max("last_event_time").alias("last_event_time"), *totals, *_most_popular(HORIZONS[1:])
    )


def exact_amounts(daily_orders: DataFrame) -> DataFrame:
    """The daily rows with exact amounts in place of doubles."""
    return daily_orders.withColumns({c: exact(F.col(c)) for c in ORDER_AMOUNTS.values()})


def user_order_agg(daily_orders: DataFrame, job_date: date) -> DataFrame:
    """Transition counts and amounts per user over each horizon, and the last order."""
    return _user_order_sums(exact_amounts(daily_orders), job_date)


def _user_order_sums(daily_orders: DataFrame, job_date: date) -> DataFrame:
    # Halves are columns of their own: of a struct each sum would work them out again.
    amounts = _columns(ORDER_AMOUNTS)
    halves = {f"{n}_{half}": x[half] for n, x in amounts.items() for half in ("high", "low")}
    others = ["user_id", "activity_date", "last_order_time", *ORDER_COUNTS.values()]
    split = daily_orders.select(*others, *[x.alias(name) for name, x in halves.items()])
    rows = {f"{name}_rows": F.count(f"{name}_low") for name in amounts}
    summed = horizon_sums(
        split,
        ("user_id",),
        job_date,
        _columns(ORDER_COUNTS) | {name: F.col(name) for name in halves},
        also={"last_order_time": F.max("last_order_time"), **rows},
        tried=[name for name in halves if name.endswith("_high")],
    )

    def value(metric: str, horizon: int | None) -> Column:
        high, low = (F.col(f"{metric}_{half}_{suffix(horizon)}") for half in ("high", "low"))
        return amount(settled(high, low, F.col(f"{metric}_rows")))

    counts = [n for metric in ORDER_COUNTS for n in names(metric)]
    sums = [value(m, h).alias(f"{m}_{suffix(h)}") for m in ORDER_AMOUNTS for h in HORIZONS]
    return summed.select("user_id", "last_order_time", *counts, *sums)


def event_totals(daily_events: DataFrame, *keys: str) -> DataFrame:
    """Daily rows, or totals, summed up to what the features take of days long past."""
    metrics = (EVENT_METRICS | SESSION_METRIC).values()
    return daily_events.groupBy("user_id", "traffic_source", *keys).agg(
        F.max("last_event_time").alias("last_event_time"),
        *[F.sum(column).alias(column) for column in metrics],
    )


def order_totals(daily_orders: DataFrame, *keys: str) -> DataFrame:
    """``event_totals`` of orders, whose amounts are exact ones."""
    return daily_orders.groupBy("user_id", *keys).agg(
        F.max("last_order_time").alias("last_order_time"),
        *[F.sum(column).alias(column) for column in ORDER_COUNTS.values()],
        *[total(F.col(column)).alias(column) for column in ORDER_AMOUNTS.values()],
    )


def avg_order_amounts(user_orders: DataFrame) -> DataFrame:
    """Adds amount per order for both statuses and every horizon."""
    return user_orders.withColumns(
        {
            f"{avg}_{suffix(h)}": average(
                F.col(f"{total}_{suffix(h)}"), F.col(f"{count}_{suffix(h)}")
            )
            for avg, (total, count) in AVERAGES.items()
            for h in HORIZONS
        }
    )


def churn_flag(user_events: DataFrame, job_date: date) -> DataFrame:
    """Adds days since the last event and whether that is too long."""
    last = F.col("last_event_time")
    return user_events.withColumns(
        {
            "days_since_last_event": days_until(job_date, last),
            "is_churned": is_churned(last, job_date),
        }
    )


def behavior_features(
    daily_events: DataFrame, daily_orders: DataFrame, job_date: date
) -> DataFrame:
    """One row of 41 features per user seen in either daily table.

    Users without events have NULL event features and are not churned; users
    without orders have NULL order features, not 0.
    """
    return features_of(daily_events, exact_amounts(daily_orders), job_date)


def features_of(daily_events: DataFrame, daily_orders: DataFrame, job_date: date) -> DataFrame:
    """``behavior_features`` from exact amounts; daily rows may stand for several days."""
    events = user_event_features(daily_events, job_date)
    orders = _user_order_sums(daily_orders, job_date)
    both = churn_flag(avg_order_amounts(events.join(orders, "user_id", "full")), job_date)
    return both.select(
        "user_id",
        "last_event_time",
        "days_since_last_event",
        *names("events"),
        *names("total_session_duration"),
        *names("most_popular_traffic_source", HORIZONS[1:]),
        "last_order_time",
        days_until(job_date, F.col("last_order_time")).alias("days_since_last_order"),
        *names("completed_orders"),
        *names("cancelled_orders"),
        *names("total_completed_amount"),
        *names("total_cancelled_amount"),
        *names("avg_completed_order_amount"),
        *names("avg_cancelled_order_amount"),
        "is_churned",
    )
