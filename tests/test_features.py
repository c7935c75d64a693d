from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators.features import (
    behavior_features,
    most_popular_sources,
    traffic_source_rankings,
    traffic_source_stats,
    user_event_agg,
    user_event_features,
)
from footfall.operators.horizons import horizon_sums

JOB = date(2024, 5, 1)
EVENT_DAY = (
    "user_id bigint, activity_date date, browser string, traffic_source string, "
    "event_count bigint, last_event_time timestamp_ntz, last_event_type string, "
    "last_event_uri string, session_count bigint, total_session_duration bigint"
)
ORDER_DAY = (
    "user_id bigint, activity_date date, last_order_time timestamp_ntz, "
    "completed_order_count bigint, cancelled_order_count bigint, "
    "total_completed_order_amount double, total_cancelled_order_amount double"
)


def event_day(ago, user=1, source="Search", events=1, sessions=1, seconds=0):
    day = JOB - timedelta(days=ago)
    return (user, day, "Chrome", source, events, f"{day} 23:59:59", "t", "/", sessions, seconds)


def order_day(ago, user=1, completed=0, cancelled=0, paid=0.0, lost=0.0):
    day = JOB - timedelta(days=ago)
    return (user, day, f"{day} 08:00:00", completed, cancelled, paid, lost)


def test_horizon_edges(rows):
    days = rows(
        "user_id bigint, activity_date date, n bigint",
        *[(1, JOB - timedelta(days=ago), 10**i) for i, ago in enumerate([0, 1, 6, 7, 29, 30, 400])],
        (1, JOB + timedelta(days=1), 10**9),
    )
    row = horizon_sums(days, ("user_id",), JOB, {"n": F.col("n")}).head()
    assert (row.n_1d, row.n_7d, row.n_30d, row.n_total) == (1, 111, 11111, 1111111)


def test_outside_all_horizons_is_zero_not_null(rows):
    row = user_event_agg(rows(EVENT_DAY, event_day(31, events=4)), JOB).head()
    assert (row.events_1d, row.events_7d, row.events_30d, row.events_total) == (0, 0, 0, 4)


def test_favourite_falls_back_to_total_then_name(rows):
    daily = rows(
        EVENT_DAY,
        event_day(0, source="Email", sessions=1),
        event_day(3, source="Search", sessions=5),
        event_day(40, source="Organic", sessions=9),
        event_day(40, user=2, source="Search", sessions=2),
        event_day(40, user=2, source="Display", sessions=2),
    )
    stats = traffic_source_stats(daily, JOB)
    got = {r.user_id: tuple(r)[1:] for r in most_popular_sources(stats).collect()}
    assert got == {1: ("Email", "Search", "Search", "Organic"), 2: ("Display",) * 4}
    ranks = {
        (r.user_id, r.traffic_source): tuple(r)[2:] for r in traffic_source_rankings(stats).collect()
    }
    assert ranks[1, "Organic"] == (2, 3, 3, 1)
    assert ranks[2, "Display"] == (1, 1, 1, 1) and ranks[2, "Search"] == (2, 2, 2, 2)


def test_favourites_use_no_window(rows):
    plan = user_event_features(rows(EVENT_DAY), JOB)._jdf.queryExecution().executedPlan()
    assert "Window" not in plan.toString()


def test_three_kinds_of_users(rows):
    events = rows(EVENT_DAY, event_day(0, user=1), event_day(2, user=2))
    orders = rows(
        ORDER_DAY,
        order_day(1, user=1, completed=4, paid=10.0),
        order_day(1, user=3, cancelled=1, lost=3.0),
    )
    got = {r.user_id: r for r in behavior_features(events, orders, JOB).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].events_total, got[1].completed_orders_7d) == (1, 4)
    assert got[1].avg_completed_order_amount_7d == 2.5
    assert got[1].avg_completed_order_amount_1d is None
    assert got[1].avg_cancelled_order_amount_total is None
    assert got[2].completed_orders_total is None and got[2].days_since_last_order is None
    assert got[3].events_total is None and got[3].most_popular_traffic_source_7d is None
    assert got[3].avg_cancelled_order_amount_30d == 3.0
    assert [got[u].is_churned for u in (1, 2, 3)] == [False, False, False]


@pytest.mark.parametrize(("ago", "churned"), [(90, False), (91, True)])
def test_churn_edge(rows, ago, churned):
    row = behavior_features(rows(EVENT_DAY, event_day(ago)), rows(ORDER_DAY), JOB).head()
    assert (row.days_since_last_event, row.is_churned) == (ago, churned)


def test_columns_and_their_order(rows):
    horizons = ("1d", "7d", "30d", "total")
    want = ["user_id", "last_event_time", "days_since_last_event"]
    want += [f"events_{h}" for h in horizons]
    want += [f"total_session_duration_{h}" for h in horizons]
    want += [f"most_popular_traffic_source_{h}" for h in horizons[1:]]
    want += ["last_order_time", "days_since_last_order"]
    for metric in (
        "completed_orders",
        "cancelled_orders",
        "total_completed_amount",
        "total_cancelled_amount",
        "avg_completed_order_amount",
        "avg_cancelled_order_amount",
    ):
        want += [f"{metric}_{h}" for h in horizons]
    want.append("is_churned")
    assert behavior_features(rows(EVENT_DAY), rows(ORDER_DAY), JOB).columns == want
    assert len(want) == 41


def test_wider_horizons_hold_narrower_ones(spark):
    import __spark_entry__ as spark_entry

    features = spark_entry.entry(spark)
    for metric in ("events", "total_session_duration", "completed_orders", "total_cancelled_amount"):
        a, b, c, d = (F.col(f"{metric}_{h}") for h in ("1d", "7d", "30d", "total"))
        assert features.where((a > b) | (b > c) | (c > d)).count() == 0
