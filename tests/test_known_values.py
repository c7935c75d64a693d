"""Regression values of FIXTURES.md, at sf0.01."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import sample_data
from footfall.operators.events import as_joined_per_event, daily_user_events, session_durations
from footfall.operators.features import behavior_features, user_order_agg
from footfall.operators.orders import daily_user_orders

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return sample_data.events(spark, SF_DIR)


@pytest.fixture(scope="module")
def daily_events(events):
    return daily_user_events(events).cache()


@pytest.fixture(scope="module")
def orders(spark):
    return sample_data.orders(spark, SF_DIR)


@pytest.fixture(scope="module")
def daily_orders(spark, orders):
    same = F.when(F.col("order_id") % 3 == 1, F.col("status")).otherwise("Processing")
    previous = orders.where("order_id % 3 <> 2").select("order_id", same.alias("status"))
    items = sample_data.order_items(spark, SF_DIR)
    return daily_user_orders(orders, previous, items).cache()


def sums(df, *columns):
    return tuple(df.agg(*[F.sum(c) for c in columns]).head())


def test_events(events, daily_events):
    assert events.count() == 10_000
    assert events.select("session_id").distinct().count() == 7_677
    assert session_durations(events).count() == 7_677
    assert daily_events.count() == 6_057
    assert daily_events.where("session_count > 1").count() == 1_620
    metrics = ("event_count", "total_session_duration")
    assert sums(daily_events, *metrics) == (10_000, 15_198_516)
    assert sums(as_joined_per_event(daily_events), *metrics) == (14_228, 43_287_879)


def test_orders(spark, orders, daily_orders):
    count = {r.status: r["count"] for r in orders.groupBy("status").count().collect()}
    assert count == {"Completed": 4_933, "Cancelled": 5_088, "Processing": 4_979}
    assert orders.where("returned_at is not null").count() == 482
    items = sample_data.order_items(spark, SF_DIR)
    assert items.select("order_id").distinct().count() == 14_743
    assert daily_orders.count() == 14_964
    counts = sums(daily_orders, "completed_order_count", "cancelled_order_count")
    assert counts == (3_271, 3_383)


@pytest.mark.parametrize(
    ("job_date", "want"),
    [(date(2024, 1, 25), (2, 11, 47, 3_257)), (date(2024, 2, 3), (1, 11, 44, 3_271))],
)
def test_completed_over_horizons(daily_orders, job_date, want):
    columns = [f"completed_orders_{h}" for h in ("1d", "7d", "30d", "total")]
    assert sums(user_order_agg(daily_orders, job_date), *columns) == want


def test_kinds_of_users(daily_events, daily_orders):
    features = behavior_features(daily_events, daily_orders, date(2024, 2, 3))
    only_orders, only_events = "events_total is null", "completed_orders_total is null"
    assert features.count() == 1_575
    assert features.where(only_orders).count() == 1_425
    assert features.where(only_events).count() == 75
