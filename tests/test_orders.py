from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException

from footfall.operators.orders import daily_user_orders, order_amounts, status_transitions

ORDER = (
    "order_id bigint, user_id bigint, status string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)
STATE = "order_id bigint, status string"
ITEM = "order_id bigint, sale_price double"


def order(number, status, user=1, updated="2024-01-02 05:00:00"):
    return (number, user, status, "2024-01-01 00:00:00", updated)


@pytest.mark.parametrize(
    ("now", "before", "completed", "cancelled"),
    [
        ("Completed", None, True, False),
        ("Completed", "Processing", True, False),
        ("Completed", "Completed", False, False),
        ("Completed", "Cancelled", True, False),
        ("Cancelled", "Completed", False, True),
        ("Cancelled", "Cancelled", False, False),
        ("Processing", "Completed", False, False),
        (None, None, False, False),
    ],
)
def test_transition(rows, now, before, completed, cancelled):
    previous = rows(STATE, (1, before)) if before else rows(STATE)
    row = status_transitions(rows(ORDER, order(1, now)), previous).head()
    assert (row.became_completed, row.became_cancelled) == (completed, cancelled)


def test_day_sums_transitions_only(rows):
    orders = rows(
        ORDER,
        order(1, "Completed"),
        order(2, "Completed"),
        order(3, "Cancelled"),
        order(4, "Processing"),
        order(5, "Completed", updated="2024-01-03 00:00:00"),
    )
    items = rows(ITEM, (1, 0.1), (1, 0.2), (2, 5), (3, 7.25), (4, 100), (5, 1))
    got = {
        r.activity_date: tuple(r)[2:]
        for r in daily_user_orders(orders, rows(STATE, (2, "Completed")), items).collect()
    }
    start = datetime(2024, 1, 1)
    assert got == {
        date(2024, 1, 2): (start, 1, 1, 0.3, 7.25),
        date(2024, 1, 3): (start, 1, 0, 1.0, 0.0),
    }


def test_order_without_items_is_worth_nothing(rows):
    row = daily_user_orders(rows(ORDER, order(1, "Completed")), rows(STATE), rows(ITEM)).head()
    assert (row.completed_order_count, row.total_completed_order_amount) == (1, 0.0)


def test_amount_does_not_depend_on_row_order(rows):
    prices = [0.1, 0.2, 0.3, 1e9, -1e9, 0.0001]
    forward = order_amounts(rows(ITEM, *[(1, p) for p in prices])).head()
    backward = order_amounts(rows(ITEM, *[(1, p) for p in reversed(prices)])).head()
    assert forward.order_amount == backward.order_amount == 0.6001


def test_an_order_whose_items_span_two_users_counts_once(rows):
    items = rows("order_id bigint, user_id bigint, sale_price double", (1, 1, 2.0), (1, 2, 3.0))
    row = daily_user_orders(rows(ORDER, order(1, "Completed")), rows(STATE), items).head()
    assert (row.completed_order_count, row.total_completed_order_amount) == (1, 5.0)


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_large_sums_are_exact(spark, rows, ansi):
    (row,) = order_amounts(rows(ITEM, (1, 5e14), (1, 6e14), (1, 0.25))).collect()
    assert row.order_amount == 1.1e15 + 0.25
    items = rows(ITEM, (1, 9e19), (1, 9e19))
    assert order_amounts(items).head().order_amount == 1.8e20
    completed = rows(ORDER, order(1, "Completed"))
    day = daily_user_orders(completed, rows(STATE), items).head()
    assert day.total_completed_order_amount == 1.8e20


@pytest.mark.parametrize("price", [1e21, float("nan"), float("inf")])
def test_prices_beyond_the_range_stop_the_job(spark, rows, ansi, price):
    with pytest.raises(PySparkException, match="not an amount of money"):
        order_amounts(rows(ITEM, (1, price))).collect()


def test_orders_without_prices_have_no_amount(rows):
    assert order_amounts(rows(ITEM, (1, None))).head().order_amount is None
