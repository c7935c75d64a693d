"""Order roll-ups: order values, status transitions, days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.money import amount, exact, settled, total, where
from footfall.functions.status import CANCELLED, COMPLETED, became
from footfall.functions.time import activity_day

# What the daily roll-up reads of an order.
ORDER_COLUMNS = ("order_id", "user_id", "status", "created_at", "updated_at")


def order_values(order_items: DataFrame) -> DataFrame:
    """The exact value of each order."""
    value = exact(F.col("sale_price"))
    halves = order_items.select("order_id", value["high"].alias("high"), value["low"].alias("low"))
    summed = settled(F.try_sum("high"), F.try_sum("low"), F.count("low"))
    return halves.groupBy("order_id").agg(summed.alias("order_value"))


def order_amounts(order_items: DataFrame) -> DataFrame:
    """Value of each order: the sum of all its items."""
    return order_values(order_items).select(
        "order_id", amount(F.col("order_value")).alias("order_amount")
    )


def status_transitions(orders: DataFrame, previous: DataFrame) -> DataFrame:
    """Orders with their status before the batch and the two transition flags.

    ``previous`` holds at most one state per order (see ``history.as_of``).
    """
    before = previous.select("order_id", F.col("status").alias("previous_status"))
    status, prev = F.col("status"), F.col("previous_status")
    return orders.join(before, "order_id", "left").withColumns(
        {
            "became_completed": F.coalesce(became(status, prev, COMPLETED), F.lit(False)),
            "became_cancelled": F.coalesce(became(status, prev, CANCELLED), F.lit(False)),
        }
    )


def daily_user_orders(
    orders: DataFrame, previous: DataFrame, order_items: DataFrame
) -> DataFrame:
    """One row per user and day of the orders' latest update.

    Items are summed per order before the join, so both joins meet at most one
    row per order and everything is placed by ``order_id`` once. An order without
    items is worth 0.

    The day of an order is the day of its *latest* change. A later change adds to
    the later day and takes nothing back from the earlier one, so a sequence of
    daily runs and one run over everything differ by design.
    """
    return daily_user_orders_at(orders, previous, order_values(order_items))


def daily_user_orders_at(
    orders: DataFrame, previous: DataFrame, values: DataFrame
) -> DataFrame:
    """``daily_user_orders`` with the values of orders given, one row per order at most."""
    transitions = status_transitions(orders.select(*ORDER_COLUMNS), previous)

    def count(flag: str):
        return F.sum(F.col(flag).cast("long"))

    def worth(flag: str):
        return amount(total(where(F.col(flag), F.col("order_value"))))

    return (
        transitions.join(values, "order_id", "left")
        .groupBy("user_id", activity_day(F.col("updated_at")).alias("activity_date"))
        .agg(
            F.max("created_at").alias("last_order_time"),
            count("became_completed").alias("completed_order_count"),
            count("became_cancelled").alias("cancelled_order_count"),
            worth("became_completed").alias("total_completed_order_amount"),
            worth("became_cancelled").alias("total_cancelled_order_amount"),
        )
    )
