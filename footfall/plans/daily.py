"""The daily run: record order history, roll up the batch, rebuild the features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from footfall.operators.batch import batch_filter
from footfall.operators.events import DAY_KEYS, daily_user_events
from footfall.operators.features import (
    behavior_features,
    event_totals,
    exact_amounts,
    features_of,
    order_totals,
)
from footfall.operators.history import as_of
from footfall.operators.horizons import HORIZONS
from footfall.operators.orders import ORDER_COLUMNS, daily_user_orders_at, order_values
from footfall.params import RunParams
from footfall.plans import order_values as kept_values
from footfall.plans.carried import Daily, with_totals
from footfall.sources.registry import Sources
from footfall.sources.schemas import TABLES
from footfall.storage import changes, files
from footfall.storage.history import read_any_history, read_history, update_snapshot
from footfall.storage.tables import (
    Layout,
    incremental_replace,
    read_partitioned,
    rebuild_table,
    recover,
)

ORDER_KEYS = ("user_id", "activity_date")
# Orders change far less often than events happen: their daily rows are kept by month.
EVENT_LAYOUT = Layout()
ORDER_LAYOUT = Layout(monthly=True)
STEPS = ("orders_snapshot", "int_daily_user_events", "int_daily_user_orders", "behavior_features")

_STORED = {
    "int_daily_user_events": (
        "user_id bigint, activity_date date, browser string, traffic_source string, "
        "event_count bigint, last_event_time timestamp_ntz, last_event_type string, "
        "last_event_uri string, session_count bigint, total_session_duration bigint"
    ),
    "int_daily_user_orders": (
        "user_id bigint, activity_date date, last_order_time timestamp_ntz, "
        "completed_order_count bigint, cancelled_order_count bigint, "
        "total_completed_order_amount double, total_cancelled_order_amount double"
    ),
}


@dataclass(frozen=True)
class Targets:
    """Where the run keeps its tables, and beside them what it carries from day to day."""

    base: str

    def path(self, step: str) -> str:
        return f"{self.base.rstrip('/')}/{step}"

    def state(self, name: str) -> str:
        return f"{self.base.rstrip('/')}.state/{name}"

    def read(self, spark: SparkSession, step: str) -> DataFrame:
        path = self.path(step)
        if step in _STORED:
            return read_partitioned(spark, path, StructType.fromDDL(_STORED[step]))
        if step == "orders_snapshot":
            return read_any_history(spark, path)
        return spark.read.parquet(path)


def _is_incremental(spark: SparkSession, target: str, full_refresh: bool) -> bool:
    recover(spark, target, 1)
    return not full_refresh and files.exists(spark, target)


def _batch(rows: DataFrame, moment: str, day: str, params: RunParams) -> DataFrame:
    return batch_filter(rows, moment, params, day if day in rows.columns else None)


def _rows_of(df: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``df`` without rows that cannot meet ``batch`` on ``key``.

    ``batch`` is a stored table, whose size Spark knows: keys of a small one go to every
    task, and the rest of ``df`` is dropped before any shuffle.
    """
    return df.join(batch.select(key), key, "left_semi")


def orders_snapshot(
    spark: SparkSession, sources: Sources, targets: Targets, params: RunParams, full_refresh: bool
) -> None:
    """Records the orders as they are at the end of the interval. History is never rebuilt."""
    update_snapshot(
        spark,
        sources.logical("orders"),
        targets.path("orders_snapshot"),
        key="order_id",
        check=("status", "updated_at"),
        run_ts=params.end,
        month_of="created_at",
    )


def int_daily_user_events(
    spark: SparkSession, sources: Sources, targets: Targets, params: RunParams, full_refresh: bool
) -> None:
    path = targets.path("int_daily_user_events")
    events = sources["events"]
    if _is_incremental(spark, path, full_refresh):
        events = _batch(events, "created_at", "created_day", params)
    incremental_replace(
        spark,
        daily_user_events(events),
        path,
        DAY_KEYS,
        EVENT_LAYOUT,
        sort_by=("user_id",),
        full_refresh=full_refresh,
        noted=True,
    )


def int_daily_user_orders(
    spark: SparkSession, sources: Sources, targets: Targets, params: RunParams, full_refresh: bool
) -> None:
    """Compares the batch with the history recorded up to ``params.as_of``."""
    path = targets.path("int_daily_user_orders")
    staged = f"{path}.orders"
    orders = sources["orders"]
    history = read_history(
        spark,
        targets.path("orders_snapshot"),
        sources.logical("orders").schema,
        ended_after=params.as_of,
    )
    previous = as_of(history, params.as_of)
    incremental = _is_incremental(spark, path, full_refresh)
    if incremental:
        # The batch is small beside the tables it meets: write it down, and narrow them.
        batch = _batch(orders, "updated_at", "updated_day", params).select(*ORDER_COLUMNS)
        batch.write.mode("overwrite").parquet(staged)
        orders = spark.read.schema(batch.schema).parquet(staged)
        previous = _rows_of(previous, orders, "order_id")
    values = _values(spark, sources, targets, orders if incremental else None)
    batch = daily_user_orders_at(orders, previous, values)
    incremental_replace(
        spark,
        batch,
        path,
        ORDER_KEYS,
        ORDER_LAYOUT,
        sort_by=("user_id",),
        full_refresh=full_refresh,
        noted=True,
    )
    files.delete(spark, staged)


def _values(
    spark: SparkSession, sources: Sources, targets: Targets, orders: DataFrame | None
) -> DataFrame:
    """Values of ``orders``, or of all: kept ones where changes of the items are known."""
    stored, path = sources.noted("order_items"), targets.state("order_values")
    if stored is None:
        items = sources["order_items"]
        return order_values(items if orders is None else _rows_of(items, orders, "order_id"))
    schema = TABLES["order_items"].stored_schema
    kept_values.update(spark, stored, schema, "created_day", path)
    if orders is None:
        return kept_values.all_values(spark, path)
    return kept_values.values_of(spark, path, orders)


def build_behavior_features(
    spark: SparkSession, sources: Sources, targets: Targets, params: RunParams, full_refresh: bool
) -> None:
    tables = [
        Daily(
            targets.path("int_daily_user_events"),
            lambda names: _stored(spark, targets, "int_daily_user_events", names),
            event_totals,
        ),
        Daily(
            targets.path("int_daily_user_orders"),
            lambda names: exact_amounts(_stored(spark, targets, "int_daily_user_orders", names)),
            order_totals,
        ),
    ]
    if all(changes.are_kept(spark, table.path) for table in tables):
        window = max(h for h in HORIZONS if h is not None)
        rows = [
            with_totals(spark, t, params.job_date, window, targets.state(t.path.split("/")[-1]))
            for t in tables
        ]
        features = features_of(*rows, params.job_date)
    else:
        rows = [targets.read(spark, t.path.split("/")[-1]) for t in tables]
        features = behavior_features(*rows, params.job_date)
    rebuild_table(spark, features, targets.path("behavior_features"))


def _stored(spark: SparkSession, targets: Targets, step: str, names: list[str]) -> DataFrame:
    schema = StructType.fromDDL(_STORED[step])
    return read_partitioned(spark, targets.path(step), schema, only=names)


_RUN = dict(
    zip(
        STEPS,
        (orders_snapshot, int_daily_user_events, int_daily_user_orders, build_behavior_features),
        strict=True,
    )
)


def run_daily(
    spark: SparkSession,
    sources: Sources,
    targets: Targets,
    params: RunParams,
    steps: Sequence[str] = STEPS,
    full_refresh: bool = False,
) -> None:
    """Runs the chosen steps in their fixed order; an error stops the run.

    Each step leaves its table behind, so a failed run can be repeated from the
    step that failed, and a repeated step gives the same table. History only moves
    forward: to process an older interval again, leave ``orders_snapshot`` out. Its
    orders then meet the history as it was at that interval.
    """
    unknown = sorted(set(steps) - set(STEPS))
    if unknown:
        raise ValueError(f"unknown step {', '.join(unknown)}; known: {', '.join(STEPS)}")
    for step in STEPS:
        if step in steps:
            _RUN[step](spark, sources, targets, params, full_refresh)
