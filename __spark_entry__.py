"""Registered queries over the test tables, and the SQL that checks each of them."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date, datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
import sample_data  # noqa: E402
from footfall import RunParams, Sources, Targets, run_daily  # noqa: E402
from footfall.functions.ids import as_text, last_text  # noqa: E402
from footfall.functions.money import amount  # noqa: E402
from footfall.functions.time import ntz  # noqa: E402
from footfall.operators.batch import batch_filter  # noqa: E402
from footfall.operators.events import (  # noqa: E402
    DAY_KEYS,
    as_joined_per_event,
    daily_user_events,
    last_event_per_user_day,
    session_durations,
)
from footfall.operators.features import (  # noqa: E402
    avg_order_amounts,
    behavior_features,
    churn_flag,
    most_popular_sources,
    traffic_source_rankings,
    traffic_source_stats,
    user_event_agg,
    user_order_agg,
)
from footfall.operators.history import (  # noqa: E402
    as_of,
    as_of_join,
    first_versions,
    merge_versions,
)
from footfall.operators.history_ranges import as_of_join_by_ranges  # noqa: E402
from footfall.operators.horizons import horizon_sums, names  # noqa: E402
from footfall.operators.orders import (  # noqa: E402
    daily_user_orders,
    order_amounts,
    status_transitions,
)
from footfall.plans import order_values  # noqa: E402
from footfall.plans.daily import EVENT_LAYOUT, ORDER_KEYS, ORDER_LAYOUT, STEPS  # noqa: E402
from footfall.plans.late import run_with_late  # noqa: E402
from footfall.sources.csv import ingest, write_table  # noqa: E402
from footfall.sources.registry import stg_users as stg_users_model  # noqa: E402
from footfall.sources.schemas import TABLES  # noqa: E402
from footfall.storage import files  # noqa: E402
from footfall.storage.files import shared_folder  # noqa: E402
from footfall.storage.history import read_history, update_snapshot  # noqa: E402
from footfall.storage.tables import (  # noqa: E402
    create_if_absent,
    incremental_replace,
    read_partitioned,
)
from footfall.streaming.loads import load_stream  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# 25 January: the job date cuts real rows off. 3 February: no event in the last day, so
# favourites fall back to totals. 29 April: last events lie 90 and 91 days back.
JOB_DATE = date(2024, 1, 25)
LATE_JOB_DATE = date(2024, 2, 3)
CHURN_JOB_DATE = date(2024, 4, 29)

# The order table as it stood then is "the state before".
BEFORE = datetime(2021, 1, 1)
LOAD_TS = datetime(2024, 2, 1)
CHECK = ("status", "updated_at")

_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Registers a query under its own name, with its check."""

    def register(function: Query) -> Query:
        _queries[function.__name__] = function
        _oracle[function.__name__] = sql
        return function

    return register


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_user_events(sample_data.events(spark, sf_dir))


def _daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_user_orders(
        sample_data.orders(spark, sf_dir),
        sample_data.orders_at(spark, sf_dir, BEFORE),
        sample_data.order_items(spark, sf_dir),
    )


# --- loads -----------------------------------------------------------------------------


def _load(name: str, rows: DataFrame, target: str, mode: str = "append") -> None:
    """Writes rows as CSV and loads that."""
    spark = rows.sparkSession
    path = shared_folder(spark)
    sample_data.write_csv(rows, path)
    ingest(spark, name, path, target, LOAD_TS, mode)


def _register_ingest(name: str, effective: str) -> None:
    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = shared_folder(spark)
        _load(name, sample_data.read(spark, sf_dir, sample_data.RAW[name]), target)
        return Sources(spark, {name: target}).logical(name)

    load.__name__ = f"ingest_{name}"
    query(oracle.raw_table(name, LOAD_TS, effective))(load)


for _name, _effective in {
    "users": oracle.at(LOAD_TS),
    "orders": "updated_at",
    "order_items": "created_at",
    "events": "created_at",
    "products": oracle.at(LOAD_TS),
    "distribution_centers": oracle.at(LOAD_TS),
    "inventory_items": "created_at",
}.items():
    _register_ingest(_name, _effective)


@query(sample_data.check_sql(sample_data.USERS))
def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = sample_data.read(spark, sf_dir, sample_data.USERS)
    return stg_users_model(Sources(spark, {"users": users}))


@query(sample_data.check_sql(sample_data.DISTRIBUTION_CENTERS))
def create_if_absent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first write stays; a second one, of other rows, does nothing."""
    path = shared_folder(spark)
    centers = sample_data.read(spark, sf_dir, sample_data.DISTRIBUTION_CENTERS)
    create_if_absent(centers, path)
    create_if_absent(centers.withColumn("id", F.col("id") + 1), path)
    return spark.read.schema(centers.schema).parquet(path)


@query(oracle.raw_table("events", LOAD_TS, "created_at"))
def partitioned_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    events = sample_data.read(spark, sf_dir, sample_data.FULL_EVENTS).withColumns(
        {"sys_effective_date": F.col("created_at"), "sys_create_date": ntz(LOAD_TS)}
    )
    write_table(events, "events", path)
    return Sources(spark, {"events": path}).logical("events")


# --- events ----------------------------------------------------------------------------

_WEEK = RunParams(datetime(2024, 1, 10), datetime(2024, 1, 17), date(2024, 1, 16))


@query(
    f"""SELECT * FROM ({oracle.EV}) e
    WHERE created_at >= {oracle.at(_WEEK.start)} AND created_at < {oracle.at(_WEEK.end)}"""
)
def batch_filter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_filter(sample_data.events(spark, sf_dir), "created_at", _WEEK)


@query(oracle.with_parts(oracle.sessions(), ev=oracle.EV))
def session_durations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_durations(sample_data.events(spark, sf_dir))


@query(oracle.with_parts(oracle.daily_events(), ev=oracle.EV))
def daily_user_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_events(spark, sf_dir)


@query(oracle.with_parts(oracle.daily_events_joined(), ev=oracle.EV))
def daily_user_events_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_joined_per_event(_daily_events(spark, sf_dir))


@query(
    oracle.with_parts(
        """SELECT user_id, activity_date, created_at AS last_event_time,
          event_type AS last_event_type, uri AS last_event_uri
        FROM (SELECT *, CAST(created_at AS date) AS activity_date, row_number() OVER (
            PARTITION BY user_id, CAST(created_at AS date)
            ORDER BY created_at DESC, sequence_number DESC, id DESC) AS rn FROM ev) r
        WHERE rn = 1""",
        ev=oracle.EV,
    )
)
def last_event_per_user_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_event_per_user_day(sample_data.events(spark, sf_dir))


_RERUN = RunParams(datetime(2024, 1, 15), datetime(2024, 1, 18), date(2024, 1, 17))


@query(
    oracle.with_parts(
        oracle.replaced("ed", "fresh", oracle.DAY_KEYS),
        ev=oracle.EV,
        ed=oracle.daily_events(),
        corrected=f"""SELECT * FROM ev WHERE event_type <> 'error'
          AND created_at >= {oracle.at(_RERUN.start)} AND created_at < {oracle.at(_RERUN.end)}""",
        fresh=oracle.daily_events("corrected"),
    )
)
def incremental_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days run again after error events were withdrawn from the source."""
    path = shared_folder(spark)
    events = sample_data.events(spark, sf_dir)
    full = daily_user_events(events)
    incremental_replace(spark, full, path, DAY_KEYS, EVENT_LAYOUT)
    corrected = batch_filter(events.where("event_type <> 'error'"), "created_at", _RERUN)
    incremental_replace(spark, daily_user_events(corrected), path, DAY_KEYS, EVENT_LAYOUT)
    return read_partitioned(spark, path, full.schema)


# --- orders ----------------------------------------------------------------------------


@query(
    oracle.with_parts(
        "SELECT order_id, CAST(sum(CAST(sale_price AS decimal(18,4))) AS double) AS order_amount"
        " FROM items GROUP BY order_id",
        items=oracle.ITEMS,
    )
)
def order_amounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_amounts(sample_data.order_items(spark, sf_dir))


@query(
    oracle.with_parts(
        """SELECT o.order_id, o.status, p.status AS previous_status,
          o.status = 'Completed' AND p.status IS DISTINCT FROM 'Completed' AS became_completed,
          o.status = 'Cancelled' AND p.status IS DISTINCT FROM 'Cancelled' AS became_cancelled
        FROM ord o LEFT JOIN prev p ON o.order_id = p.order_id""",
        ord=oracle.ORD,
        prev=oracle.orders_state(BEFORE),
    )
)
def status_transitions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample_data.orders(spark, sf_dir)
    previous = sample_data.orders_at(spark, sf_dir, BEFORE)
    return status_transitions(orders, previous).select(
        "order_id", "status", "previous_status", "became_completed", "became_cancelled"
    )


@query(oracle.user_orders("SELECT * FROM od", BEFORE))
def daily_user_orders_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_orders(spark, sf_dir)


_OVERLAP = RunParams(datetime(2024, 1, 18), datetime(2024, 1, 25), date(2024, 1, 24))
_FIRST_RUN = datetime(2024, 1, 20)


@query(
    oracle.with_parts(
        oracle.replaced("od", "fresh", "user_id, activity_date"),
        ord=oracle.ORD,
        items=oracle.ITEMS,
        first_orders=oracle.orders_state(_FIRST_RUN),
        nothing="SELECT order_id, status FROM first_orders WHERE FALSE",
        od=oracle.daily_orders("first_orders", "nothing"),
        prev=oracle.orders_state(_OVERLAP.start),
        batch=f"""SELECT * FROM ord WHERE updated_at >= {oracle.at(_OVERLAP.start)}
          AND updated_at < {oracle.at(_OVERLAP.end)}""",
        fresh=oracle.daily_orders("batch", "prev"),
    )
)
def incremental_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over the orders up to a day, then a batch that overlaps it."""
    path = shared_folder(spark)
    items = sample_data.order_items(spark, sf_dir)
    first = sample_data.orders_at(spark, sf_dir, _FIRST_RUN)
    full = daily_user_orders(first, first.where(F.lit(False)), items)
    incremental_replace(spark, full, path, ORDER_KEYS, ORDER_LAYOUT)
    batch = daily_user_orders(
        batch_filter(sample_data.orders(spark, sf_dir), "updated_at", _OVERLAP),
        sample_data.orders_at(spark, sf_dir, _OVERLAP.start),
        items,
    )
    incremental_replace(spark, batch, path, ORDER_KEYS, ORDER_LAYOUT)
    return read_partitioned(spark, path, full.schema)


# --- history ---------------------------------------------------------------------------

# The last state lacks orders cancelled before 2020: their versions must stay open.
_RUNS = (datetime(2019, 1, 1), datetime(2021, 1, 1), datetime(2024, 2, 1))
_PURGED = "status = 'Cancelled' AND updated_at < CAST('2020-01-01 00:00:00' AS {ntz})"
_KEPT_ORDERS = f"SELECT * FROM ({sample_data.ORDERS}) p WHERE NOT ({_PURGED})"


def _states(spark: SparkSession, sf_dir: str) -> dict[datetime, DataFrame]:
    return {
        _RUNS[0]: sample_data.orders_at(spark, sf_dir, _RUNS[0]),
        _RUNS[1]: sample_data.orders_at(spark, sf_dir, _RUNS[1]),
        _RUNS[2]: sample_data.read(spark, sf_dir, _KEPT_ORDERS),
    }


_HISTORY_SQL = oracle.history(
    {
        _RUNS[0]: oracle.orders_state(_RUNS[0]),
        _RUNS[1]: oracle.orders_state(_RUNS[1]),
        _RUNS[2]: sample_data.check_sql(_KEPT_ORDERS),
    }
)


def _merged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _states(spark, sf_dir)
    history = first_versions(states[_RUNS[0]], "order_id", _RUNS[0])
    for run in _RUNS[1:]:
        history = merge_versions(history, states[run], "order_id", CHECK, run)
    return history


@query(_HISTORY_SQL)
def orders_snapshot_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four recorded runs; the last one sees nothing new."""
    path = shared_folder(spark)
    states = _states(spark, sf_dir)
    states[_RUNS[-1] + timedelta(days=1)] = states[_RUNS[-1]]
    for run, state in states.items():
        update_snapshot(
            spark, state, path, "order_id", CHECK, run_ts=run, month_of="created_at"
        )
    return read_history(spark, path, states[_RUNS[0]].schema)


@query(_HISTORY_SQL)
def orders_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history as one lazy DataFrame, without a table."""
    return _merged_history(spark, sf_dir)


_AS_OF = datetime(2022, 6, 1)


@query(
    f"""SELECT order_id, status, updated_at, valid_from, valid_to FROM ({_HISTORY_SQL}) h
    WHERE valid_from <= {oracle.at(_AS_OF)}
      AND (valid_to > {oracle.at(_AS_OF)} OR valid_to IS NULL)"""
)
def orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(_merged_history(spark, sf_dir), _AS_OF).select(
        "order_id", "status", "updated_at", "valid_from", "valid_to"
    )


@query(
    f"""SELECT i.order_id, product_id, sale_price, moment, h.status AS status_as_of,
      h.valid_from AS valid_from_as_of
    FROM ({oracle.ITEMS}) i LEFT JOIN ({_HISTORY_SQL}) h
    ON i.order_id = h.order_id AND valid_from <= moment
      AND (moment < valid_to OR valid_to IS NULL)"""
)
def orders_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order item with the recorded status of its order when the item shipped."""
    return as_of_join(
        sample_data.order_items(spark, sf_dir),
        _merged_history(spark, sf_dir),
        "order_id",
        "moment",
        ("status", "valid_from"),
    )


# --- features --------------------------------------------------------------------------


@query(
    oracle.user_events(
        f"""SELECT * FROM ({oracle.source_stats(JOB_DATE)}) s
        JOIN (SELECT user_id, traffic_source,
            {oracle.horizons(JOB_DATE, "events", "event_count")},
            {oracle.horizons(JOB_DATE, "duration", "total_session_duration")}
          FROM ed WHERE activity_date <= DATE '{JOB_DATE}' GROUP BY 1, 2) e
        USING (user_id, traffic_source)"""
    )
)
def horizon_sums_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {
        "sessions": F.col("session_count"),
        "events": F.col("event_count"),
        "duration": F.col("total_session_duration"),
    }
    daily = _daily_events(spark, sf_dir)
    return horizon_sums(daily, ("user_id", "traffic_source"), JOB_DATE, metrics)


@query(
    oracle.user_orders(
        f"""SELECT user_id, {oracle.horizons(JOB_DATE, "completed", "completed_order_count")},
          {oracle.horizons(JOB_DATE, "cancelled", "cancelled_order_count")}
        FROM od WHERE activity_date <= DATE '{JOB_DATE}' GROUP BY user_id""",
        BEFORE,
    )
)
def horizon_sums_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {
        "completed": F.col("completed_order_count"),
        "cancelled": F.col("cancelled_order_count"),
    }
    return horizon_sums(_daily_orders(spark, sf_dir), ("user_id",), JOB_DATE, metrics)


@query(oracle.user_events(oracle.source_stats(JOB_DATE)))
def traffic_source_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_source_stats(_daily_events(spark, sf_dir), JOB_DATE)


@query(oracle.user_events(oracle.source_rankings(oracle.source_stats(JOB_DATE))))
def traffic_source_rankings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_source_rankings(traffic_source_stats(_daily_events(spark, sf_dir), JOB_DATE))


@query(oracle.user_events(oracle.popular(oracle.source_stats(JOB_DATE))))
def most_popular_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_popular_sources(traffic_source_stats(_daily_events(spark, sf_dir), JOB_DATE))


@query(oracle.user_events(oracle.popular(oracle.source_stats(LATE_JOB_DATE))))
def most_popular_sources_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = traffic_source_stats(_daily_events(spark, sf_dir), LATE_JOB_DATE)
    return most_popular_sources(stats)


@query(oracle.user_events(oracle.event_agg(JOB_DATE)))
def user_event_agg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_event_agg(_daily_events(spark, sf_dir), JOB_DATE)


@query(oracle.user_orders(oracle.order_agg(JOB_DATE), BEFORE))
def user_order_agg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_order_agg(_daily_orders(spark, sf_dir), JOB_DATE)


@query(
    oracle.user_orders(
        f"SELECT user_id, {oracle.averages()} FROM ({oracle.order_agg(JOB_DATE)}) a", BEFORE
    )
)
def avg_order_amounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = user_order_agg(_daily_orders(spark, sf_dir), JOB_DATE)
    averages = [*names("avg_completed_order_amount"), *names("avg_cancelled_order_amount")]
    return avg_order_amounts(orders).select("user_id", *averages)


@query(
    oracle.user_events(
        f"""SELECT user_id, last_event_time, days_since_last_event,
          days_since_last_event > 90 AS is_churned
        FROM (SELECT user_id, max(last_event_time) AS last_event_time, date_diff('day',
            CAST(max(last_event_time) AS date), DATE '{CHURN_JOB_DATE}') AS days_since_last_event
          FROM ed WHERE activity_date <= DATE '{CHURN_JOB_DATE}' GROUP BY user_id) u"""
    )
)
def churn_flag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = user_event_agg(_daily_events(spark, sf_dir), CHURN_JOB_DATE)
    return churn_flag(events, CHURN_JOB_DATE).select(
        "user_id", "last_event_time", "days_since_last_event", "is_churned"
    )


def _features(spark: SparkSession, sf_dir: str, job_date: date) -> DataFrame:
    return behavior_features(
        _daily_events(spark, sf_dir), _daily_orders(spark, sf_dir), job_date
    )


@query(oracle.user_both(oracle.features(JOB_DATE), BEFORE))
def behavior_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, JOB_DATE)


@query(oracle.user_both(oracle.features(LATE_JOB_DATE), BEFORE))
def behavior_features_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, LATE_JOB_DATE)


_DAYS = (date(2024, 1, 24), date(2024, 1, 25), date(2024, 1, 26))


def _daily_run_sql(days: tuple[date, ...] = _DAYS, **events: str) -> str:
    """The first run takes all orders and knows no state before; later runs take a day each."""
    runs = [RunParams.for_day(day) for day in days]
    parts = {
        "ev": f"SELECT * FROM ({oracle.EV}) e WHERE created_at < {oracle.at(runs[-1].end)}",
        **(events or {"ed": oracle.daily_events()}),
        "items": oracle.ITEMS,
    }
    daily = []
    for i, run in enumerate(runs):
        parts[f"state{i}"] = oracle.orders_state(run.end)
        if i == 0:
            parts["none_before"] = "SELECT order_id, status FROM state0 WHERE FALSE"
            daily.append(oracle.daily_orders("state0", "none_before"))
        else:
            parts[f"batch{i}"] = f"""SELECT * FROM state{i}
              WHERE updated_at >= {oracle.at(run.start)} AND updated_at < {oracle.at(run.end)}"""
            daily.append(oracle.daily_orders(f"batch{i}", f"state{i - 1}"))
    parts["od"] = " UNION ALL ".join(f"SELECT * FROM ({sql}) d{i}" for i, sql in enumerate(daily))
    return oracle.with_parts(oracle.features(days[-1]), **parts)


@query(_daily_run_sql())
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily runs, each on the raw tables as they stood at the end of its day."""
    targets = Targets(shared_folder(spark))
    events = sample_data.events(spark, sf_dir)
    for day in _DAYS:
        params = RunParams.for_day(day)
        sources = Sources(
            spark,
            {
                "events": events.where(F.col("created_at") < ntz(params.end)),
                "orders": sample_data.orders_at(spark, sf_dir, params.end),
                "order_items": sample_data.order_items(spark, sf_dir),
            },
        )
        run_daily(spark, sources, targets, params)
    return targets.read(spark, "behavior_features")


def _two_loaded_days(spark: SparkSession, sf_dir: str) -> tuple[Sources, Targets]:
    """Two days from CSV files on: each day's new events and changed orders are loaded and run."""
    names = ("events", "orders", "order_items")
    sources = Sources(spark, {name: shared_folder(spark) for name in names})
    targets = Targets(shared_folder(spark))
    first, second = (RunParams.for_day(day) for day in _DAYS[:2])
    events = sample_data.read(spark, sf_dir, sample_data.FULL_EVENTS)
    items = sample_data.read(spark, sf_dir, sample_data.FULL_ORDER_ITEMS)
    orders = sample_data.orders_at(spark, sf_dir, second.end)

    _load("events", events.where(F.col("created_at") < ntz(first.end)), sources.path("events"))
    _load("orders", sample_data.orders_at(spark, sf_dir, first.end), sources.path("orders"))
    _load("order_items", items, sources.path("order_items"))
    run_daily(spark, sources, targets, first)
    _load("events", batch_filter(events, "created_at", second), sources.path("events"))
    changed = batch_filter(orders, "updated_at", second)
    _load("orders", changed, sources.path("orders"), mode="replace")
    run_daily(spark, sources, targets, second)
    return sources, targets


@query(_daily_run_sql(_DAYS[:2]))
def loaded_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files, stored raw tables and two daily runs on them, the second after a keyed load."""
    return _two_loaded_days(spark, sf_dir)[1].read(spark, "behavior_features")


@query(oracle.orders_state(RunParams.for_day(_DAYS[1]).end))
def orders_loaded_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored orders after the second day's load: each once, in its latest state."""
    sources = Sources(spark, {"orders": shared_folder(spark)})
    first, second = (RunParams.for_day(day) for day in _DAYS[:2])
    _load("orders", sample_data.orders_at(spark, sf_dir, first.end), sources.path("orders"))
    changed = batch_filter(sample_data.orders_at(spark, sf_dir, second.end), "updated_at", second)
    _load("orders", changed, sources.path("orders"), mode="replace")
    return sources.logical("orders").drop("sys_create_date", "sys_effective_date")


@query(
    oracle.with_parts(
        f"""SELECT *, 'int_daily_user_events' AS built FROM ed
        WHERE activity_date <= DATE '{_DAYS[0]}'""",
        ev=oracle.EV,
        ed=oracle.daily_events(),
    )
)
def daily_run_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of one step, and the names of the tables it built."""
    targets, params = Targets(shared_folder(spark)), RunParams.for_day(_DAYS[0])
    events = sample_data.events(spark, sf_dir).where(F.col("created_at") < ntz(params.end))
    steps = ["int_daily_user_events"]
    run_daily(spark, Sources(spark, {"events": events}), targets, params, steps)
    built = [step for step in STEPS if files.exists(spark, targets.path(step))]
    return targets.read(spark, steps[0]).withColumn("built", F.lit(", ".join(built)))


@query(
    oracle.history(
        {
            run: f"""SELECT * EXCLUDE (created_at),
              CASE WHEN order_id % 5 <> 0 THEN created_at END AS created_at
            FROM ({oracle.orders_state(run)}) u"""
            for run in _RUNS
        }
    )
)
def orders_snapshot_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded runs over orders of which a fifth have no creation date, and so no month."""
    path = shared_folder(spark)
    dated = F.when(F.col("order_id") % 5 != 0, F.col("created_at"))
    for run in _RUNS:
        state = sample_data.orders_at(spark, sf_dir, run).withColumn("created_at", dated)
        update_snapshot(
            spark, state, path, "order_id", CHECK, run_ts=run, month_of="created_at"
        )
    return read_history(spark, path, state.schema)


# Far enough on that days leave the window of 30 days, and one of them is replaced.
_MOVING = (date(2024, 2, 10), date(2024, 2, 11), date(2024, 2, 12))
_REPLACED = RunParams.for_day(date(2024, 1, 5))


@query(
    _daily_run_sql(
        _MOVING,
        all_days=oracle.daily_events(),
        corrected=f"""SELECT * FROM ev WHERE event_type <> 'error'
          AND created_at >= {oracle.at(_REPLACED.start)}
          AND created_at < {oracle.at(_REPLACED.end)}""",
        fresh=oracle.daily_events("corrected"),
        ed=oracle.replaced("all_days", "fresh", oracle.DAY_KEYS),
    )
)
def features_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs that carry totals on; then a day that the totals hold runs again, corrected."""
    targets = Targets(shared_folder(spark))
    events = sample_data.events(spark, sf_dir)

    def sources(params: RunParams, rows: DataFrame) -> Sources:
        tables = {
            "events": rows.where(F.col("created_at") < ntz(params.end)),
            "orders": sample_data.orders_at(spark, sf_dir, params.end),
            "order_items": sample_data.order_items(spark, sf_dir),
        }
        return Sources(spark, tables)

    for day in _MOVING:
        params = RunParams.for_day(day)
        run_daily(spark, sources(params, events), targets, params)
    corrected = sources(params, events.where("event_type <> 'error'"))
    run_daily(spark, corrected, targets, _REPLACED, ["int_daily_user_events"])
    run_daily(spark, corrected, targets, params, ["behavior_features"])
    return targets.read(spark, "behavior_features")


# What is loaded a day late: a fortieth of the events and orders of two earlier days.
_LATE_DAYS = (date(2024, 1, 21), date(2024, 1, 14))
_ON_LATE_DAYS = " OR ".join(f"CAST({{0}} AS date) = DATE '{day}'" for day in _LATE_DAYS)
_LATE_EVENTS = f"id % 40 = 0 AND ({_ON_LATE_DAYS.format('created_at')})"
_LATE_ORDERS = f"order_id % 40 < 8 AND ({_ON_LATE_DAYS.format('updated_at')})"


def _late_rows_sql() -> str:
    first, second = (RunParams.for_day(day) for day in _DAYS[:2])
    day_of = "CAST(updated_at AS date)"
    return oracle.with_parts(
        oracle.features(_DAYS[1]),
        ev=f"SELECT * FROM ({oracle.EV}) e WHERE created_at < {oracle.at(second.end)}",
        ed=oracle.daily_events(),
        items=oracle.ITEMS,
        nothing="SELECT order_id, status FROM items, (SELECT '' AS status) s WHERE FALSE",
        state0=f"SELECT * FROM ({oracle.orders_state(first.end)}) o WHERE NOT ({_LATE_ORDERS})",
        state1=oracle.orders_state(second.end),
        od0=oracle.daily_orders("state0", "nothing"),
        late=f"""SELECT * FROM state1 WHERE {day_of} IN (SELECT {day_of} FROM state1
          WHERE {_LATE_ORDERS})""",
        fresh=oracle.daily_orders("late", "nothing"),
        batch=f"""SELECT * FROM state1 WHERE updated_at >= {oracle.at(second.start)}
          AND updated_at < {oracle.at(second.end)}""",
        od1=oracle.daily_orders("batch", "state0"),
        od=f"""SELECT * FROM ({oracle.replaced("od0", "fresh", "user_id, activity_date")}) r
          UNION ALL SELECT * FROM od1""",
    )


@query(_late_rows_sql())
def late_rows_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loaded days; the second load brings events and orders of earlier days as well."""
    names = ("events", "orders", "order_items")
    sources = Sources(spark, {name: shared_folder(spark) for name in names})
    targets = Targets(shared_folder(spark))
    first, second = (RunParams.for_day(day) for day in _DAYS[:2])
    events = sample_data.read(spark, sf_dir, sample_data.FULL_EVENTS)
    items = sample_data.read(spark, sf_dir, sample_data.FULL_ORDER_ITEMS)
    states = [sample_data.orders_at(spark, sf_dir, params.end) for params in (first, second)]
    late = F.expr(_LATE_EVENTS)

    on_time = events.where((F.col("created_at") < ntz(first.end)) & ~late)
    _load("events", on_time, sources.path("events"))
    _load("orders", states[0].where(~F.expr(_LATE_ORDERS)), sources.path("orders"))
    _load("order_items", items, sources.path("order_items"))
    run_with_late(spark, sources, targets, first)

    _load("events", events.where(late), sources.path("events"))
    _load("events", batch_filter(events, "created_at", second), sources.path("events"))
    changed = states[1].where((F.col("updated_at") >= ntz(second.start)) | F.expr(_LATE_ORDERS))
    _load("orders", changed, sources.path("orders"), "replace")
    run_with_late(spark, sources, targets, second)
    run_with_late(spark, sources, targets, second)
    return targets.read(spark, "behavior_features")


_CUT = datetime(2023, 1, 1)


@query(
    oracle.with_parts(
        f"""SELECT order_id, CAST(sum(CAST(CASE
            WHEN id % 50 = 0 AND created_at < {oracle.at(_CUT)} THEN sale_price + 1.5
            ELSE sale_price END AS decimal(18,4))) AS double) AS order_amount
        FROM items GROUP BY order_id""",
        items=sample_data.check_sql(sample_data.FULL_ORDER_ITEMS),
    )
)
def order_values_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values kept up to date over three loads: items, later ones, and changed prices."""
    items, kept = shared_folder(spark), shared_folder(spark)
    rows = sample_data.read(spark, sf_dir, sample_data.FULL_ORDER_ITEMS)
    early = F.col("created_at") < ntz(_CUT)
    dearer = rows.where(early & (F.col("id") % 50 == 0)).withColumn(
        "sale_price", F.col("sale_price") + 1.5
    )
    loads = [(rows.where(early), "append"), (rows.where(~early), "append"), (dearer, "replace")]
    for load, mode in loads:
        _load("order_items", load, items, mode)
        schema = TABLES["order_items"].stored_schema
        order_values.update(spark, items, schema, "created_day", kept, span=100_000)
    return order_values.all_values(spark, kept).select(
        "order_id", amount(F.col("order_value")).alias("order_amount")
    )


_LARGE = 2**64 - 1  # ids are counted down from here


@query(
    oracle.with_parts(
        f"""SELECT CAST({_LARGE}::hugeint - order_id::hugeint AS varchar) AS order_id,
          CAST(sum(CAST(sale_price AS decimal(18,4))) AS double) AS order_amount,
          max(CAST({_LARGE}::hugeint - id::hugeint AS varchar)) AS last_item
        FROM items GROUP BY order_id""",
        items=sample_data.check_sql(sample_data.FULL_ORDER_ITEMS),
    )
)
def largest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the largest ids there are: loaded, summed and joined as longs, told as text."""
    path = shared_folder(spark)
    rows = sample_data.read(spark, sf_dir, sample_data.FULL_ORDER_ITEMS)
    counted_down = {
        name: (F.lit(str(_LARGE)).cast("decimal(20,0)") - F.col(name)).cast("string")
        for name in ("id", "order_id")
    }
    _load("order_items", rows.withColumns(counted_down), path)
    items = Sources(spark, {"order_items": path}).logical("order_items")
    last = last_text(items, "order_id", "id").withColumnRenamed("id", "last_item")
    return as_text(order_amounts(items).join(last, "order_id"), ["order_id"])


@query(_oracle["orders_as_of_join"])
def orders_as_of_join_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_as_of_join`` in ranges that cut through keys."""
    return as_of_join_by_ranges(
        sample_data.order_items(spark, sf_dir),
        _merged_history(spark, sf_dir),
        "order_id",
        "moment",
        ("status", "valid_from"),
        range_rows=10_000,
    )


@query(oracle.orders_state(RunParams.for_day(_DAYS[1]).end))
def orders_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that arrive as files over two days, loaded as a stream that is started twice."""
    folder, target, checkpoint = (shared_folder(spark) for _ in range(3))
    first, second = (RunParams.for_day(day) for day in _DAYS[:2])
    states = [sample_data.orders_at(spark, sf_dir, params.end) for params in (first, second)]
    changed = batch_filter(states[1], "updated_at", second)
    for number, arriving in enumerate((states[0], changed)):
        columns = [*TABLES["orders"].columns]
        sample_data.write_csv(arriving.select(*columns), f"{folder}/day{number}")
        stream = load_stream(spark, "orders", f"{folder}/day*", target, checkpoint, LOAD_TS)
        stream.awaitTermination()
    orders = Sources(spark, {"orders": target}).logical("orders")
    return orders.drop("sys_create_date", "sys_effective_date")


# Training-data operators and their pipeline are optional; the library does without them.
_added: dict[str, Query] = {}
_added_sql: dict[str, str] = {}
try:
    import corpus_pipeline
    from footfall.llm.queries import QUERIES
    from footfall.llm.sql import ORACLE
except ModuleNotFoundError as missing:
    # They are deleted, or a package that only they need is not there.
    if (missing.name or "").startswith("footfall") and "footfall.llm" not in missing.name:
        raise
else:
    _added |= {**QUERIES, "pipeline": corpus_pipeline.run}
    _added_sql |= ORACLE


def _key(name: str) -> str:
    return name.removesuffix("_query")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the behaviour features of every customer at sf0.001."""
    return behavior_features_query(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {_key(name): function for name, function in _queries.items()} | _added


def oracle_sql() -> dict[str, str]:
    return {_key(name): sql for name, sql in _oracle.items()} | _added_sql
