"""SQL that states, in another way, what each registered query must return."""

from __future__ import annotations

from datetime import date, datetime

from sample_data import EVENTS, ORDER_ITEMS, ORDERS, RAW, check_sql, orders_at_sql

DAY_KEYS = "user_id, activity_date, browser, traffic_source"
HORIZONS = ("1d", "7d", "30d", "total")


def with_parts(query: str, **parts: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {body}\n{query}"


def at(moment: datetime) -> str:
    return f"TIMESTAMP '{moment}'"


EV = check_sql(EVENTS)
ORD = check_sql(ORDERS)
ITEMS = check_sql(ORDER_ITEMS)


def sessions(ev: str = "ev") -> str:
    return f"""SELECT user_id, CAST(created_at AS date) AS activity_date, browser, traffic_source,
      session_id, date_diff('second', min(created_at), max(created_at)) AS session_duration
    FROM {ev} GROUP BY 1, 2, 3, 4, 5"""


def daily_events(ev: str = "ev") -> str:
    """Counts, durations and last events found apart and joined per cell."""
    dated = f"SELECT *, CAST(created_at AS date) AS activity_date FROM {ev}"
    return f"""SELECT {DAY_KEYS}, event_count, last_event_time, last_event_type, last_event_uri,
      session_count, total_session_duration
    FROM (SELECT {DAY_KEYS}, count(*) AS event_count, count(DISTINCT session_id) AS session_count
      FROM ({dated}) a GROUP BY {DAY_KEYS}) c
    JOIN (SELECT {DAY_KEYS}, CAST(sum(session_duration) AS bigint) AS total_session_duration
      FROM ({sessions(ev)}) s GROUP BY {DAY_KEYS}) d USING ({DAY_KEYS})
    JOIN (SELECT {DAY_KEYS}, created_at AS last_event_time, event_type AS last_event_type,
        uri AS last_event_uri
      FROM (SELECT *, row_number() OVER (PARTITION BY {DAY_KEYS}
          ORDER BY created_at DESC, sequence_number DESC, id DESC) AS rn FROM ({dated}) b) r
      WHERE rn = 1) l USING ({DAY_KEYS})"""


def daily_events_joined() -> str:
    """Every event joined to every session of its cell."""
    return f"""SELECT {DAY_KEYS}, count(*) AS event_count, max(created_at) AS last_event_time,
      arg_max(event_type, rank) AS last_event_type, arg_max(uri, rank) AS last_event_uri,
      count(DISTINCT e.session_id) AS session_count,
      CAST(sum(session_duration) AS bigint) AS total_session_duration
    FROM (SELECT *, CAST(created_at AS date) AS activity_date,
        row_number() OVER (ORDER BY created_at, sequence_number, id) AS rank FROM ev) e
    LEFT JOIN ({sessions()}) s USING ({DAY_KEYS})
    GROUP BY {DAY_KEYS}"""


AMOUNTS = """SELECT order_id, sum(CAST(sale_price AS decimal(18,4))) AS order_amount
    FROM items GROUP BY order_id"""


def daily_orders(orders: str, previous: str) -> str:
    """Transitions listed one by one, then counted and summed."""
    return f"""SELECT user_id, activity_date, max(created_at) AS last_order_time,
      count(*) FILTER (WHERE entered = 'Completed') AS completed_order_count,
      count(*) FILTER (WHERE entered = 'Cancelled') AS cancelled_order_count,
      CAST(coalesce(sum(order_amount) FILTER (WHERE entered = 'Completed'), 0) AS double)
        AS total_completed_order_amount,
      CAST(coalesce(sum(order_amount) FILTER (WHERE entered = 'Cancelled'), 0) AS double)
        AS total_cancelled_order_amount
    FROM (SELECT o.user_id, CAST(o.updated_at AS date) AS activity_date, o.created_at,
        nullif(o.status, coalesce(p.status, '')) AS entered, a.order_amount
      FROM {orders} o LEFT JOIN {previous} p ON p.order_id = o.order_id
      LEFT JOIN ({AMOUNTS}) a ON a.order_id = o.order_id) t
    GROUP BY user_id, activity_date"""


def horizons(job_date: date, name: str, value: str, kind: str = "bigint") -> str:
    """Sums over the last days up to the job date, told by their first day."""
    return ", ".join(
        f"CAST(coalesce(sum({value}) FILTER (WHERE activity_date > {first}), 0) AS {kind})"
        f" AS {name}_{suffix}"
        for suffix, first in (
            ("1d", f"DATE '{job_date}' - 1"),
            ("7d", f"DATE '{job_date}' - 7"),
            ("30d", f"DATE '{job_date}' - 30"),
            ("total", "DATE '1900-01-01'"),
        )
    )


def source_stats(job_date: date, daily: str = "ed") -> str:
    return f"""SELECT user_id, traffic_source, {horizons(job_date, "sessions", "session_count")}
    FROM {daily} WHERE activity_date <= DATE '{job_date}' GROUP BY 1, 2"""


def source_rankings(stats: str) -> str:
    ranks = ", ".join(
        f"row_number() OVER (PARTITION BY user_id ORDER BY sessions_{s} DESC,"
        f" sessions_total DESC, traffic_source) AS rank_{s}"
        for s in HORIZONS
    )
    return f"SELECT user_id, traffic_source, {ranks} FROM ({stats}) st"


def popular(stats: str) -> str:
    tops = ", ".join(
        f"first(traffic_source ORDER BY sessions_{s} DESC, sessions_total DESC, traffic_source)"
        f" AS most_popular_traffic_source_{s}"
        for s in HORIZONS
    )
    return f"SELECT user_id, {tops} FROM ({stats}) st GROUP BY user_id"


def event_agg(job_date: date, daily: str = "ed") -> str:
    return f"""SELECT user_id, max(last_event_time) AS last_event_time,
      {horizons(job_date, "events", "event_count")},
      {horizons(job_date, "total_session_duration", "total_session_duration")}
    FROM {daily} WHERE activity_date <= DATE '{job_date}' GROUP BY user_id"""


def order_agg(job_date: date, daily: str = "od") -> str:
    def amount(column: str) -> str:
        return f"CAST({column} AS decimal(28,4))"

    completed = amount("total_completed_order_amount")
    cancelled = amount("total_cancelled_order_amount")
    return f"""SELECT user_id, max(last_order_time) AS last_order_time,
      {horizons(job_date, "completed_orders", "completed_order_count")},
      {horizons(job_date, "cancelled_orders", "cancelled_order_count")},
      {horizons(job_date, "total_completed_amount", completed, "double")},
      {horizons(job_date, "total_cancelled_amount", cancelled, "double")}
    FROM {daily} WHERE activity_date <= DATE '{job_date}' GROUP BY user_id"""


def averages() -> str:
    return ", ".join(
        f"total_{kind}_amount_{s} / nullif({kind}_orders_{s}, 0) AS avg_{kind}_order_amount_{s}"
        for kind in ("completed", "cancelled")
        for s in HORIZONS
    )


def features(job_date: date, events: str = "ed", orders: str = "od") -> str:
    def each(name: str, *skip: str) -> str:
        return ", ".join(f"{name}_{s}" for s in HORIZONS if s not in skip)

    day = f"DATE '{job_date}'"
    return f"""SELECT user_id, last_event_time,
      date_diff('day', CAST(last_event_time AS date), {day}) AS days_since_last_event,
      {each("events")}, {each("total_session_duration")},
      {each("most_popular_traffic_source", "1d")},
      last_order_time,
      date_diff('day', CAST(last_order_time AS date), {day}) AS days_since_last_order,
      {each("completed_orders")}, {each("cancelled_orders")},
      {each("total_completed_amount")}, {each("total_cancelled_amount")}, {averages()},
      coalesce(CAST(last_event_time AS date) < {day} - 90, FALSE) AS is_churned
    FROM (SELECT user_id FROM {events} WHERE activity_date <= {day}
      UNION SELECT user_id FROM {orders} WHERE activity_date <= {day}) u
    LEFT JOIN ({event_agg(job_date, events)}) e USING (user_id)
    LEFT JOIN ({popular(source_stats(job_date, events))}) p USING (user_id)
    LEFT JOIN ({order_agg(job_date, orders)}) o USING (user_id)"""


def history(states: dict[datetime, str]) -> str:
    """Versions found by comparing each recorded state of a key with the one before."""
    recorded = " UNION ALL ".join(
        f"SELECT *, {at(run)} AS run FROM ({sql}) s" for run, sql in states.items()
    )
    w = "OVER (PARTITION BY order_id ORDER BY run)"
    changed = f"""SELECT * FROM (SELECT *, lag(run) {w} AS run_before,
        lag(status) {w} AS status_before, lag(updated_at) {w} AS updated_before
      FROM ({recorded}) r) m
      WHERE run_before IS NULL OR status IS DISTINCT FROM status_before
        OR updated_at IS DISTINCT FROM updated_before"""
    return f"""SELECT order_id, user_id, status, gender, created_at, returned_at, shipped_at,
      delivered_at, num_of_item, updated_at,
      md5(CAST(order_id AS varchar) || '|' || CAST(run AS varchar)) AS scd_id,
      run AS meta_updated_at, run AS valid_from, lead(run) {w} AS valid_to
    FROM ({changed}) c"""


def raw_table(name: str, load_ts: datetime, effective: str) -> str:
    return f"""SELECT *, {effective} AS sys_effective_date, {at(load_ts)} AS sys_create_date
    FROM ({check_sql(RAW[name])}) t"""


def replaced(target: str, batch: str, keys: str) -> str:
    names = [key.strip() for key in keys.split(",")]
    same = " AND ".join(f"t.{name} IS NOT DISTINCT FROM b.{name}" for name in names)
    return f"""SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {batch} b WHERE {same})
    UNION ALL SELECT * FROM {batch}"""


def orders_state(moment: datetime) -> str:
    return orders_at_sql(moment)


def user_events(query: str) -> str:
    """A query over daily event rows ``ed``."""
    return with_parts(query, ev=EV, ed=daily_events())


def user_orders(query: str, before: datetime) -> str:
    """A query over daily order rows ``od``, compared with the state at ``before``."""
    return with_parts(
        query,
        ord=ORD,
        items=ITEMS,
        prev=orders_at_sql(before),
        od=daily_orders("ord", "prev"),
    )


def user_both(query: str, before: datetime) -> str:
    return with_parts(
        query,
        ev=EV,
        ed=daily_events(),
        ord=ORD,
        items=ITEMS,
        prev=orders_at_sql(before),
        od=daily_orders("ord", "prev"),
    )


