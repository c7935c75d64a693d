"""What is carried from run to run: totals, order values, days that gained rows late."""

from __future__ import annotations

import shutil
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sample_data
from footfall import RunParams, Sources, Targets, run_daily
from footfall.functions.money import amount
from footfall.functions.time import ntz
from footfall.operators.batch import batch_filter
from footfall.operators.features import behavior_features
from footfall.operators.orders import order_amounts
from footfall.plans import carried, order_values
from footfall.plans.daily import STEPS
from footfall.plans.late import late_days, run_with_late
from footfall.sources import csv
from footfall.sources.csv import regroup, write_table
from footfall.sources.schemas import TABLES
from footfall.storage import changes, files, grain
from footfall.storage.tables import Layout, incremental_replace, read_partitioned

SF_DIR = "/root/testdata/sf0.001"
ITEM = "id bigint, order_id bigint, sale_price double, created_at timestamp_ntz"
EVENT = (
    "id bigint, user_id bigint, sequence_number bigint, session_id string, "
    "created_at timestamp_ntz, browser string, traffic_source string, uri string, "
    "event_type string"
)
ORDER = (
    "order_id bigint, user_id bigint, status string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)


def content(df):
    return sorted(map(str, df.collect()))


def stored(name, df):
    """Rows with all columns of a raw table, NULL where they are not given."""
    schema = TABLES[name].schema
    given = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def event(number, day, user=1, source="Search"):
    return (number, user, 1, f"s{number}", f"{day} 10:00:00", "Chrome", source, "/", "home")


# --- totals ----------------------------------------------------------------------------


def run(spark, targets, rows, day, steps=STEPS):
    params = RunParams.for_day(day)
    events = rows.where(F.col("created_at") < ntz(params.end))
    tables = {
        "events": events,
        "orders": sample_data.orders_at(spark, SF_DIR, params.end),
        "order_items": sample_data.order_items(spark, SF_DIR),
    }
    run_daily(spark, Sources(spark, tables), targets, params, steps)


def expected(spark, targets, day):
    events, orders = (targets.read(spark, step) for step in STEPS[1:3])
    return content(behavior_features(events, orders, day))


def features(spark, targets):
    return content(targets.read(spark, "behavior_features"))


def test_totals_follow_days_and_corrections(spark, tmp_path):
    targets = Targets(str(tmp_path / "t"))
    events = sample_data.events(spark, SF_DIR)
    days = [date(2024, 2, 7), date(2024, 2, 8), date(2024, 2, 20)]
    for day in days:
        run(spark, targets, events, day)
        assert features(spark, targets) == expected(spark, targets, day)
    step = STEPS[1:2]
    fewer = events.where("id % 3 <> 0 AND event_type <> 'error'")
    more = events.unionByName(events.withColumn("user_id", F.col("user_id") + 7))
    # Days before the window, one of them twice, and one inside it.
    for day, rows in [(3, fewer), (11, more), (3, events), (30, more)]:
        run(spark, targets, rows, date(2024, 1, day), step)
        run(spark, targets, events, days[-1], STEPS[3:])
        assert features(spark, targets) == expected(spark, targets, days[-1])
    # An older job date reads all days, and leaves the totals alone.
    kept = sorted(p.name for p in (tmp_path / "t.state").glob("*/totals/*"))
    run(spark, targets, events, days[0], STEPS[3:])
    assert features(spark, targets) == expected(spark, targets, days[0])
    assert sorted(p.name for p in (tmp_path / "t.state").glob("*/totals/*")) == kept


def test_a_run_reads_the_days_of_its_window(spark, tmp_path):
    """Days that the totals hold are not even opened: they can be gone."""
    targets = Targets(str(tmp_path / "t"))
    events = sample_data.events(spark, SF_DIR)
    run(spark, targets, events, date(2024, 2, 20))
    want = expected(spark, targets, date(2024, 2, 21))
    table = Path(targets.path("int_daily_user_events"))
    for day in range(1, 21):
        folder = table / f"activity_date=2024-01-{day:02}"
        if folder.exists():
            for part in folder.glob("*.parquet"):
                part.write_bytes(b"gone")
    run(spark, targets, events, date(2024, 2, 21), STEPS[3:])
    assert features(spark, targets) == want


def test_totals_of_a_table_that_was_rebuilt(spark, tmp_path, rows):
    targets = Targets(str(tmp_path / "t"))
    events = sample_data.events(spark, SF_DIR)
    day = date(2024, 2, 9)
    run(spark, targets, events, day)
    params = RunParams.for_day(day)
    tables = {"events": events.where("user_id % 40 = 0")}
    run_daily(spark, Sources(spark, tables), targets, params, STEPS[1:2], full_refresh=True)
    run(spark, targets, events, day, STEPS[3:])
    assert features(spark, targets) == expected(spark, targets, day)


def test_tables_from_before_changes_were_noted(spark, tmp_path, items):
    """Notes and totals begin with the next run or load."""
    targets = Targets(str(tmp_path / "t"))
    events = sample_data.events(spark, SF_DIR)
    run(spark, targets, events, date(2024, 2, 9))
    for step in STEPS[1:3]:
        shutil.rmtree(Path(targets.path(step)) / changes.FOLDER)
    shutil.rmtree(tmp_path / "t.state")
    run(spark, targets, events, date(2024, 2, 9), STEPS[3:])
    assert features(spark, targets) == expected(spark, targets, date(2024, 2, 9))
    assert not (tmp_path / "t.state").exists()
    run(spark, targets, events, date(2024, 2, 10))
    assert features(spark, targets) == expected(spark, targets, date(2024, 2, 10))
    assert len(list((tmp_path / "t.state").glob("*/totals/2024-01-11.*"))) == 2

    items((1, 1, 2.5, "2024-01-01"))
    shutil.rmtree(Path(items.path) / changes.FOLDER)
    items((2, 1, 3.5, "2024-01-02"))
    assert kept_values(spark, items, str(tmp_path / "values")) == all_values(spark, items)


def test_months_are_summed_again_one_by_one(spark, tmp_path, rows):
    path, state = str(tmp_path / "d"), str(tmp_path / "state")
    schema = "user_id bigint, n bigint, activity_date date"

    def put(*values):
        df = rows(schema, *values)
        keys = ("user_id", "activity_date")
        incremental_replace(spark, df, path, keys, Layout(), noted=True)

    def read(names):
        return read_partitioned(spark, path, rows(schema).schema, only=names)

    def summed(df, *keys):
        return df.groupBy("user_id", *keys).agg(F.sum("n").alias("n"))

    table = carried.Daily(path, read, summed)

    def totals(day):
        found = carried.totals_through(spark, table, day, state)
        return {r.user_id: r.n for r in found.collect()}

    days = [date(2023, 11, 5) + timedelta(days=9 * i) for i in range(14)]
    put(*[(i % 3, 1, day) for i, day in enumerate(days)])
    assert sum(totals(days[4]).values()) == 5
    assert sum(totals(days[9]).values()) == 10
    put((0, 50, days[0]))
    assert totals(days[9])[0] == 53
    months = sorted(p.name for p in (tmp_path / "state" / "months").glob("month=*"))
    assert months == ["month=202311", "month=202312"]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").glob("months/*/*.parquet")}
    put((2, 70, days[5]))
    assert totals(days[13]) == {0: 54, 1: 5, 2: 73}
    after = set((tmp_path / "state").glob("months/*/*.parquet"))
    same = [p for p in before if p in after]
    assert {p.parent.name for p in same} == {"month=202311"}


# --- order values ----------------------------------------------------------------------


@pytest.fixture
def items(spark, rows, tmp_path):
    path = str(tmp_path / "items")

    def load(*values, mode="append"):
        write_table(stored("order_items", rows(ITEM, *values)), "order_items", path, mode)

    load.path = path
    return load


def kept_values(spark, items, path, span=10):
    schema = TABLES["order_items"].stored_schema
    order_values.update(spark, items.path, schema, "created_day", path, span)
    found = order_values.all_values(spark, path)
    return content(found.select("order_id", amount(F.col("order_value")).alias("order_amount")))


def all_values(spark, items):
    return content(order_amounts(Sources(spark, {"order_items": items.path})["order_items"]))


def test_order_values_follow_their_items(spark, items, tmp_path):
    path = str(tmp_path / "values")
    day = "2024-01-0{} 08:00:00".format
    loads = [
        ([(1, 1, 2.5, day(1)), (2, 1, 0.1, day(1)), (3, 25, 9, day(2))], "append"),
        ([(4, 1, 1.0, day(3)), (5, 30, 2.0, day(3)), (6, 31, None, day(3))], "append"),
        # A price changes; an item goes to another order, and to another day.
        ([(2, 1, 0.2, day(1)), (3, 26, 9, day(4))], "replace"),
        ([(5, 30, 2.0, day(3))], "replace"),
        ([(9, 9, 9.0, day(9))], "overwrite"),
    ]
    for values, mode in loads:
        items(*values, mode=mode)
        assert kept_values(spark, items, path) == all_values(spark, items)
        assert kept_values(spark, items, path) == all_values(spark, items)
    assert kept_values(spark, items, path) == ["Row(order_id=9, order_amount=9.0)"]


def test_only_the_ranges_of_a_batch_are_read(spark, items, rows, tmp_path):
    path = str(tmp_path / "values")
    items((1, 1, 2.5, "2024-01-01"), (2, 15, 3.0, "2024-01-01"), (3, 25, 4.0, "2024-01-02"))
    kept_values(spark, items, path)
    for part in (tmp_path / "values").glob("order_range=2/**/*.parquet"):
        part.write_bytes(b"gone")
    found = order_values.values_of(spark, path, rows("order_id bigint", (15,), (16,)), span=10)
    assert [(r.order_id, r.order_value) for r in found.collect()] == [(15, (0, 30000))]


def test_ranges_do_not_grow_with_the_ids(spark, items, rows, tmp_path, monkeypatch):
    """A build cuts its ids into so many ranges, whose width later updates and reads go by."""
    monkeypatch.setattr(order_values, "MOST_RANGES", 4)
    path = str(tmp_path / "values")

    def ranges():
        return sorted(p.name for p in (tmp_path / "values").glob("order_range=*"))

    items(*[(i, 10 * i, 1.5, f"2024-01-0{1 + i % 3}") for i in range(40)])
    assert kept_values(spark, items, path) == all_values(spark, items)
    assert ranges() == [f"order_range={i}" for i in range(4)]
    items((3, 35, 2.5, "2024-01-01"), (39, 390, None, "2024-01-01"), mode="replace")
    items((90, 450, 4.0, "2024-01-02"))
    assert kept_values(spark, items, path) == all_values(spark, items)
    assert ranges() == [f"order_range={i}" for i in range(5)]

    for part in (tmp_path / "values").glob("order_range=2/**/*.parquet"):
        part.write_bytes(b"gone")
    wanted = rows("order_id bigint", (30,), (35,), (450,))
    found = order_values.values_of(spark, path, wanted, span=10).collect()
    assert sorted((r.order_id, r.order_value.low) for r in found) == [(35, 25000), (450, 40000)]


def test_ranges_of_ids_far_apart_or_missing(spark, items, tmp_path):
    path = str(tmp_path / "values")
    items((1, -(2**63), 1.0, "2024-01-01"), (2, 2**63 - 1, 2.0, "2024-01-01"))
    assert kept_values(spark, items, path, span=1) == all_values(spark, items)
    items((3, None, 4.0, "2024-01-01"), (4, None, 1.0, "2024-01-02"), mode="overwrite")
    assert kept_values(spark, items, path) == all_values(spark, items)


def test_sums_without_a_noted_width_keep_their_ranges(spark, items, rows, tmp_path):
    path = str(tmp_path / "values")
    items((1, 1, 2.5, "2024-01-01"), (2, 15, 3.0, "2024-01-01"))
    kept_values(spark, items, path)
    files.delete(spark, f"{path}/{order_values.WIDTH}")
    items((3, 15, 1.0, "2024-01-01"), (4, 999, 1.0, "2024-01-01"))
    assert kept_values(spark, items, path) == all_values(spark, items)
    assert {p.name[12:] for p in (tmp_path / "values").glob("order_range=*")} == {"0", "1", "99"}
    found = order_values.values_of(spark, path, rows("order_id bigint", (999,)), span=10)
    assert [r.order_id for r in found.collect()] == [999]


def test_a_first_load_reads_its_days_once(spark, items, tmp_path, monkeypatch):
    calls, days = [], csv._days
    monkeypatch.setattr(csv, "_days", lambda *a: calls.append(1) or days(*a))
    items((1, 1, 2.5, "2024-01-02"), (2, 1, 2.5, "2024-01-01"), (3, 1, 2.5, None))
    assert len(calls) == 1
    assert changes.since(spark, items.path, 0).gained == {"2024-01-01", "2024-01-02"}


def test_a_day_does_not_read_all_items(spark, rows, tmp_path, monkeypatch):
    """From the second day on, spans of items without new rows are not opened."""
    monkeypatch.setattr(grain, "PARTITION_BYTES", 1)
    base = tmp_path / "raw"
    sources = Sources(spark, {n: str(base / n) for n in ("events", "orders", "order_items")})
    targets = Targets(str(tmp_path / "t"))

    def load(name, schema, *values, mode="append"):
        write_table(stored(name, rows(schema, *values)), name, str(base / name), mode)

    load("events", EVENT, event(1, "2024-01-01"))
    first, later = "2024-01-01 09:00:00", "2024-01-02 09:00:00"
    load("orders", ORDER, (1, 1, "Processing", first, first), (2, 1, "Completed", first, first))
    load("order_items", ITEM, (1, 1, 2.5, first), (2, 2, 3.0, first))
    run_daily(spark, sources, targets, RunParams.for_day(date(2024, 1, 1)))
    assert (base / "order_items" / "created_day=2024-01-01").exists()

    load("orders", ORDER, (1, 1, "Completed", first, later), mode="replace")
    load("order_items", ITEM, (3, 1, 4.25, later))
    for part in (base / "order_items" / "created_day=2024-01-01").glob("*.parquet"):
        part.write_bytes(b"gone")
    run_daily(spark, sources, targets, RunParams.for_day(date(2024, 1, 2)))
    daily = targets.read(spark, "int_daily_user_orders").orderBy("activity_date").collect()
    assert [r.total_completed_order_amount for r in daily] == [3.0, 6.75]


# --- late rows -------------------------------------------------------------------------


def test_late_rows_reach_the_features(spark, rows, tmp_path):
    base = tmp_path / "raw"
    sources = Sources(spark, {n: str(base / n) for n in ("events", "orders", "order_items")})
    targets = Targets(str(tmp_path / "t"))

    def load(name, schema, *values, mode="append"):
        write_table(stored(name, rows(schema, *values)), name, str(base / name), mode)

    def total():
        row = targets.read(spark, "behavior_features").where("user_id = 1").head()
        return row.events_total, row.completed_orders_total

    one, first = "2024-01-01 09:00:00", RunParams.for_day(date(2024, 1, 1))
    load("events", EVENT, event(1, "2024-01-01"), event(2, "2023-11-01"))
    load("orders", ORDER, (1, 1, "Completed", one, one))
    load("order_items", ITEM, (1, 1, 2.5, one))
    assert all(x.days == () for x in run_with_late(spark, sources, targets, first))
    assert total() == (2, 1)

    load("events", EVENT, event(3, "2024-01-02"), event(4, "2023-11-01"), event(5, "2023-11-02"))
    load("orders", ORDER, (2, 1, "Completed", one, "2023-12-31 09:00:00"), mode="replace")
    second = RunParams.for_day(date(2024, 1, 2))
    found = {x.table: x for x in late_days(spark, sources, targets, date(2024, 1, 2))}
    assert found["events"].days == (date(2023, 11, 1), date(2023, 11, 2))
    assert found["events"].spans == [(datetime(2023, 11, 1), datetime(2023, 11, 3))]
    assert found["orders"].days == (date(2023, 12, 31),)
    run_with_late(spark, sources, targets, second)
    assert total() == (5, 2)
    before = [content(targets.read(spark, step)) for step in STEPS]
    assert all(not x.days for x in late_days(spark, sources, targets, date(2024, 1, 3)))
    run_with_late(spark, sources, targets, second)
    assert [content(targets.read(spark, step)) for step in STEPS] == before

    # A raw table that is loaded as a whole: every day is late.
    load("events", EVENT, event(1, "2024-01-01"), event(2, "2023-11-01"), mode="overwrite")
    found = {x.table: x for x in late_days(spark, sources, targets, date(2024, 1, 3))}
    assert found["events"].days == (date(2023, 11, 1), date(2024, 1, 1))


# --- notes and spans -------------------------------------------------------------------


def test_notes_tell_what_loads_touched(spark, rows, items):
    items((1, 1, 1.0, "2024-01-01"), (2, 1, 1.0, "2024-06-02"))
    told = changes.since(spark, items.path, 0)
    assert (told.last, told.touched) == (1, {"created_day=2024-01-01"})
    assert told.gained == {"2024-01-01", "2024-06-02"}
    items((3, 1, 1.0, "2025-01-01"))
    items((1, 1, 2.0, "2025-02-01"), mode="replace")
    told = changes.since(spark, items.path, 2)
    assert (told.last, told.gained) == (3, {"2025-02-01"})
    assert told.touched == {"created_day=2024-01-01", "created_day=2025-01-01"}
    assert changes.since(spark, items.path, 3).touched == frozenset()
    items((1, 1, 2.0, "2025-02-01"), mode="overwrite")
    assert changes.since(spark, items.path, 3).touched is None
    assert changes.since(spark, items.path, 9).touched is None


def test_a_load_that_died_while_moving_is_finished(spark, rows, items, monkeypatch):
    items((1, 1, 1.0, "2024-01-01"))
    move, moved = files.move, []

    def dies(session, source, target):
        if moved:
            raise OSError("lost")
        moved.append(source)
        move(session, source, target)

    monkeypatch.setattr(files, "move", dies)
    with pytest.raises(OSError, match="lost"):
        items((2, 1, 1.0, "2024-01-01"), (3, 1, 1.0, "2025-01-01"), (4, 1, 1.0, "2026-01-01"))
    monkeypatch.setattr(files, "move", move)
    items((5, 1, 1.0, "2026-01-01"))
    rows = Sources(spark, {"order_items": items.path})["order_items"]
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3, 4, 5]
    assert not list(Path(items.path).parent.glob("items.*"))


def test_spans_by_bytes(spark, rows, tmp_path, monkeypatch):
    assert grain.chosen(100 << 20, 2) == "day"
    assert grain.chosen(100 << 20, 100) == "month"
    assert grain.chosen(100 << 20, 2000) == "year"
    assert grain.chosen(0, 0) == "year"
    events = [event(i, day) for i, day in enumerate(["2023-12-31", "2024-01-01", "2024-01-31"])]
    for size, folders, span in [
        (1, 3, None),
        (1 << 15, 2, "created_day_month"),
        (1 << 30, 2, "created_day_year"),
    ]:
        monkeypatch.setattr(grain, "PARTITION_BYTES", size)
        path = str(tmp_path / f"events{size}")
        write_table(stored("events", rows(EVENT, *events)), "events", path)
        assert len(list(Path(path).glob("created_day=*"))) == folders
        table = Sources(spark, {"events": path})
        df = table["events"]
        assert span is None or span in df.columns
        assert table.logical("events").columns == TABLES["events"].logical
        assert {(r.id, str(r.created_day)) for r in df.collect()} == {
            (0, "2023-12-31"),
            (1, "2024-01-01"),
            (2, "2024-01-31"),
        }
        batch = batch_filter(df, "created_at", RunParams.for_day(date(2024, 1, 31)), "created_day")
        assert [r.id for r in batch.collect()] == [2]
        assert len(batch.inputFiles()) <= len(df.inputFiles())
        plan = batch._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(created_day" in plan


def test_a_table_is_regrouped(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    events = rows(EVENT, event(1, "2024-01-01"), event(2, "2024-03-01"))
    write_table(stored("events", events), "events", path)
    table = Sources(spark, {"events": path})
    before = content(table.logical("events"))
    assert grain.of(spark, path) == "year"
    monkeypatch.setattr(grain, "PARTITION_BYTES", 1)
    assert regroup(spark, "events", path) == "day"
    assert len(list(Path(path).glob("created_day=*"))) == 2
    assert content(table.logical("events")) == before
    write_table(stored("events", rows(EVENT, event(3, "2024-03-02"))), "events", path)
    assert len(list(Path(path).glob("created_day=*"))) == 3


def test_rejects_are_added_after_the_table(spark, tmp_path, monkeypatch):
    header = ",".join(TABLES["events"].columns)
    session = "0a0a0a0a-0000-0000-0000-000000000000"
    good = f"1,1,1,{session},2024-01-01 00:00:00 UTC,1.2.3.4,c,s,1,b,t,/,home"
    source = tmp_path / "in.csv"
    source.write_text("\n".join([header, good, good.replace("1,1,1,", "x,1,1,", 1)]))
    target, rejects = str(tmp_path / "events"), str(tmp_path / "rejects")

    def load():
        at = datetime(2024, 1, 2)
        return csv.ingest(spark, "events", str(source), target, at, rejects=rejects)

    write = csv.write_table

    def fails(*arguments):
        raise OSError("full")

    monkeypatch.setattr(csv, "write_table", fails)
    with pytest.raises(OSError, match="full"):
        load()
    monkeypatch.setattr(csv, "write_table", write)
    assert load() == 1
    assert spark.read.parquet(rejects).count() == 1
