"""Ids of eight unsigned bytes."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from footfall import RunParams, Sources, Targets, run_daily
from footfall.functions import ids
from footfall.operators.events import last_event_per_user_day
from footfall.plans import order_values
from footfall.sources.csv import ingest, read_csv, read_csv_with_rejects
from footfall.sources.schemas import TABLES

LOAD = datetime(2024, 6, 1)
LARGEST = str(2**64 - 1)
NAMES = ["0", "7", str(2**53 + 1), str(2**63 - 1), str(2**63), str(2**63 + 1), LARGEST]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "text string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ids_come_back_from_eight_bytes(spark, texts, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        stored = texts.select("text", ids.from_text(F.col("text")).alias("id"))
        assert dict(stored.dtypes)["id"] == "bigint"
        got = stored.select("text", ids.to_text(F.col("id")).alias("back")).collect()
        assert [r.text for r in got] == [r.back for r in got] == NAMES
        in_order = stored.orderBy(ids.in_order(F.col("id"))).collect()
        assert [r.text for r in in_order] == NAMES
        other = ["-1", str(2**64), "1e3", "9223372036854775808.5", "", "x", None, "0x10"]
        bad = spark.createDataFrame([(t,) for t in other], "text string")
        assert [r[0] for r in bad.select(ids.from_text(F.col("text"))).collect()] == [None] * 8
        spaced = spark.createDataFrame([(f" {LARGEST} ",), ("+5",)], "text string")
        assert [r[0] for r in spaced.select(ids.from_text(F.col("text"))).collect()] == [-1, 5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_long_texts_are_read_as_short_ones(spark):
    given = {"0" * 30 + "5": 5, " " * 20 + "+7": 7, "-" + "0" * 20: 0, "0" * 9 + LARGEST: -1}
    given |= {"\t" + " " * 20 + "8": 8, "9" * 19: 9999999999999999999 - 2**64, "9" * 20: None}
    given |= {"5" + "0" * 17 + " x": None, "-" + "9" * 18: None, str(2**64) + "0": None}
    texts = spark.createDataFrame([(t,) for t in given], "text string")
    assert [r[0] for r in texts.select(ids.from_text(F.col("text"))).collect()] == [*given.values()]


@pytest.mark.parametrize("table", ["order_items", "orders", "events"])
def test_a_row_of_ids_is_read_by_a_method_that_the_jvm_compiles(spark, tmp_path, table):
    path = tmp_path / "rows.csv"
    path.write_text(",".join(TABLES[table].columns) + "\n")
    execution = read_csv(spark, table, str(path), LOAD)._jdf.queryExecution()
    modes = spark._jvm.org.apache.spark.sql.execution.ExplainMode
    text = execution.explainString(modes.fromString("codegen"))
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000  # HotSpot's limit of bytes of a method


def test_the_last_text_is_found_among_ids_of_any_length(spark):
    given = [("a", 9), ("a", 10), ("a", -1), ("b", -1), ("b", -5), ("b", 12), ("c", None)]
    rows = spark.createDataFrame(given, "key string, id bigint")
    got = {r.key: r.id for r in ids.last_text(rows, "key", "id").collect()}
    assert got == {"a": "9", "b": LARGEST, "c": None}


def test_the_larger_id_is_the_last_event(rows):
    schema = (
        "id bigint, user_id bigint, sequence_number bigint, created_at timestamp_ntz, "
        "event_type string, uri string"
    )
    at = "2024-01-01 10:00:00"
    events = rows(schema, (5, 1, 1, at, "a", "/5"), (-1, 1, 1, at, "b", "/largest"))
    assert last_event_per_user_day(events).head().last_event_uri == "/largest"


def line(table, **values):
    return ",".join(str(values.get(c, "")) for c in TABLES[table].columns)


def test_the_largest_ids_go_through_loads_and_runs(spark, tmp_path):
    at = "2024-01-01 09:00:00 UTC"
    order, user = 2**64 - 1, 2**64 - 2
    lines = {
        "orders": [line("orders", order_id=order, user_id=user, status="Completed", created_at=at)],
        "order_items": [
            line("order_items", id=2**63, order_id=order, user_id=user, created_at=at, sale_price=2),
            line("order_items", id=3, order_id=order, user_id=user, created_at=at, sale_price=0.5),
        ],
        "events": [
            line("events", id=2**63 + 5, user_id=user, created_at=at, uri="/", browser="b"),
        ],
    }
    sources = Sources(spark, {name: str(tmp_path / name) for name in lines})
    for name, own in lines.items():
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([",".join(TABLES[name].columns), *own]))
        sound, rejected = read_csv_with_rejects(spark, name, str(path), LOAD)
        assert (sound.count(), rejected.count()) == (len(own), 0)
        for mode in ("append", "replace"):
            ingest(spark, name, str(path), sources.path(name), LOAD, mode=mode)
    items = ids.as_text(sources.logical("order_items"), TABLES["order_items"].wide_ids)
    got = {(r.id, r.order_id, r.product_id) for r in items.collect()}
    assert got == {(str(2**63), str(order), "0"), ("3", str(order), "0")}

    targets = Targets(str(tmp_path / "t"))
    run_daily(spark, sources, targets, RunParams.for_day(date(2024, 1, 1)))
    (row,) = ids.as_text(targets.read(spark, "behavior_features"), ["user_id"]).collect()
    assert (row.user_id, row.events_total, row.total_completed_amount_total) == (str(user), 1, 2.5)
    only = sources.logical("orders")
    found = order_values.values_of(spark, targets.state("order_values"), only).collect()
    assert [(r.order_id, tuple(r.order_value)) for r in found] == [(-1, (0, 25000))]
