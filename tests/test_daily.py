from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import sample_data
from footfall import RunParams, Sources, Targets, run_daily
from footfall.functions.time import ntz
from footfall.operators.batch import batch_filter
from footfall.operators.events import daily_user_events
from footfall.plans import daily

SF_DIR = "/root/testdata/sf0.001"
DAYS = [date(2024, 1, d) for d in (27, 28, 29)]


def sources_at(spark, moment):
    events = sample_data.events(spark, SF_DIR)
    return Sources(
        spark,
        {
            "events": events.where(F.col("created_at") < ntz(moment)),
            "orders": sample_data.orders_at(spark, SF_DIR, moment),
            "order_items": sample_data.order_items(spark, SF_DIR),
        },
    )


def run(spark, targets, day, **more):
    params = RunParams.for_day(day)
    run_daily(spark, sources_at(spark, params.end), targets, params, **more)


def content(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def targets(spark, tmp_path_factory):
    made = Targets(str(tmp_path_factory.mktemp("daily")))
    for day in DAYS:
        run(spark, made, day)
    return made


def test_daily_events_equal_one_full_pass(spark, targets):
    events = sources_at(spark, datetime(2024, 1, 30))["events"]
    stored = targets.read(spark, "int_daily_user_events")
    assert content(stored) == content(daily_user_events(events).select(*stored.columns))


@pytest.mark.parametrize("step", daily.STEPS)
def test_running_a_day_again_changes_nothing(spark, targets, step):
    before = content(targets.read(spark, step))
    run(spark, targets, DAYS[-1], steps=[step])
    assert content(targets.read(spark, step)) == before


def test_a_day_without_broadcasts_gives_the_same(spark, targets):
    before = content(targets.read(spark, "int_daily_user_orders"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run(spark, targets, DAYS[-1], steps=["int_daily_user_orders"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert content(targets.read(spark, "int_daily_user_orders")) == before


def test_anonymous_events_can_be_left_out(spark, rows):
    events = rows("id bigint, user_id bigint", (1, 0), (2, 7))
    assert Sources(spark, {"events": events})["events"].count() == 2
    known = Sources(spark, {"events": events}, drop_anonymous=True)
    assert [r.user_id for r in known["events"].collect()] == [7]


def test_no_working_tables_are_left(spark, targets):
    from pathlib import Path

    assert sorted(p.name for p in Path(targets.base).iterdir()) == sorted(daily.STEPS)


def test_one_feature_row_per_user(spark, targets):
    features = targets.read(spark, "behavior_features")
    assert features.count() == features.select("user_id").distinct().count()
    counted = features.agg(F.sum("events_total")).head()[0]
    assert counted == sources_at(spark, datetime(2024, 1, 30))["events"].count()


def test_orders_differ_from_a_full_refresh_by_design(spark, tmp_path, rows):
    """A completed order that is returned later keeps its earlier day only when run daily."""
    order = (
        "order_id bigint, user_id bigint, status string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    )
    items = rows("order_id bigint, sale_price double", (1, 5.0))

    def sources(updated):
        orders = rows(order, (1, 1, "Completed", "2024-01-01 00:00:00", updated))
        return Sources(
            spark,
            {
                "events": sample_data.events(spark, SF_DIR).where("false"),
                "orders": orders,
                "order_items": items,
            },
        )

    targets, steps = Targets(str(tmp_path)), ["orders_snapshot", "int_daily_user_orders"]
    for day, updated in [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")]:
        params = RunParams.for_day(date(2024, 1, day))
        run_daily(spark, sources(updated), targets, params, steps)
    stored = targets.read(spark, "int_daily_user_orders").orderBy("activity_date").collect()
    assert [(r.activity_date.day, r.completed_order_count) for r in stored] == [(1, 1), (2, 0)]

    run_daily(spark, sources(updated), targets, params, steps[1:], full_refresh=True)
    (row,) = targets.read(spark, "int_daily_user_orders").collect()
    assert (row.activity_date.day, row.completed_order_count) == (2, 0)


def test_an_older_day_again(spark, targets):
    """Once history has moved on, an older day runs without the snapshot and stays as it was."""
    day = RunParams.for_day(DAYS[1])
    sources = sources_at(spark, day.end)
    with pytest.raises(ValueError, match="cannot record"):
        run_daily(spark, sources, targets, day, ["orders_snapshot"])
    for step in daily.STEPS[1:3]:
        before = content(targets.read(spark, step))
        run_daily(spark, sources, targets, day, [step])
        assert content(targets.read(spark, step)) == before


def test_a_day_without_data_changes_features_only(spark, tmp_path):
    targets = Targets(str(tmp_path))
    run(spark, targets, DAYS[-1])
    kept = daily.STEPS[1:3]
    before = [content(targets.read(spark, step)) for step in kept]
    params = RunParams.for_day(date(2024, 3, 1))
    run_daily(spark, sources_at(spark, datetime(2024, 1, 30)), targets, params)
    assert [content(targets.read(spark, step)) for step in kept] == before
    features = targets.read(spark, "behavior_features")
    assert features.where("events_1d > 0 or events_30d > 0").isEmpty()
    assert not features.where("events_total > 0").isEmpty()


def test_days_run_one_by_one_or_at_once_give_the_same_events(spark, targets, tmp_path):
    at_once = Targets(str(tmp_path))
    run(spark, at_once, DAYS[0], steps=["int_daily_user_events"])
    span = RunParams(datetime(2024, 1, 28), datetime(2024, 1, 30), DAYS[-1])
    run_daily(spark, sources_at(spark, span.end), at_once, span, ["int_daily_user_events"])
    step = "int_daily_user_events"
    assert content(at_once.read(spark, step)) == content(targets.read(spark, step))


def test_steps_are_checked(spark, targets):
    with pytest.raises(ValueError, match="unknown step nonsense"):
        run(spark, targets, DAYS[0], steps=["nonsense"])


def test_parameters():
    params = RunParams.for_day(date(2024, 1, 5))
    assert (params.start, params.end) == (datetime(2024, 1, 5), datetime(2024, 1, 6))
    assert params.as_of == params.start and params.job_date == date(2024, 1, 5)
    with pytest.raises(ValueError):
        RunParams(params.end, params.start, params.job_date)
    with pytest.raises(TypeError):
        RunParams("2024-01-05", params.end, params.job_date)
    with pytest.raises(TypeError):
        RunParams(params.start, params.end, params.start)


def test_batch_filter_is_half_open_and_prunes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    moments = ["2024-01-04 23:59:59", "2024-01-05 00:00:00", "2024-01-05 23:59:59", "2024-01-06 00:00:00"]
    df = rows("at timestamp_ntz, day date", *[(m, m[:10]) for m in moments])
    df.write.partitionBy("day").parquet(path)
    stored = spark.read.schema("at timestamp_ntz, day date").parquet(path)
    batch = batch_filter(stored, "at", RunParams.for_day(date(2024, 1, 5)), "day")
    assert sorted(str(r.at) for r in batch.collect()) == moments[1:3]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(at)" in plan
    early = RunParams(datetime(2024, 1, 5), datetime(2024, 1, 5) + timedelta(hours=1), date(2024, 1, 5))
    assert batch_filter(stored, "at", early, "day").count() == 1
