from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from footfall.operators.history import as_of, as_of_join, first_versions, merge_versions
from footfall.storage.history import read_any_history, read_history, update_snapshot

ORDER = (
    "order_id bigint, status string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "note string"
)
CHECK = ("status", "updated_at")
DAY = [datetime(2024, 1, d) for d in range(1, 6)]


def order(number, status, updated="2024-01-01 00:00:00", note=None, created="2023-12-01 00:00:00"):
    return (number, status, created, updated, note)


@pytest.fixture
def states(rows):
    return [
        rows(ORDER, order(1, "Processing"), order(2, "Processing"), order(3, "Processing")),
        rows(
            ORDER,
            order(1, "Completed"),  # another status
            order(2, "Processing", note="x"),  # a column that is not compared
            order(4, None, updated=None),  # new; 3 is gone
        ),
        rows(
            ORDER,
            order(1, "Completed", updated="2024-01-03 00:00:00"),  # another moment
            order(2, "Processing"),
            order(4, None, updated=None),  # NULL equals NULL
        ),
    ]


WANT = {
    (1, "Processing", DAY[0], DAY[1]),
    (1, "Completed", DAY[1], DAY[2]),
    (1, "Completed", DAY[2], None),
    (2, "Processing", DAY[0], None),
    (3, "Processing", DAY[0], None),
    (4, None, DAY[1], None),
}


def versions(history):
    got = history.select("order_id", "status", "valid_from", "valid_to").collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def test_merge(states):
    history = first_versions(states[0], "order_id", DAY[0])
    for run, state in zip(DAY[1:], states[1:], strict=False):
        history = merge_versions(history, state, "order_id", CHECK, run)
    assert versions(history) == WANT
    assert history.where("order_id = 2").head().note is None
    assert history.select("scd_id").distinct().count() == 6


def record(spark, path, state, run):
    update_snapshot(spark, state, path, "order_id", CHECK, run, month_of="created_at")


def test_table(spark, states, tmp_path):
    path = str(tmp_path / "history")
    for run, state in zip(DAY, states, strict=False):
        record(spark, path, state, run)
        before = versions(read_history(spark, path, state.schema))
        record(spark, path, state, run)  # a retry
        assert versions(read_history(spark, path, state.schema)) == before
    record(spark, path, states[-1], DAY[4])  # nothing new
    assert versions(read_history(spark, path, states[0].schema)) == WANT
    assert sorted(p.name for p in tmp_path.iterdir()) == ["history"]


def test_intervals_do_not_overlap(spark, states, tmp_path):
    path = str(tmp_path / "history")
    for run, state in zip(DAY, states, strict=False):
        record(spark, path, state, run)
    history = read_history(spark, path, states[0].schema)
    assert history.where("valid_to is null").groupBy("order_id").count().where("count > 1").isEmpty()
    closed = history.where("valid_to is not null").select("order_id", "valid_to")
    starts = history.select("order_id", F.col("valid_from").alias("valid_to"))
    assert closed.join(starts, ["order_id", "valid_to"], "left_anti").isEmpty()


def test_a_row_that_changes_its_month_moves(spark, rows, tmp_path):
    path = str(tmp_path / "history")
    state = rows(ORDER, order(1, "Processing", created="2023-11-01 00:00:00"))
    record(spark, path, state, DAY[0])
    record(spark, path, rows(ORDER, order(1, "Completed", created="2023-12-01 00:00:00")), DAY[1])
    assert versions(read_history(spark, path, state.schema)) == {
        (1, "Processing", DAY[0], DAY[1]),
        (1, "Completed", DAY[1], None),
    }


def test_nothing_at_first(spark, rows, tmp_path):
    path = str(tmp_path / "history")
    for run in DAY[:2]:
        record(spark, path, rows(ORDER), run)
    record(spark, path, rows(ORDER, order(1, "Processing")), DAY[2])
    history = read_history(spark, path, rows(ORDER).schema)
    assert versions(history) == {(1, "Processing", DAY[2], None)}


def test_many_changes_do_not_go_to_every_task(spark, tmp_path):
    """A million sorted keys are a small file, by which Spark took them for a small table."""
    path, number = str(tmp_path / "history"), 1_000_000
    state = spark.range(number).selectExpr(
        "id AS order_id",
        "'P' AS status",
        "CASE WHEN id % 5 > 0 THEN timestamp_ntz'2023-12-01' END AS created_at",
        "timestamp_ntz'2024-01-01' AS updated_at",
        "'' AS note",
    )
    record(spark, path, state, DAY[0])
    spark.conf.set("spark.sql.maxBroadcastTableSize", "8m")
    try:
        record(spark, path, state.withColumn("status", F.lit("C")), DAY[1])
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    history = read_history(spark, path, state.schema)
    counts = history.groupBy("status", F.col("valid_to").isNull().alias("open")).count().collect()
    assert {tuple(row) for row in counts} == {("P", False, number), ("C", True, number)}


def test_rows_without_a_month(spark, rows, tmp_path):
    """NULL is a month like any other, for new orders, changed ones and moves from and to it."""
    path = str(tmp_path / "history")
    first = [order(1, "P", created=None), order(2, "P"), order(3, "P", created=None)]
    record(spark, path, rows(ORDER, *first), DAY[0])
    second = [
        order(1, "C", created=None),
        order(2, "C", created=None),
        order(3, "C"),
        order(4, "P", created=None),
    ]
    record(spark, path, rows(ORDER, *second), DAY[1])
    record(spark, path, rows(ORDER, *second), DAY[2])
    assert versions(read_history(spark, path, rows(ORDER).schema)) == {
        (1, "P", DAY[0], DAY[1]),
        (2, "P", DAY[0], DAY[1]),
        (3, "P", DAY[0], DAY[1]),
        (1, "C", DAY[1], None),
        (2, "C", DAY[1], None),
        (3, "C", DAY[1], None),
        (4, "P", DAY[1], None),
    }


def test_a_session_zone_does_not_move_the_end_of_a_version(spark, rows, tmp_path):
    path, run = str(tmp_path / "history"), datetime(2024, 3, 31)  # no midnight in Beirut
    record(spark, path, rows(ORDER, order(1, "P")), DAY[0])
    record(spark, path, rows(ORDER, order(1, "C")), run)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Beirut")
    try:
        known = versions(read_history(spark, path, rows(ORDER).schema))
        assert known == versions(read_any_history(spark, path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (1, "P", DAY[0], run) in known


def test_runs_must_move_forward(spark, states, tmp_path):
    path = str(tmp_path / "history")
    record(spark, path, states[0], DAY[2])
    with pytest.raises(ValueError, match="cannot record"):
        record(spark, path, states[1], DAY[1])


def test_repeated_key_stops(spark, rows, tmp_path):
    path = str(tmp_path / "history")
    twice = rows(ORDER, order(1, "Processing"), order(1, "Completed"))
    with pytest.raises(PySparkException, match="more than once: 1"):
        record(spark, path, twice, DAY[0])
    record(spark, path, rows(ORDER, order(1, "Processing")), DAY[0])
    with pytest.raises(PySparkException, match="more than once: 1"):
        record(spark, path, twice, DAY[1])


def test_as_of_sees_starts_and_not_ends(spark, states, tmp_path):
    path = str(tmp_path / "history")
    for run, state in zip(DAY, states, strict=False):
        record(spark, path, state, run)
    history = read_history(spark, path, states[0].schema)
    assert as_of(history, datetime(2023, 12, 31)).isEmpty()
    got = {r.order_id: r.status for r in as_of(history, DAY[1]).collect()}
    assert got == {1: "Completed", 2: "Processing", 3: "Processing", 4: None}
    plan = as_of(history, DAY[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((valid_to" in plan


def test_reading_late_versions_lists_no_earlier_folder(spark, states, tmp_path):
    path = str(tmp_path / "history")
    runs = [DAY[0], DAY[1], DAY[2].replace(microsecond=500_000)]
    for run, state in zip(runs, states, strict=True):
        record(spark, path, state, run)
    schema = states[0].schema
    for moment, ends in [(DAY[0], {runs[1], runs[2], None}), (runs[1], {runs[2], None})]:
        late = read_history(spark, path, schema, ended_after=moment)
        assert {r.valid_to for r in late.collect()} == ends
    late = read_history(spark, path, schema, ended_after=runs[2])
    assert not late.isEmpty() and late.where("valid_to is not null").isEmpty()
    assert all("__HIVE_DEFAULT_PARTITION__" in file for file in late.inputFiles())


def test_as_of_join(rows):
    history = rows(
        "order_id bigint, status string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        (1, "Processing", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        (1, "Completed", "2024-01-03 00:00:00", None),
    )
    facts = rows(
        "id bigint, order_id bigint, at timestamp_ntz",
        (1, 1, "2023-12-31 23:59:59"),
        (2, 1, "2024-01-01 00:00:00"),
        (3, 1, "2024-01-02 23:59:59"),
        (4, 1, "2024-01-03 00:00:00"),
        (5, 2, "2024-01-03 00:00:00"),
        (6, 1, None),
    )
    got = as_of_join(facts, history, "order_id", "at", ["status"]).collect()
    assert {r.id: r.status_as_of for r in got} == {
        1: None,
        2: "Processing",
        3: "Processing",
        4: "Completed",
        5: None,
        6: None,
    }


def test_as_of_join_splits_a_hot_key(spark):
    """One order with a third of all facts; its tasks are split by adaptive execution."""
    facts = spark.range(0, 300_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 1, id) as order_id",
        "timestamp_ntz'2024-01-02 00:00:00' as at",
        "md5(cast(id as string)) as payload",
    )
    history = spark.range(300_000).selectExpr(
        "id as order_id",
        "'Processing' as status",
        "timestamp_ntz'2024-01-01 00:00:00' as valid_from",
        "cast(null as timestamp_ntz) as valid_to",
    )
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500k",
    }
    before = {name: spark.conf.get(name) for name in confs}
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        joined = as_of_join(facts, history, "order_id", "at", ["status"])
        assert joined.where("status_as_of = 'Processing'").select("payload").distinct().count() == 300_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "skew=true" in plan


def test_chained_runs_read_each_state_once(states):
    history = first_versions(states[0], "order_id", DAY[0])
    for run, state in zip(DAY[1:], states[1:], strict=False):
        history = merge_versions(history, state, "order_id", CHECK, run)
    plan = history._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 2


def test_a_missing_key_is_an_ordinary_key_of_the_source(rows):
    """Key 0 stands for a missing id; it is versioned like any other."""
    history = first_versions(rows(ORDER, order(0, "Processing")), "order_id", DAY[0])
    history = merge_versions(history, rows(ORDER, order(0, "Completed")), "order_id", CHECK, DAY[1])
    assert versions(history) == {
        (0, "Processing", DAY[0], DAY[1]),
        (0, "Completed", DAY[1], None),
    }
