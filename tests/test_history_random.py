"""Random sequences of source states against a plain model of what history must hold."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators import history_ranges
from footfall.operators.history import as_of, as_of_join, first_versions, merge_versions
from footfall.operators.history_ranges import as_of_join_by_ranges
from footfall.storage.history import read_history, update_snapshot

SCHEMA = (
    "order_id bigint, status string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "note string"
)
CHECK = ("status", "updated_at")
START = datetime(2024, 1, 1)
RUNS = [START + timedelta(days=n) for n in range(5)]


def random_state(rng, before):
    """Keys come, go, return, change a compared or another column, or move to another month."""
    state = {}
    for key in range(30):
        old = before.get(key)
        if rng.random() < (0.25 if old is None else 0.15):
            if old is None:
                state[key] = new_row(rng)
            continue
        if old is None:
            continue
        status, created, updated, note = old
        if rng.random() < 0.4:
            status = rng.choice(["Processing", "Completed", "Cancelled", None])
        if rng.random() < 0.2:
            updated = rng.choice([None, created + timedelta(hours=rng.randrange(1, 50))])
        if rng.random() < 0.2:
            note = rng.choice(["a", "b", None])
        if rng.random() < 0.1:
            created = created + timedelta(days=31)
        state[key] = (status, created, updated, note)
    return state


def new_row(rng):
    created = datetime(2023, rng.randrange(1, 13), rng.randrange(1, 28))
    return ("Processing", created, created, None)


def model(states):
    """Versions as a list per key, replayed run by run."""
    versions = {}
    for run, state in zip(RUNS, states, strict=True):
        for key, row in state.items():
            kept = versions.setdefault(key, [])
            if kept and (kept[-1]["row"][0], kept[-1]["row"][2]) == (row[0], row[2]):
                continue
            if kept:
                kept[-1]["to"] = run
            kept.append({"row": row, "from": run, "to": None})
    return versions


def flat(versions):
    return sorted(
        str((key, *v["row"], v["from"], v["to"])) for key, kept in versions.items() for v in kept
    )


def stored(history):
    columns = (
        "order_id", "status", "created_at", "updated_at", "note", "valid_from", "valid_to",
    )
    return sorted(str(tuple(row)) for row in history.select(*columns).collect())


@pytest.mark.parametrize("seed", range(4))
def test_history(spark, rows, tmp_path, seed):
    rng = random.Random(seed)
    states, last_seen = [], {}
    for _ in RUNS:
        state = random_state(rng, last_seen)
        states.append(state)
        last_seen = {**last_seen, **state} if rng.random() < 0.5 else state
    want = model(states)
    frames = [rows(SCHEMA, *[(key, *row) for key, row in s.items()]) for s in states]

    merged = first_versions(frames[0], "order_id", RUNS[0])
    for run, frame in zip(RUNS[1:], frames[1:], strict=True):
        merged = merge_versions(merged, frame, "order_id", CHECK, run)
    assert stored(merged) == flat(want)

    path = str(tmp_path / "history")
    for run, frame in zip(RUNS, frames, strict=True):
        update_snapshot(spark, frame, path, "order_id", CHECK, run, month_of="created_at")
    history = read_history(spark, path, frames[0].schema)
    assert stored(history) == flat(want)

    def at(key, moment):
        for version in want.get(key, []):
            if version["from"] <= moment and (version["to"] is None or moment < version["to"]):
                return version
        return None

    for moment in (START - timedelta(hours=1), RUNS[2], RUNS[3] + timedelta(hours=5)):
        valid = {k: [v] for k in want if (v := at(k, moment)) is not None}
        assert stored(as_of(history, moment)) == flat(valid)
        late = read_history(spark, path, frames[0].schema, ended_after=moment)
        assert stored(as_of(late, moment)) == flat(valid)

    facts = [
        (n, rng.randrange(33), START + timedelta(hours=rng.randrange(-10, 120))) for n in range(80)
    ]
    frame = rows("id bigint, order_id bigint, at timestamp_ntz", *facts)
    joined = as_of_join(frame, history, "order_id", "at", ["status", "valid_from"]).collect()
    assert {r.id: (r.status_as_of, r.valid_from_as_of) for r in joined} == {
        n: (v["row"][0], v["from"]) if (v := at(key, moment)) else (None, None)
        for n, key, moment in facts
    }
    assert len(joined) == len(facts)


@pytest.mark.parametrize("range_rows", [7, 40, 10_000])
def test_the_join_by_ranges_gives_the_same(spark, range_rows):
    """Keys over several ranges, facts at the moment of a version, gaps, NULL keys and moments."""
    drawn = random.Random(range_rows)
    start = datetime(2024, 1, 1)
    versions, facts = [], []
    for key in [*range(6), None]:
        at = start
        for number in range(0 if key == 5 else drawn.choice([1, 3, 30])):
            begins = at + timedelta(hours=drawn.randint(1, 5))
            at = begins + timedelta(hours=drawn.randint(1, 5))
            last = drawn.random() < 0.1
            versions.append((key, f"v{key}.{number}", begins, None if last else at))
            if last:
                break
        for number in range(drawn.choice([3, 60])):
            moment = None if drawn.random() < 0.1 else start + timedelta(hours=drawn.randint(0, 90))
            facts.append((f"f{key}.{number % 40}", key, moment))
    history = spark.createDataFrame(
        versions,
        "order_id long, status string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    frame = spark.createDataFrame(facts, "name string, order_id long, at timestamp_ntz")
    arguments = (frame, history, "order_id", "at", ["status", "valid_from"])
    want = as_of_join(*arguments)
    got = as_of_join_by_ranges(*arguments, range_rows=range_rows)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    empty = as_of_join_by_ranges(frame.limit(0), *arguments[1:], range_rows=range_rows)
    assert empty.collect() == []


def test_a_key_that_is_hot_on_both_sides(spark):
    """A million facts and a thousand versions of one key, in ranges of 100,000 rows."""
    start = "timestamp_ntz'2024-01-01 00:00:00'"
    facts = spark.range(1_000_000).selectExpr(
        "id", "1L as order_id", f"{start} + make_dt_interval(0, 0, 0, id % 100000) as at"
    )
    history = spark.range(1000).selectExpr(
        "1L as order_id",
        "cast(id as string) as status",
        f"{start} + make_dt_interval(0, 0, 0, id * 100) as valid_from",
        f"if(id = 999, null, {start} + make_dt_interval(0, 0, 0, id * 100 + 100)) as valid_to",
    )
    joined = as_of_join_by_ranges(facts, history, "order_id", "at", ["status"], 100_000)
    wrong = joined.where("status_as_of IS DISTINCT FROM cast((id % 100000) div 100 as string)")
    assert joined.count() == 1_000_000
    assert wrong.isEmpty()


def test_short_ranges_make_no_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history_ranges, "shared_folder", lambda spark: str(tmp_path / "placed"))
    rows = spark.range(2000)
    moment = F.expr("CAST('2024-01-01' AS timestamp_ntz) + make_dt_interval(0, 0, id)")
    facts = rows.select((F.col("id") % 3).alias("order_id"), moment.alias("at"))
    nothing = F.lit(None).cast("timestamp_ntz")
    history = facts.limit(3).select(
        "order_id", F.col("at").alias("valid_from"), nothing.alias("valid_to"), "at"
    )
    arguments = (facts, history, "order_id", "at", ["valid_from"])
    got = as_of_join_by_ranges(*arguments, range_rows=5)
    want = as_of_join(*arguments)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    placed = spark.read.parquet(str(tmp_path / "placed"))
    assert placed.select("part").distinct().count() >= 400
    assert placed.groupBy("part").count().where("count > 5").isEmpty()
    assert len(list((tmp_path / "placed").glob("part-*"))) <= 8
