from __future__ import annotations

import os
import subprocess
import sys
from datetime import date
from urllib.parse import unquote

import pytest
from pyspark.sql.types import StructType

from footfall.operators.batch import delete_insert
from footfall.storage import files, key_index, tables
from footfall.storage.tables import (
    Layout,
    append_partitions,
    create_if_absent,
    incremental_replace,
    read_partitioned,
    rebuild_table,
    recover,
    replace_keys,
    replace_partitions,
    write_partitioned,
)

DAY_ROW = "user_id bigint, activity_date date, source string, n bigint"
KEYS = ("user_id", "activity_date", "source")
LAYOUTS = [Layout(), Layout(monthly=True)]


def read(spark, path):
    schema = StructType.fromDDL(DAY_ROW.replace(",", " ,"))
    return sorted(
        (r.user_id, r.activity_date.isoformat(), r.source or "", r.n)
        for r in read_partitioned(spark, path, schema).collect()
    )


FIRST = [
    (1, "2024-01-01", "a", 1),
    (1, "2024-01-02", "a", 2),
    (2, "2024-01-02", "a", 3),
    (2, "2024-01-02", None, 4),
    (1, "2024-02-01", "a", 5),
]
BATCH = [(1, "2024-01-02", "a", 20), (2, "2024-01-02", None, 40), (3, "2024-03-01", "b", 6)]
AFTER = [
    (1, "2024-01-01", "a", 1),
    (1, "2024-01-02", "a", 20),
    (1, "2024-02-01", "a", 5),
    (2, "2024-01-02", "", 40),
    (2, "2024-01-02", "a", 3),  # did not come back, and stays
    (3, "2024-03-01", "b", 6),
]


def test_delete_insert(rows):
    got = delete_insert(rows(DAY_ROW, *FIRST), rows(DAY_ROW, *BATCH), KEYS).collect()
    assert sorted(
        (r.user_id, r.activity_date.isoformat(), r.source or "", r.n) for r in got
    ) == sorted(AFTER)


def test_delete_insert_keeps_repeated_batch_keys(rows):
    batch = rows(DAY_ROW, (1, "2024-01-01", "a", 7), (1, "2024-01-01", "a", 8))
    got = delete_insert(rows(DAY_ROW, FIRST[0]), batch, KEYS).collect()
    assert sorted(r.n for r in got) == [7, 8]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_incremental(spark, rows, tmp_path, layout):
    path = str(tmp_path / "t")
    incremental_replace(spark, rows(DAY_ROW, *FIRST), path, KEYS, layout)
    for _ in range(2):  # the second time changes nothing
        incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, layout)
        assert read(spark, path) == sorted(AFTER)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, layout, full_refresh=True)
    assert len(read(spark, path)) == 3


def test_untouched_days_are_not_rewritten(spark, rows, tmp_path):
    path = tmp_path / "t"
    incremental_replace(spark, rows(DAY_ROW, *FIRST), str(path), KEYS, Layout())
    before = sorted(p.name for p in (path / "activity_date=2024-01-01").iterdir())
    incremental_replace(spark, rows(DAY_ROW, *BATCH), str(path), KEYS, Layout())
    assert sorted(p.name for p in (path / "activity_date=2024-01-01").iterdir()) == before


def test_empty_batch_and_empty_first_run(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    incremental_replace(spark, rows(DAY_ROW), path, KEYS, Layout())
    assert read(spark, path) == []
    incremental_replace(spark, rows(DAY_ROW, *FIRST), path, KEYS, Layout())
    incremental_replace(spark, rows(DAY_ROW), path, KEYS, Layout())
    assert len(read(spark, path)) == len(FIRST)


def test_partition_column_must_be_a_key(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="activity_date"):
        incremental_replace(spark, rows(DAY_ROW), str(tmp_path / "t"), ["user_id"], Layout())


@pytest.mark.parametrize("moved", [0, 1])
def test_driver_lost_while_moving(spark, rows, tmp_path, monkeypatch, moved):
    path = str(tmp_path / "t")
    incremental_replace(spark, rows(DAY_ROW, *FIRST), path, KEYS, Layout())
    real, calls = files.move, []

    def lost(session, source, target):
        calls.append(source)
        if len(calls) > moved:
            raise ConnectionError("driver lost")
        real(session, source, target)

    monkeypatch.setattr(files, "move", lost)
    with pytest.raises(ConnectionError):
        incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, Layout())
    monkeypatch.setattr(files, "move", real)
    with pytest.raises(RuntimeError, match="recover"):
        replace_partitions(spark, rows(DAY_ROW), path, ["activity_date"])
    recover(spark, path, 1)
    assert read(spark, path) == sorted(AFTER)
    incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, Layout())
    assert read(spark, path) == sorted(AFTER)


def test_write_lost_half_way_leaves_the_table(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    incremental_replace(spark, rows(DAY_ROW, *FIRST), path, KEYS, Layout())
    monkeypatch.setattr(tables, "_move_in", lambda *_: None)
    incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, Layout())
    (tmp_path / "t.pending" / "_SUCCESS").unlink()
    monkeypatch.undo()
    recover(spark, path, 1)
    assert len(read(spark, path)) == len(FIRST)
    assert not (tmp_path / "t.pending").exists()


def test_rebuild_may_read_its_own_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rebuild_table(spark, rows(DAY_ROW, *FIRST), path)
    rebuild_table(spark, spark.read.parquet(path).where("n > 3"), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [4, 5]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_driver_lost_while_swapping(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rebuild_table(spark, rows(DAY_ROW, *FIRST), path)
    real = files.move

    def lost(session, source, target):
        if source.endswith(".next"):
            raise ConnectionError("driver lost")
        real(session, source, target)

    monkeypatch.setattr(files, "move", lost)
    with pytest.raises(ConnectionError):
        rebuild_table(spark, rows(DAY_ROW, *BATCH), path)
    monkeypatch.undo()
    recover(spark, path, 1)
    assert spark.read.parquet(path).count() == len(BATCH)


def test_create_if_absent(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    create_if_absent(rows(DAY_ROW, *FIRST), path)
    create_if_absent(rows(DAY_ROW, *BATCH), path)
    assert spark.read.parquet(path).count() == len(FIRST)


def test_large_partition_is_split_and_small_ones_share_a_task(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "id",
        "if(id % 3 = 0, date'2024-01-01', date_add(date'2024-01-02', cast(id % 40 as int))) as day",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "500")
    try:
        write_partitioned(df, str(path), ["day"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    count = {p.name: len(list(p.glob("*.parquet"))) for p in path.glob("day=*")}
    assert count["day=2024-01-01"] > 1
    assert len(count) == 41 and sum(count.values()) < 41 * 2
    assert spark.read.parquet(str(path)).count() == 400_000


def test_sorted_inside_a_file(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("1000 - id as k", "date'2024-01-01' as day")
    write_partitioned(df, path, ["day"], ["k"])
    for file in (tmp_path / "t").glob("day=*/*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_days_of_the_calendar(rows):
    row = Layout(monthly=True).add_to(rows(DAY_ROW, FIRST[0])).head()
    assert (row.activity_date, row.activity_date_month) == (date(2024, 1, 1), "202401")


def test_a_first_build_is_one_move(spark, rows, tmp_path, monkeypatch):
    moved = []
    move = files.move
    monkeypatch.setattr(files, "move", lambda *a: (moved.append(a[-1]), move(*a)))
    path = str(tmp_path / "t")
    incremental_replace(spark, rows(DAY_ROW, *FIRST), path, KEYS, Layout())
    assert moved == [path]
    incremental_replace(spark, rows(DAY_ROW, *BATCH), path, KEYS, Layout())
    assert len(moved) == 1 + 2 and read(spark, path) == sorted(AFTER)


def test_working_tables_go_with_the_driver(tmp_path):
    script = (
        "from pyspark.sql import SparkSession\n"
        "from footfall.storage.files import shared_folder\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', 'file://{tmp_path}').getOrCreate()\n"
        "path = shared_folder(spark)\n"
        "spark.range(3).write.parquet(path)\n"
        "print(spark.read.parquet(path).count(), path)\n"
        "spark.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", script],
        env={**os.environ, "PYTHONPATH": root},
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    assert done.stdout.startswith(f"3 file://{tmp_path}/footfall-")
    assert not list(tmp_path.glob("footfall-*"))


def test_a_keyed_load_opens_only_what_the_index_names(spark, rows, tmp_path, monkeypatch):
    """Partitions without a key of the batch's ranges can be gone."""
    monkeypatch.setattr(key_index, "SPAN", 10)
    monkeypatch.setattr(key_index, "MOST_FILES", 4)
    path, schema = str(tmp_path / "t"), "id bigint, n bigint, part string"
    want = {}

    def load(*values, replace=True):
        df = rows(schema, *values)
        if replace:
            replace_keys(spark, df, path, "id", ["part"])
        else:
            append_partitions(spark, df, path, ["part"], key="id")
        want.update({v[0]: v for v in values})

    def stored(*parts):
        kind = StructType.fromDDL(schema.replace(",", " ,"))
        df = read_partitioned(spark, path, kind, only=parts or None)
        return sorted((r.id, r.n, r.part) for r in df.collect())

    load((1, 1, "a b:c"), (2, 1, "a b:c"), (11, 1, "y"), (21, 1, "z"))
    assert not key_index.is_kept(spark, path)
    load((2, 2, "a b:c"))  # the first keyed load builds the index
    assert key_index.is_kept(spark, path)
    load((31, 1, "w%"), (12, 1, "y"), replace=False)
    for number in range(8):  # more loads than the index keeps files
        load((3 + number % 2, number, f"a b:{number}"))
    load((12, 7, "w%"), (1, 9, "new"))
    assert stored() == sorted(want.values())
    assert len(list((tmp_path / "t" / key_index.FOLDER).glob("*.parquet"))) <= 4

    for part in (tmp_path / "t" / "part=z").glob("*.parquet"):
        part.write_bytes(b"gone")
    load((11, 3, "y"), (32, 1, "w%"))
    del want[21]
    others = [p.name for p in (tmp_path / "t").glob("part=*") if p.name != "part=z"]
    assert stored(*others) == sorted(want.values())
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_folders_of_rows_take_no_pattern(spark, tmp_path):
    """The key of a whole table passes here; a pattern took most of the time of its index."""
    path = str(tmp_path / "t=1" / "t")
    df = spark.range(4).selectExpr("id", "'a=/b' AS x", "id % 2 AS y")
    tables.write_partitioned(df, path, ["x", "y"])
    stored = spark.read.parquet(path)
    present = files.partitions(spark, path, 2)
    for depth in (1, 2):
        folder = key_index.folder_of(depth)
        assert "regexp" not in str(folder)
        found = {unquote(r[0]) for r in stored.select(folder).collect()}
        assert found == {"/".join(name.split("/")[-depth:]) for name in present}
