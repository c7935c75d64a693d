"""Writes of partitioned tables, and their replacement in a way a crash cannot halve.

A replacement is written in full beside its table and only then moved in. If the
driver dies while moving, the next call finishes from what still waits there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.operators.batch import delete_insert
from footfall.storage import changes, files, key_index


@dataclass(frozen=True)
class Layout:
    """Partitions of a table by its column ``day``: one per day, or one per month.

    Days suit a table that gains gigabytes a day. Months spare a lighter one
    thousands of small directories, for rewriting up to a month per batch.
    """

    day: str = "activity_date"
    monthly: bool = False

    @property
    def column(self) -> str:
        return f"{self.day}_month" if self.monthly else self.day

    def add_to(self, df: DataFrame) -> DataFrame:
        if not self.monthly:
            return df
        return df.withColumn(self.column, F.date_format(F.col(self.day), "yyyyMM"))


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    mode: str = "error",
) -> None:
    """Writes a directory per partition value, sorted inside for min/max skipping.

    Rebalancing gathers each partition's rows, so a task has few files open, and
    splits a partition that is far larger than the others over several tasks.
    """
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, *sort_by)
        .write.mode(mode)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_partitioned(
    spark: SparkSession, path: str, schema: StructType, only: Sequence[str] | None = None
) -> DataFrame:
    """The table with the columns of ``schema``, in their order.

    ``only`` names partition directories; the others are not even listed.
    """
    if only is not None and not only:
        return spark.createDataFrame([], schema)
    folders = [path] if only is None else [f"{path}/{name}" for name in only]
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).select(*schema.fieldNames())


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def _added(path: str) -> str:
    return f"{path.rstrip('/')}.added"


def recover(spark: SparkSession, path: str, depth: int) -> None:
    """Finishes or forgets what a lost driver left beside a table of ``depth`` partition levels."""
    if files.is_complete(spark, _pending(path)):
        _move_in(spark, path, depth)
    else:
        files.delete(spark, _pending(path))
    if files.is_complete(spark, _added(path)):
        _add_in(spark, path, depth)
    else:
        files.delete(spark, _added(path))
    if files.exists(spark, f"{path.rstrip('/')}.previous"):
        _swap_in(spark, path)


def _note(spark: SparkSession, path: str, staged: str, names: Sequence[str]) -> None:
    """Notes that the partitions ``names`` change, if changes of the table are kept."""
    if changes.are_kept(spark, path):
        number = changes.last(spark, path) + 1
        changes.note(spark, path, number, names, _gained(spark, staged))


def _gained(spark: SparkSession, staged: str) -> list[str] | None:
    marked = f"{staged}/{changes.GAINED}"
    return json.loads(files.read_text(spark, marked)) if files.exists(spark, marked) else None


def append_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    gained: Callable[[DataFrame], Sequence[str]] | None = None,
    marks: Mapping[str, str] | None = None,
    key: str | None = None,
) -> None:
    """Adds rows to a table whose changes are kept, and the index of its ``key`` if there is one.

    Files are written beside the table and then moved in, so what changes is known
    before. What dies while moving is finished by ``recover``. ``gained`` tells from the
    written rows what the note is to name as gained, in place of the partitions. ``marks``
    are small files that a new table gets.
    """
    recover(spark, path, len(partition_by))
    changes.begin(spark, path)
    staged = _added(path)
    write_partitioned(df, staged, partition_by, sort_by, mode="overwrite")
    written = read_partitioned(spark, staged, df.schema)
    if gained is not None:
        files.write_text(spark, f"{staged}/{changes.GAINED}", json.dumps(sorted(gained(written))))
    if key is not None and files.exists(spark, path) and key_index.is_kept(spark, path):
        key_index.add(spark, path, written, key, len(partition_by))
    for name, text in (marks or {}).items():
        files.write_text(spark, f"{staged}/{name}", text)
    _add_in(spark, path, len(partition_by))


def _add_in(spark: SparkSession, path: str, depth: int) -> None:
    staged = _added(path)
    names = files.partitions(spark, staged, depth)
    if not files.exists(spark, path):
        if not changes.are_kept(spark, staged):
            changes.note(spark, staged, 1, names, _gained(spark, staged))
        files.move(spark, staged, path)
        files.delete(spark, f"{path}/{changes.GAINED}")
        return
    _note(spark, path, staged, names)
    present = set(files.partitions(spark, path, depth))
    for name in names:
        if name not in present:
            files.move(spark, f"{staged}/{name}", f"{path}/{name}")
            continue
        for part in files.names(spark, f"{staged}/{name}"):
            files.move(spark, f"{staged}/{name}/{part}", f"{path}/{name}/{part}")
    files.delete(spark, staged)


def _move_in(spark: SparkSession, path: str, depth: int) -> None:
    # The first build of a table is one move, however many partitions it has.
    if not files.exists(spark, path):
        files.move(spark, _pending(path), path)
        return
    # A partition is gone from the waiting folder once it is in place, so a second
    # call only repeats what is left.
    files.make_dirs(spark, path)
    names = files.partitions(spark, _pending(path), depth)
    _note(spark, path, _pending(path), names)
    for name in names:
        files.delete(spark, f"{path}/{name}")
        files.move(spark, f"{_pending(path)}/{name}", f"{path}/{name}")
    files.delete(spark, _pending(path))


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    also_empty: Sequence[str] = (),
    gained: Sequence[str] | None = None,
    noted: bool = False,
) -> None:
    """Replaces exactly the partitions that ``df`` has rows for.

    ``df`` may read from ``path``. ``also_empty`` names partition directories that
    lose their old rows even if ``df`` brings none. ``gained`` names those that have new
    rows, where changes of the table are kept and these are not all. A first build with
    ``noted`` begins to keep them.
    """
    if files.is_complete(spark, _pending(path)):
        raise RuntimeError(f"{path} has a replacement to finish first: call recover")
    files.delete(spark, _pending(path))
    for name in also_empty:
        files.make_dirs(spark, f"{_pending(path)}/{name}")
    if gained is not None:
        files.write_text(spark, f"{_pending(path)}/{changes.GAINED}", json.dumps(sorted(gained)))
    write_partitioned(df, _pending(path), partition_by, sort_by, mode="append")
    if noted and not files.exists(spark, path):
        changes.note(spark, _pending(path), 1, None)
    _move_in(spark, path, len(partition_by))


def incremental_replace(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    layout: Layout,
    sort_by: Sequence[str] = (),
    full_refresh: bool = False,
    noted: bool = False,
) -> None:
    """``delete_insert`` into a table laid out by a date among its keys.

    With ``noted`` the table's changes are kept. Equal keys lie in the same partition, so
    only the partitions of the batch can lose rows: those are read back and rewritten, and
    the cost follows the batch and not the table. Partitions the table does not have yet are
    moved in unread.
    """
    if layout.day not in keys:
        raise ValueError(f"{layout.day} must be one of the keys {list(keys)}")
    recover(spark, path, 1)
    if noted:
        changes.begin(spark, path)
    batch = layout.add_to(batch)
    partition_by = [layout.column]
    if full_refresh:
        rebuild_partitioned(spark, batch, path, partition_by, sort_by, noted)
        return
    if not files.exists(spark, path):
        replace_partitions(spark, batch, path, partition_by, sort_by, noted=noted)
        return

    # The batch is needed for its partitions, its keys and its rows: compute it once.
    staged = f"{path.rstrip('/')}.batch"
    files.delete(spark, staged)
    write_partitioned(batch, staged, partition_by, sort_by)
    present = set(files.partitions(spark, path, 1))
    shared = [name for name in files.partitions(spark, staged, 1) if name in present]
    if not shared:
        files.move(spark, staged, _pending(path))
        _move_in(spark, path, 1)
        return

    touched = read_partitioned(spark, path, batch.schema, only=shared)
    fresh = read_partitioned(spark, staged, batch.schema)
    replace_partitions(spark, delete_insert(touched, fresh, keys), path, partition_by, sort_by)
    files.delete(spark, staged)


def replace_keys(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    key: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    gained: Callable[[DataFrame], Sequence[str]] | None = None,
) -> None:
    """Replaces the rows whose ``key`` comes again in ``batch``, in whatever partition they lie.

    ``gained`` as for ``append_partitions``. The partitions to rewrite are those that hold a
    key of the batch, and those that gain rows. The first time the key column of the whole
    table is read to find them; from then on an index of key ranges names partitions, and the
    key is read of those only.
    """
    recover(spark, path, len(partition_by))
    if not files.exists(spark, path):
        append_partitions(spark, batch, path, partition_by, sort_by, gained)
        return
    changes.begin(spark, path)
    staged = f"{path.rstrip('/')}.batch"
    files.delete(spark, staged)
    write_partitioned(batch, staged, partition_by, sort_by)
    fresh = read_partitioned(spark, staged, batch.schema)
    stored = read_partitioned(spark, path, batch.schema)
    # Folder names are read from the files' own paths, as they must be found again.
    depth = len(partition_by)
    folder = key_index.folder_of(depth)
    present = set(files.partitions(spark, path, depth))
    if key_index.is_kept(spark, path):
        named = key_index.folders(spark, path, fresh, key)
        may = sorted(present & {n if n in present else unquote(n) for n in named})
        stored = read_partitioned(spark, path, batch.schema, only=may)
    else:
        key_index.add(spark, path, stored, key, depth)
    known = stored.select(key, folder.alias("folder"))
    old = known.join(fresh.select(key), key, "left_semi").select("folder").distinct()
    key_index.add(spark, path, fresh, key, depth)
    arriving = files.partitions(spark, staged, len(partition_by))
    gaining = present.intersection(arriving)
    losing = {_same_name(row.folder, present) for row in old.collect()}
    touched = sorted(losing | gaining)
    rest = read_partitioned(spark, path, batch.schema, only=touched)
    replaced = delete_insert(rest, fresh, [key])
    told = arriving if gained is None else gained(fresh)
    replace_partitions(
        spark, replaced, path, partition_by, sort_by, also_empty=touched, gained=told
    )
    files.delete(spark, staged)


def _same_name(folder: str, names: set[str]) -> str:
    """The directory that a file's path names; paths may be given with escapes once more."""
    plain = folder if folder in names else unquote(folder)
    if plain not in names:
        raise RuntimeError(f"no partition {folder}")
    return plain


def _swap_in(spark: SparkSession, path: str) -> None:
    path = path.rstrip("/")
    if files.is_complete(spark, f"{path}.next"):
        if files.exists(spark, path):
            files.delete(spark, f"{path}.previous")
            files.move(spark, path, f"{path}.previous")
        files.move(spark, f"{path}.next", path)
    files.delete(spark, f"{path}.previous")


def rebuild_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replaces a whole table; ``df`` may read from ``path``."""
    path = path.rstrip("/")
    df.write.mode("overwrite").parquet(f"{path}.next")
    _swap_in(spark, path)


def rebuild_partitioned(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    noted: bool = False,
    marks: Mapping[str, str] | None = None,
) -> None:
    """``rebuild_table`` for a partitioned table; ``noted`` if its changes are to be kept.

    ``marks`` are small files that the new table gets.
    """
    path = path.rstrip("/")
    write_partitioned(df, f"{path}.next", partition_by, sort_by, mode="overwrite")
    for name, text in (marks or {}).items():
        files.write_text(spark, f"{path}.next/{name}", text)
    if noted:
        changes.note(spark, f"{path}.next", changes.last(spark, path) + 1, None)
    _swap_in(spark, path)


def create_if_absent(df: DataFrame, path: str) -> None:
    """Writes the table unless something is there already."""
    df.write.mode("ignore").parquet(path)
