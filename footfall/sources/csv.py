"""Typed ingest of CSV files with a header."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from footfall.functions import ids
from footfall.functions.time import ntz
from footfall.sources.schemas import LOAD_TIME, SPARK_TYPES, TABLES, Table
from footfall.storage import files, grain
from footfall.storage.tables import (
    append_partitions,
    read_partitioned,
    rebuild_partitioned,
    replace_keys,
)

# What a missing value becomes in a column that does not take NULL,
# the largest unsigned values, and the shapes of ids and addresses.
MISSING = {
    "uint8": "0",
    "uint32": "0",
    "uint64": "0",
    "float32": "0",
    "float64": "0",
    "decimal": "0",
    "string": "",
    "letter": "",
    "uuid": "00000000-0000-0000-0000-000000000000",
    "ipv4": "0.0.0.0",
    "datetime": "1970-01-01 00:00:00",
    "datetime?": None,
}
_OCTET = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
LARGEST = {"uint8": 255, "uint32": 4294967295}
SHAPES = {
    "letter": r"^.?$",
    "uuid": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    "ipv4": rf"^({_OCTET}\.){{3}}{_OCTET}$",
}

PROBLEMS = "problems"
TEXT = "rejected"
LOADED = "load_ts"
LINE = "line"  # whole text of a line with too few or too many values


def read_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, by header name; stops at a line that does not fit the header.

    Every file's header is checked. ``multiline`` admits line breaks inside quotes, at
    the price that a file can no longer be split between tasks.
    """
    return _reader(spark, multiline).option("mode", "FAILFAST").csv(path)


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    # A quote inside quotes is doubled. Without pruning every line is counted out.
    return spark.read.options(
        header=True,
        quote='"',
        escape='"',
        enforceSchema=False,
        columnPruning=False,
        multiLine=multiline,
    )


def _read_text_and_broken_lines(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    header = _reader(spark, multiline).csv(path).schema
    return (
        _reader(spark, multiline)
        .schema(header.add(LINE, "string"))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        .csv(path)
    )


def _parse(text: Column, kind: str) -> Column:
    """The typed value, or NULL if the text does not fit the kind."""
    if kind == "uint64":
        return ids.from_text(text)
    if kind in LARGEST:
        value = text.try_cast("bigint")
        fits = value.between(0, LARGEST[kind])
        return F.when(fits, value.cast(SPARK_TYPES[kind]))
    if kind in SHAPES:
        value = F.lower(text) if kind == "uuid" else text
        return F.when(value.rlike(SHAPES[kind]), value)
    if kind.startswith("datetime"):
        # Drops a zone suffix and a fraction.
        return F.substring(text, 1, 19).try_cast("timestamp_ntz")
    return text.try_cast(SPARK_TYPES[kind])


def _kinds(raw: DataFrame, table: Table) -> dict[str, str]:
    """Columns to read: those of the table, and system columns that the file may bring."""
    absent = [name for name in table.columns if name not in raw.columns]
    if absent:
        raise ValueError(f"the file has no column {', '.join(absent)}")
    brought = [n for n in table.system if table.system_in_file and n in raw.columns]
    return {**table.columns, **{name: "datetime?" for name in brought}}


def _is_given(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def _typed(
    raw: DataFrame, table: Table, load_ts: datetime, stop: bool, beside: Sequence[Column] = ()
) -> DataFrame:
    """Logical columns of ``table``, and those ``beside`` them. Unreadable text stops the job or
    counts as missing."""

    def value(name: str, kind: str) -> Column:
        text = F.col(f"`{name}`")
        missing = F.lit(MISSING[kind]).cast(SPARK_TYPES[kind])
        if stop:
            problem = F.raise_error(F.concat(F.lit(f"cannot read {name}: "), text))
            missing = F.when(_is_given(text), problem.cast(SPARK_TYPES[kind])).otherwise(missing)
        return F.coalesce(_parse(text, kind), missing)

    kinds = _kinds(raw, table)
    typed = raw.select(*[value(n, kind).alias(n) for n, kind in kinds.items()], *beside)
    for name, sql in table.derived.items():
        typed = typed.withColumn(name, F.expr(sql))
    for name, rule in table.system.items():
        default = ntz(load_ts) if rule == LOAD_TIME else F.col(rule)
        own = F.coalesce(F.col(name), default) if name in kinds else default
        typed = typed.withColumn(name, own)
    return typed


def typed_rows(raw: DataFrame, name: str, load_ts: datetime) -> DataFrame:
    """Table ``name`` from its columns as text; text that does not fit its column stops the job."""
    table = TABLES[name]
    return _typed(raw, table, load_ts, stop=True).select(*table.logical)


def read_csv(
    spark: SparkSession, name: str, path: str, load_ts: datetime, multiline: bool = False
) -> DataFrame:
    """Table ``name`` from its CSV; text that does not fit its column stops the job."""
    return typed_rows(read_text(spark, path, multiline), name, load_ts)


def _checked(
    spark: SparkSession, name: str, path: str, load_ts: datetime, multiline: bool
) -> DataFrame:
    """Logical columns of all rows, the names of bad columns, and a bad row's text."""
    table = TABLES[name]
    raw = _read_text_and_broken_lines(spark, path, multiline)
    bad = [
        F.when(_is_given(F.col(f"`{c}`")) & _parse(F.col(f"`{c}`"), kind).isNull(), F.lit(c))
        for c, kind in _kinds(raw, table).items()
    ]
    bad.append(F.when(F.col(LINE).isNotNull(), F.lit(LINE)))
    problems = F.filter(F.array(*bad), lambda p: p.isNotNull())
    text = F.struct(*[F.col(f"`{c}`") for c in raw.columns], problems.alias(PROBLEMS))
    text = F.when(F.size(problems) > 0, text).alias(TEXT)
    return _typed(raw, table, load_ts, stop=False, beside=[text]).select(*table.logical, TEXT)


def _parted(checked: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    sound = checked.where(F.col(TEXT).isNull()).select(*TABLES[name].logical)
    return sound, checked.where(F.col(TEXT).isNotNull()).select(f"{TEXT}.*")


def read_csv_with_rejects(
    spark: SparkSession, name: str, path: str, load_ts: datetime, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Sound rows of the table, and the others as text with the names of bad columns."""
    return _parted(_checked(spark, name, path, load_ts, multiline), name)


def write_table(df: DataFrame, name: str, target: str, mode: str = "append") -> None:
    """Writes a raw table in its layout.

    ``append`` adds the rows, so the same load twice doubles them; ``replace`` takes out the
    rows whose key comes again; ``overwrite`` takes out all, once the new ones are written;
    ``ignore`` writes only where there is no table yet. Each write is noted in the table's
    folder with the partitions it touched.
    """
    table, spark = TABLES[name], df.sparkSession
    exists = files.exists(spark, target)
    if mode == "ignore" and exists:
        return
    layout = (list(table.partition_by), table.sort_by)
    gained = partial(_days, table) if table.days else None
    if not exists and table.days:
        rows, span, days = _first_rows(df, table, target)
        gained = lambda _: days
    else:
        rows, span = df, grain.of(spark, target)
    marks = {grain.MARK: span} if table.days else {}
    laid_out = _laid_out(rows, table, span)
    if mode == "replace" and exists:
        replace_keys(spark, laid_out, target, table.key, *layout, gained)
    elif mode == "overwrite":
        rebuild_partitioned(spark, laid_out, target, *layout, noted=True, marks=marks)
    else:
        append_partitions(spark, laid_out, target, *layout, gained, marks, table.key)
    files.delete(spark, _first(target))


def _first(target: str) -> str:
    return f"{target.rstrip('/')}.first"


def _first_rows(df: DataFrame, table: Table, target: str) -> tuple[DataFrame, str, list[str]]:
    """The rows of a new table, written down once, the span their bytes ask for, and their days."""
    spark, staged = df.sparkSession, _first(target)
    df.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    days = _days(table, rows)
    return rows, grain.chosen(files.size(spark, staged), len(days)), days


def _days(table: Table, rows: DataFrame) -> list[str]:
    """The days of some rows, of which there are a few thousand at most."""
    (sql,) = table.days.values()
    # Days become text once each, and not once per row.
    found = rows.select(F.expr(sql).alias("day")).distinct().select(F.col("day").cast("string"))
    return sorted(row.day for row in found.collect() if row.day is not None)


def _laid_out(rows: DataFrame, table: Table, span: str) -> DataFrame:
    columns = []
    for column, sql in table.partition_by.items():
        value = F.expr(sql)
        columns.append((grain.start(value, span) if column in table.days else value).alias(column))
    return rows.select("*", *columns)


def regroup(spark: SparkSession, name: str, target: str) -> str:
    """Lays a raw table out again by the span that its bytes ask for now, and returns that.

    For a table that has come to gain much more or less a day than at its first load.
    """
    table = TABLES[name]
    stored = read_partitioned(spark, target, table.schema)
    days = len(_days(table, stored))
    span = grain.chosen(files.size(spark, target), days)
    if span != grain.of(spark, target):
        layout = (list(table.partition_by), table.sort_by)
        rows = _laid_out(stored, table, span)
        rebuild_partitioned(spark, rows, target, *layout, noted=True, marks={grain.MARK: span})
    return span


def ingest(
    spark: SparkSession,
    name: str,
    path: str,
    target: str,
    load_ts: datetime,
    mode: str = "append",
    rejects: str | None = None,
    multiline: bool = False,
) -> int:
    """Loads a CSV into a raw table; returns the number of rows put aside.

    Without a ``rejects`` folder an unreadable value stops the load. With one, its
    row is added there as text, with the moment of the load, and the rest is loaded. The
    CSV is read once and its rows wait beside the target. Rejects are added once the table
    is written, so a load that fails before and is run again does not double them.
    """
    if rejects is None:
        write_table(read_csv(spark, name, path, load_ts, multiline), name, target, mode)
        return 0
    staged = f"{target.rstrip('/')}.load"
    _checked(spark, name, path, load_ts, multiline).write.mode("overwrite").parquet(staged)
    sound, rejected = _parted(spark.read.parquet(staged), name)
    rejected = rejected.withColumn(LOADED, ntz(load_ts))
    write_table(sound, name, target, mode)
    rejected.write.mode("append").parquet(rejects)
    count = rejected.count()
    files.delete(spark, staged)
    return count
