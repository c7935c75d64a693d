"""The value of each order, kept up to date from newly loaded items.

Items are summed per order and item day, once, when their day has changed; a batch of orders
then finds the sums of its own orders by ranges of their ids. Nothing reads all items again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.functions.money import exact, total
from footfall.storage import changes, files
from footfall.storage.tables import (
    read_partitioned,
    rebuild_partitioned,
    recover,
    replace_partitions,
)

SPAN = 1_000_000  # ids of orders in a range, at least
MOST_RANGES = 32  # or one or two more, that a build cuts its ids into
WIDTH = "_width"  # Spark's readers leave such names out
_RANGE = "order_range"
_STORED = "order_id bigint, order_value struct<high: bigint, low: bigint>, order_range bigint"


def _range(span: int):
    return F.expr(f"order_id div {span}")


def _width(items: DataFrame, span: int) -> int:
    """Ids of a range: as many times ``span`` as leaves ``MOST_RANGES`` ranges.

    Every range has a directory per item day, so with a fixed span they would grow as the ids
    times the days.
    """
    own = _range(span)
    least, largest = items.agg(F.min(own), F.max(own)).head()
    return span if least is None else span * (1 + (largest - least) // MOST_RANGES)


def _width_of(spark: SparkSession, path: str, span: int) -> int:
    """The width of the stored ranges; tables without a record have ``span``."""
    mark = f"{path}/{WIDTH}"
    return int(files.read_text(spark, mark)) if files.exists(spark, mark) else span


def _sums(items: DataFrame, day: str, span: int) -> DataFrame:
    values = items.select("order_id", day, exact(F.col("sale_price")).alias("value"))
    sums = values.groupBy("order_id", day).agg(total(F.col("value")).alias("order_value"))
    return sums.select("order_id", "order_value", _range(span).alias(_RANGE), day)


def update(
    spark: SparkSession, items: str, schema: StructType, day: str, path: str, span: int = SPAN
) -> None:
    """Brings the sums at ``path`` up to the items at ``items``, whose changes are kept.

    ``day`` is the partition column of the items, and ``schema`` their columns with it.
    Only partitions of items that were touched since the last time are read. What is
    written hangs on the items alone, so a run that dies can be repeated. A range has ``span``
    ids, or a multiple of it that the first build chooses and notes in the folder of the sums.
    """
    partition_by, order = [_RANGE, day], ["order_id"]
    recover(spark, path, len(partition_by))
    seen = changes.seen(spark, f"{path}.seen") or 0
    found = changes.since(spark, items, seen)
    if found.touched is None or not files.exists(spark, path):
        rows = read_partitioned(spark, items, schema)
        width = _width(rows, span)
        marks = {WIDTH: str(width)}
        rebuild_partitioned(
            spark, _sums(rows, day, width), path, partition_by, order, marks=marks
        )
    elif found.touched:
        present = files.partitions(spark, items, 1)
        rows = read_partitioned(
            spark, items, schema, only=[name for name in present if name in found.touched]
        )
        # Orders that have no item of such a day any more must lose its sum, too.
        old = [
            name
            for name in files.partitions(spark, path, 2)
            if name.partition("/")[2] in found.touched
        ]
        sums = _sums(rows, day, _width_of(spark, path, span))
        replace_partitions(spark, sums, path, partition_by, order, also_empty=old)
    changes.set_seen(spark, f"{path}.seen", found.last)


def all_values(spark: SparkSession, path: str) -> DataFrame:
    """``order_id`` and ``order_value`` of all orders that have items."""
    return _per_order(read_partitioned(spark, path, StructType.fromDDL(_STORED)))


def _per_order(sums: DataFrame) -> DataFrame:
    return sums.groupBy("order_id").agg(total(F.col("order_value")).alias("order_value"))


def values_of(
    spark: SparkSession, path: str, orders: DataFrame, span: int = SPAN
) -> DataFrame:
    """``all_values`` for ``orders``, by their ranges only.

    ``orders`` is small beside the sums: its ranges come to the driver, as many as there are
    at most.
    """
    own = _range(_width_of(spark, path, span))
    wanted = orders.select(own.alias(_RANGE)).distinct()
    wanted = {f"{_RANGE}={row[0]}" for row in wanted.collect()}
    only = [name for name in files.partitions(spark, path, 1) if name in wanted]
    schema = StructType.fromDDL(_STORED)
    sums = read_partitioned(spark, path, schema, only=only)
    return _per_order(sums.join(orders.select("order_id"), "order_id", "left_semi"))
