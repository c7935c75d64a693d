"""Point-in-time joins where one key may have most facts and very many versions.

Facts and versions are sorted together by key and time and cut into ranges, whatever key
they belong to. In a range each fact takes the last version before it; a range that begins
within a key takes over the last version of that key from the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.storage.files import shared_folder

RANGE_ROWS = 1_000_000
_TASK_BITS = 33  # of monotonically_increasing_id that count rows


def _placed(facts: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str]):
    version = F.struct(
        F.col("valid_to").alias("until"), *[F.col(c).alias(f"{c}_as_of") for c in columns]
    )
    versions = history.select(
        F.col(key).alias("key"),
        F.col("valid_from").alias("at"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("salt"),
        version.alias("version"),
    )
    packed = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    rows = facts.select(
        F.col(key).alias("key"),
        F.col(moment).alias("at"),
        F.lit(1).alias("kind"),
        F.xxhash64(packed).alias("salt"),
        packed.alias("fact"),
    )
    return versions.unionByName(rows, allowMissingColumns=True)


def as_of_join_by_ranges(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    moment: str,
    columns: Sequence[str],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``as_of_join`` in ranges of ``range_rows`` facts and versions at most.

    The same rows as ``operators.history.as_of_join``, of versions that do not overlap. Facts
    with a NULL key or moment meet none. Rows pass two shuffles, and are written down in
    between, since all steps must see the same ranges. A task sorts many ranges and cuts them
    by row numbers, so that short ranges make no more tasks or files. What is computed for keys
    that reach over several ranges has two rows per range at most.
    """
    spark = facts.sparkSession
    rows = _placed(facts, history, key, moment, columns)
    order = ["key", "at", "kind", "salt"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of a row's number are the task's, the lower ones count its rows.
    upper = F.shiftleft(F.shiftright("row", _TASK_BITS), _TASK_BITS)
    lower = F.expr(f"(row & {(1 << _TASK_BITS) - 1}) div {range_rows}")
    numbered = ranged.withColumn("row", F.monotonically_increasing_id())
    path = shared_folder(spark)
    numbered.withColumn("part", upper + lower).drop("row").write.parquet(path)
    placed = spark.read.schema(f"{_ddl(rows)}, part bigint").parquet(path)

    # Keys that reach over several ranges begin one of them and end another.
    ends = placed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    wide = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("key"))
    wide = wide.where("key IS NOT NULL").groupBy("key").count().where("count > 1").select("key")
    last = F.max_by("version", F.when(F.col("kind") == 0, F.col("at")))
    per_range = placed.join(F.broadcast(wide), "key", "left_semi").groupBy("part", "key")
    per_range = per_range.agg(last.alias("last"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_range.select(
        "part", "key", F.last("last", ignorenulls=True).over(earlier).alias("carried")
    ).where("carried IS NOT NULL")

    before = Window.partitionBy("part", "key").orderBy("at", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    met = placed.withColumn("found", F.last("version", ignorenulls=True).over(before))
    met = met.where("kind = 1").join(carried, ["part", "key"], "left")
    found = F.coalesce("found", "carried")
    valid = (found["until"] > F.col("at")) | found["until"].isNull()
    found = F.when(F.col("key").isNotNull() & F.col("at").isNotNull() & valid, found)
    return met.select(
        "fact.*", *[found[f"{c}_as_of"].alias(f"{c}_as_of") for c in columns]
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
