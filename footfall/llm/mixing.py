"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.tables import kept, need

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3  # of the order's hexadecimal digits: sizes are summed up per these
_BEFORE = (Window.unboundedPreceding, -1)


def _key(source: Column) -> Column:
    """The source as a text that is never NULL."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``source_size``, ``weight`` per source with the target of each.

    ``share`` of all sizes is dealt by weight. A source that would pass ``max_epochs``
    times its size stops there, and the rest is dealt again among the others, until
    nobody passes. If all stop, less than the share is dealt. Only two sums per round
    come to the driver. Weights must not be negative; NULL counts as 0.
    """
    table = sources.withColumns(
        {
            "weight": F.coalesce(F.col("weight").cast("double"), F.lit(0.0)),
            "cap": F.col("source_size") * F.lit(float(max_epochs)),
        }
    )
    total = table.agg(F.sum("source_size")).head()[0] or 0
    rate, stopped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(rate) >= F.col("cap")
        at_cap, weight, count = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).head()
        # Rates only rise, so sources that are full stay full.
        if count == stopped or weight == 0:
            break
        stopped, rate = count, (share * total - at_cap) / weight
    filled = F.least(F.col("cap"), F.col("weight") * F.lit(rate))
    return table.withColumn("target", filled).drop("cap")


def mix(
    df: DataFrame, weights: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: int = 7
) -> DataFrame:
    """All columns of ``df``, with ``source_size``, ``target`` and ``repeats``.

    Columns of ``df`` that have one of these three names are replaced; all others stay,
    whatever their names. ``df`` has ``doc_id`` and ``source``, and its sizes in ``size``;
    ``weights`` has ``source`` (NULL is a source too) and ``weight``, each source once. A
    source's target is reached by repeating all its documents a whole number of times, and
    once more those that come first in a seeded order until half a document at most is
    lacking or over. The order hangs on ``doc_id`` and ``size`` alone, so reruns agree;
    rows alike in both are interchangeable. NULL and empty texts have size 0 and never
    take a repetition beyond the whole ones. Sources without a weight get 0.

    The place of a document in the order is found by summing sizes per bucket of the
    order first, so that no task ever orders a whole source.
    """
    need(df, "doc_id", "source", "size")
    rows = df.select(F.struct("*").alias("row"), "doc_id", "source", "size")
    mixed = _mixed(rows, weights, share, max_epochs, seed)
    new = ["source_size", "target", "repeats"]
    old = [c for c in df.columns if c not in new]
    return mixed.select(*[F.col(f"row.`{c}`") for c in old], *new)


def _mixed(
    df: DataFrame, weights: DataFrame, share: float, max_epochs: float, seed: int
) -> DataFrame:
    sizes = df.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Only sums per source are small and used in each round: computed once.
    sources = kept(
        sizes.withColumn("_key", _key(F.col("source")))
        .join(weights.select(_key(F.col("source")).alias("_key"), "weight"), "_key", "left")
        .drop("_key")
    )
    targets = water_fill(sources, share, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(
        _key(F.col("source")).alias("_key"),
        "source_size",
        "target",
        F.floor(rate).alias("_whole"),
        (F.col("target") - F.floor(rate) * F.col("source_size")).alias("_lacking"),
    )

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), name, "size"))
    placed = df.withColumns({"_key": _key(F.col("source")), "_place": place})
    placed = placed.withColumn("_bucket", F.substring("_place", 1, BUCKET_DIGITS))
    filled = placed.groupBy("_key", "_bucket").agg(F.sum("size").alias("_filled"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(*_BEFORE)
    inside = Window.partitionBy("_key", "_bucket").orderBy("_place").rowsBetween(*_BEFORE)
    starts = filled.select(
        "_key",
        "_bucket",
        F.coalesce(F.sum("_filled").over(before), F.lit(0)).alias("_start"),
    ).join(targets, "_key")
    ahead = F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    middle = ahead + F.col("size") / F.lit(2.0)
    extra = (F.col("size") > 0) & (middle <= F.col("_lacking"))
    return (
        placed.join(starts, ["_key", "_bucket"])
        .withColumn("repeats", F.col("_whole") + extra.cast("long"))
        .drop("_key", "_place", "_bucket", "_start", "_whole", "_lacking")
    )


def cycled_weights(df: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """A weight for each source: the cycle's values in turn, by code point, NULL last.

    The window orders one row per source; empty text is a source of its own, and no rows
    give no weights.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    values = F.array(*[F.lit(w) for w in cycle])
    turn = (F.row_number().over(by_name) - 1) % len(cycle)
    return df.select("source").distinct().select("source", F.get(values, turn).alias("weight"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``repeats`` says, with all columns, whatever their names.

    NULL and 0 are never; a row without text can be repeated like any other. No rows give
    none.
    """
    times = F.explode(F.array_repeat(F.lit(0), F.col("repeats").cast("int")))
    return mixed.select(F.struct("*").alias("row"), times.alias("time")).select("row.*")


def take(
    df: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: int = 7
) -> DataFrame:
    """The rows of ``df`` as often as the mix of its sources takes them.

    Sizes are the words of ``text`` and weights those of ``cycled_weights``. All columns
    stay, whatever their names. NULL and empty texts have size 0 and come as often as their
    source is repeated as a whole; NULL is a source too; no rows give none.
    """
    need(df, "doc_id", "text", "source")
    rows = df.select(
        F.struct("*").alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    mixed = _mixed(rows, cycled_weights(df), share, max_epochs, seed)
    return repeated(mixed.select("row", "repeats")).select("row.*")
