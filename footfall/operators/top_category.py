"""The best-scoring category per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_category(category: str, scores: Sequence[str]) -> Column:
    """Aggregate: the category with the highest scores, compared left to right.

    Equal scores go to the smallest category. This is an aggregate and not a
    ranking, so it combines before the shuffle and any number of specifications
    share one pass, with no sort per specification.
    """
    order = F.struct(*[(-F.col(s)).alias(f"by_{i}") for i, s in enumerate(scores)], category)
    return F.min_by(category, order)


def rankings(
    df: DataFrame, keys: Sequence[str], category: str, specs: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Row numbers of the categories of each key, one column per specification.

    ``df`` has one row per key and category, so a group is as long as the list of
    categories, however many raw rows the key has. For the winner alone use
    ``top_category``.
    """
    def rank(scores: Sequence[str]) -> Column:
        best_first = [F.desc(s) for s in scores]
        window = W.partitionBy(*keys).orderBy(*best_first, F.asc(category))
        return F.row_number().over(window).cast("long")

    return df.select(
        *keys, category, *[rank(scores).alias(name) for name, scores in specs.items()]
    )
