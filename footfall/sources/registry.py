"""Raw tables by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources.schemas import TABLES
from footfall.storage import changes, grain


class Sources:
    """Looks raw tables up by name.

    A table is given as the folder ``ingest`` wrote, or as any DataFrame with the
    table's columns. Events without a user belong to user 0, who may hold a large share of
    them; ``drop_anonymous`` leaves them out.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | str],
        drop_anonymous: bool = False,
    ) -> None:
        unknown = sorted(set(tables) - set(TABLES))
        if unknown:
            raise KeyError(f"not a raw table: {', '.join(unknown)}; known: {', '.join(TABLES)}")
        self._spark = spark
        self._tables = dict(tables)
        self._drop_anonymous = drop_anonymous

    def path(self, name: str) -> str:
        """The folder of a table that was given as one."""
        given = self._tables[name]
        if not isinstance(given, str):
            raise TypeError(f"{name} was not given as a folder")
        return given

    def noted(self, name: str) -> str | None:
        """The folder of a table whose changes are kept, else None."""
        given = self._tables.get(name)
        if isinstance(given, str) and changes.are_kept(self._spark, given):
            return given
        return None

    def __getitem__(self, name: str) -> DataFrame:
        """The table; an ingested one with its partition columns, so that filters can prune.

        Where partitions are longer than a day, a further column holds their first day.
        """
        if name not in self._tables:
            raise KeyError(f"no source given for {name}")
        given = self._tables[name]
        if isinstance(given, str):
            given = self._stored(name, given)
        if name == "events" and self._drop_anonymous:
            return given.where("user_id <> 0")
        return given

    def _stored(self, name: str, path: str) -> DataFrame:
        table = TABLES[name]
        rows = self._spark.read.schema(table.stored_schema).parquet(path)
        span = grain.of(self._spark, path) if table.days else grain.DAY
        if span != grain.DAY:
            # The partition column holds longer spans: it is there for pruning, beside the day.
            for day, sql in table.days.items():
                rows = rows.withColumn(grain.column(day, span), F.col(day))
                rows = rows.withColumn(day, F.expr(sql))
        return rows

    def logical(self, name: str) -> DataFrame:
        """The table without its partition columns."""
        table = TABLES[name]
        spans = {grain.column(day, g) for day in table.days for g in (grain.MONTH, grain.YEAR)}
        df = self[name]
        return df.select(*[c for c in df.columns if c not in {*table.partition_by, *spans}])


def stg_users(sources: Sources) -> DataFrame:
    """Pass-through of ``users``, also registered as a view of this name."""
    users = sources.logical("users")
    users.createOrReplaceTempView("stg_users")
    return users
