"""A folder that files keep arriving in, loaded by key as a stream of micro-batches.

Each micro-batch replaces the rows whose key comes again, so a micro-batch that is repeated
after a failure changes nothing. A key that comes several times in one micro-batch stays once,
with the row that is latest by the table's own moments.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.sources.csv import typed_rows, write_table
from footfall.sources.schemas import TABLES, Table


def latest_per_key(rows: DataFrame, table: Table) -> DataFrame:
    """One row per key: that with the latest effective moment, then the largest by all columns.

    An aggregate, so it combines before its shuffle.
    """
    columns = table.logical
    moment = F.col("sys_effective_date")
    newest = F.max(F.struct(moment.alias("moment"), *[F.col(c).alias(c) for c in columns]))
    return rows.groupBy(F.col(table.key).alias("of")).agg(newest.alias("row")).select(
        *[F.col(f"row.{c}").alias(c) for c in columns]
    )


def load_stream(
    spark: SparkSession,
    name: str,
    folder: str,
    target: str,
    checkpoint: str,
    load_ts: datetime | None = None,
    files_per_batch: int = 1000,
    once: bool = True,
) -> StreamingQuery:
    """Loads the CSV files that arrive in ``folder`` into the raw table ``name`` by key.

    All files have a header with the table's columns in their order. Text that does not fit its
    column stops the stream. ``load_ts`` is the moment of the load, by default that of each
    micro-batch. With ``once`` the query ends when all files there are have been loaded;
    ``checkpoint`` remembers them. Files are taken in the order in which they were written, and
    one target has one stream: its micro-batches do not overlap.
    """
    table = TABLES[name]
    header = ", ".join(f"`{column}` string" for column in table.columns)
    raw = (
        spark.readStream.schema(header)
        .options(header=True, quote='"', escape='"', enforceSchema=False, mode="FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )

    def load(batch: DataFrame, epoch: int) -> None:
        at = load_ts or datetime.now(timezone.utc).replace(tzinfo=None)
        rows = typed_rows(batch, name, at)
        write_table(latest_per_key(rows, table), name, target, mode="replace")

    writer = raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
