"""Working tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.storage.files import shared_folder


def kept(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written down and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Inside, tables are written from Arrow batches of about ``size``: for rows of megabytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def need(df: DataFrame, *columns: str) -> None:
    """Stops with a clear message if a column is missing or there twice."""
    for name in columns:
        count = df.columns.count(name)
        if count != 1:
            raise ValueError(f"one column {name} is needed, there are {count}")


def narrowed(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; others, whatever their names, are left out."""
    need(df, *types)
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()])
