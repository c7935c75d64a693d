from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Builds a DataFrame from a DDL schema and tuples; text is cast, so moments can be written."""

    def build(schema: str, *values: tuple):
        names, kinds = zip(*[c.strip().split(" ") for c in schema.split(",")], strict=True)
        text = ", ".join(f"{n} string" for n in names)
        df = spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in row) for row in values], text
        )
        casts = [f"cast({n} as {k}) as {n}" for n, k in zip(names, kinds, strict=True)]
        return df.selectExpr(*casts)

    return build
