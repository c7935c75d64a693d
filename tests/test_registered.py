"""Every registered query against its check SQL, rows and types."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "decimal(18,4)": "DECIMAL(18,4)",
}


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


# Queries of optional parts are tested with those parts.
OWN = sorted(set(spark_entry.queries()) - set(spark_entry._added))


def test_every_query_has_a_check():
    assert set(OWN) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_rows(spark, connection, name):
    query, sql = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    assert difference(spark, connection, query, sql, SF_DIR) is None


@pytest.mark.parametrize("name", ["behavior_features", "daily_user_orders", "ingest_products"])
def test_types(spark, connection, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    described = connection.execute(f"DESCRIBE {spark_entry.oracle_sql()[name]}").fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == {row[0]: row[1] for row in described}


def test_entry_is_the_feature_table(spark):
    features = spark_entry.entry(spark)
    assert len(features.columns) == 41
    assert features.count() == features.select("user_id").distinct().count() > 0
