"""The test tables in the shapes the library takes.

Each shape is one SQL text that means the same in Spark and in the SQL used to
check results; ``{ntz}`` and ``{text}`` stand for the names of two types.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = """
SELECT event_id AS id, user_id * 20 AS user_id,
  CAST(extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
    + floor(extract(second FROM ts)) AS bigint) AS sequence_number,
  CAST(user_id AS {text}) || '-' || CAST(CAST(ts AS date) AS {text}) || '-'
    || CAST(CAST(floor(extract(hour FROM ts) / 6) AS int) AS {text}) AS session_id,
  CAST(date_trunc('second', ts) AS {ntz}) AS created_at,
  CASE (user_id + extract(day FROM ts)) % 4
    WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser,
  CASE (user_id * 3 + extract(day FROM ts)
      + CAST(floor(extract(hour FROM ts) / 6) AS int) % 2) % 5
    WHEN 0 THEN 'Search' WHEN 1 THEN 'Organic' WHEN 2 THEN 'Facebook' WHEN 3 THEN 'Email'
    ELSE 'Display' END AS traffic_source,
  '/' || event_type || '/' || CAST(event_id % 50 AS {text}) AS uri, event_type
FROM {events}
"""

# 8217 days bring the last order date to 2024-01-30.
ORDERS = """
SELECT order_id, user_id, status, gender, created_at, returned_at, shipped_at, delivered_at,
  num_of_item, greatest(created_at, shipped_at, delivered_at, returned_at) AS updated_at
FROM (SELECT *,
    CASE WHEN status = 'Completed'
      THEN shipped_at + interval 1 day * (1 + order_id % 2) END AS delivered_at,
    CASE WHEN status = 'Completed' AND order_id % 10 = 0
      THEN shipped_at + interval 5 day END AS returned_at
  FROM (SELECT *,
      CASE WHEN status <> 'Processing'
        THEN created_at + interval 1 day * (1 + order_id % 3) END AS shipped_at
    FROM (SELECT o_orderkey AS order_id, o_custkey AS user_id,
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Cancelled'
          ELSE 'Processing' END AS status,
        CASE o_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
        o_orderdate + interval 8217 day AS created_at,
        CAST(1 + o_orderkey % 4 AS bigint) AS num_of_item
      FROM {orders}) a) b) c
"""

# The orders table as it stood at a moment: later orders absent, later stamps unknown.
ORDERS_AT = """
SELECT order_id, user_id, status, gender, created_at, returned_at, shipped_at, delivered_at,
  num_of_item, greatest(created_at, shipped_at, delivered_at, returned_at) AS updated_at
FROM (SELECT order_id, user_id, gender, created_at, num_of_item,
    CASE WHEN status = 'Completed' AND delivered_at < {moment} THEN 'Completed'
      WHEN status = 'Cancelled' AND shipped_at < {moment} THEN 'Cancelled'
      ELSE 'Processing' END AS status,
    CASE WHEN returned_at < {moment} THEN returned_at END AS returned_at,
    CASE WHEN shipped_at < {moment} THEN shipped_at END AS shipped_at,
    CASE WHEN delivered_at < {moment} THEN delivered_at END AS delivered_at
  FROM ({all_orders}) o WHERE created_at < {moment}) s
"""

ORDER_ITEMS = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS sale_price,
  l_shipdate + interval 8217 day AS moment
FROM {lineitem}
"""

USERS = """
SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
  lower(c_name) || '@example.com' AS email, CAST(18 + c_custkey % 60 AS smallint) AS age,
  CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
  'State ' || CAST(c_custkey % 50 AS {text}) AS state,
  CAST(c_custkey AS {text}) || ' "High" Street, Flat ' || chr(92) AS street_address,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(10000 + c_custkey AS {text}) END AS postal_code,
  n_name AS city, 'Country ' || CAST(n_regionkey AS {text}) AS country,
  c_acctbal AS latitude, -c_acctbal AS longitude,
  CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE c_mktsegment END AS traffic_source,
  CAST('2020-01-01 00:00:00' AS {ntz}) + interval 1 day * (c_custkey % 1000)
    + interval 1 second * (c_custkey % 86400) AS created_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

FULL_EVENTS = """
SELECT id, user_id, sequence_number,
  substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-' || substring(h, 13, 4) || '-'
    || substring(h, 17, 4) || '-' || substring(h, 21, 12) AS session_id,
  created_at, '10.' || CAST(id % 256 AS {text}) || '.0.' || CAST(user_id % 256 AS {text})
    AS ip_address,
  'City ' || CAST(user_id % 90 AS {text}) AS city, '' AS state,
  CAST(10000 + user_id AS {text}) AS postal_code, browser, traffic_source, uri, event_type
FROM (SELECT *, md5(session_id) AS h FROM ({all_events}) a) e
"""

FULL_ORDER_ITEMS = """
SELECT l_orderkey * 10 + l_linenumber AS id, order_id, user_id, l_partkey AS product_id,
  l_suppkey AS inventory_item_id, status, created_at, shipped_at, delivered_at, returned_at,
  l_extendedprice AS sale_price
FROM {lineitem} JOIN ({all_orders}) o ON l_orderkey = order_id
"""

PRODUCTS = """
SELECT p_partkey AS id, CAST(p_retailprice * 0.5 AS decimal(18,4)) AS cost, p_type AS category,
  p_name AS name, p_brand AS brand, CAST(p_retailprice AS decimal(18,4)) AS retail_price,
  CASE p_partkey % 2 WHEN 0 THEN 'Women' ELSE 'Men' END AS department,
  p_brand || '/' || CAST(p_size AS {text}) AS sku, p_partkey % 10 AS distribution_center_id
FROM {part}
"""

DISTRIBUTION_CENTERS = """
SELECT s_suppkey AS id, s_name AS name,
  CAST(s_nationkey * 1.5 AS {float}) AS latitude, CAST(s_nationkey * -0.25 AS {float}) AS longitude
FROM {supplier}
"""

INVENTORY_ITEMS = """
SELECT p_partkey * 2 AS id, p_partkey AS product_id,
  CAST('2022-01-01 00:00:00' AS {ntz}) + interval 1 day * (p_partkey % 400) AS created_at,
  CASE WHEN p_partkey % 3 <> 0 THEN CAST('2023-06-01 12:00:00' AS {ntz})
    + interval 1 hour * (p_partkey % 99) END AS sold_at,
  p_retailprice / 2 AS cost, p_type AS product_category, p_name AS product_name,
  p_brand AS product_brand, p_retailprice AS product_retail_price, '' AS product_department,
  p_brand || '/' || CAST(p_size AS {text}) AS product_sku,
  p_partkey % 10 AS product_distribution_center_id
FROM {part}
"""

_INPUTS = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_SPARK = {"ntz": "timestamp_ntz", "text": "string", "float": "float"}
_CHECK = {"ntz": "timestamp", "text": "varchar", "float": "float"}

RAW = {
    "users": USERS,
    "orders": ORDERS,
    "order_items": FULL_ORDER_ITEMS,
    "events": FULL_EVENTS,
    "products": PRODUCTS,
    "distribution_centers": DISTRIBUTION_CENTERS,
    "inventory_items": INVENTORY_ITEMS,
}


def _fill(sql: str, inputs: dict[str, str], types: dict[str, str]) -> str:
    values = {**inputs, **types}
    values["all_orders"] = ORDERS.format(**values)
    values["all_events"] = EVENTS.format(**values)
    return sql.format(**values)


def check_sql(sql: str) -> str:
    """The text for the SQL engine that checks results."""
    return _fill(sql, {name: name for name in _INPUTS}, _CHECK)


def _moment(moment: datetime) -> str:
    return "CAST('" + moment.isoformat(sep=" ") + "' AS {ntz})"


def orders_at_sql(moment: datetime) -> str:
    text = ORDERS_AT.replace("{moment}", _moment(moment))
    return check_sql(text)


def read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    inputs = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in _INPUTS}
    return spark.sql(_fill(sql, inputs, _SPARK))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, EVENTS)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, ORDERS)


def orders_at(spark: SparkSession, sf_dir: str, moment: datetime) -> DataFrame:
    """The rows of ``ORDERS_AT``, each worked out once.

    A filter on ``updated_at`` would else hold the whole text of it for every comparison: a
    method too long for the JVM to compile. Spark moves no filter below ``inline``.
    """
    rows = read(spark, sf_dir, ORDERS_AT.replace("{moment}", _moment(moment)))
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, ORDER_ITEMS)


def write_csv(df: DataFrame, path: str) -> None:
    """Text as the raw files have it: moments carry a zone suffix, some also a fraction."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name).cast("string")
        if kind == "timestamp_ntz":
            late = F.pmod(F.xxhash64(name), F.lit(2)) == 0
            column = F.concat(column, F.when(late, F.lit(".123456 UTC")).otherwise(F.lit(" UTC")))
        columns.append(column.alias(name))
    df.select(*columns).write.csv(path, header=True, quote='"', escape='"')
