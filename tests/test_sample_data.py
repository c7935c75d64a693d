"""The test tables in the library's shapes: what reading them costs."""

from __future__ import annotations

import re
from datetime import date

import sample_data
from footfall import RunParams
from footfall.operators.batch import batch_filter

SF_DIR = "/root/testdata/sf0.001"


def test_a_batch_of_orders_is_found_by_a_method_that_the_jvm_compiles(spark):
    params = RunParams.for_day(date(2024, 1, 25))
    orders = sample_data.orders_at(spark, SF_DIR, params.end)
    execution = batch_filter(orders, "updated_at", params)._jdf.queryExecution()
    modes = spark._jvm.org.apache.spark.sql.execution.ExplainMode
    text = execution.explainString(modes.fromString("codegen"))
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000  # HotSpot's limit of bytes of a method
