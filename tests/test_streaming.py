"""Files that arrive one after the other, and micro-batches that come again."""

from __future__ import annotations

import shutil
from datetime import datetime

import pytest

from footfall import Sources
from footfall.sources.schemas import TABLES
from footfall.streaming.loads import load_stream

LOAD = datetime(2024, 6, 1)
HEADER = ",".join(TABLES["orders"].columns)


def order(number, status, shipped="", day="2024-01-01"):
    at = f"{day} 00:00:00 UTC"
    return f"{number},1,{status},F,{at},,{shipped and shipped + ' 00:00:00 UTC'},,1"


@pytest.fixture
def stream(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(checkpoint="checkpoint", **files):
        for name, lines in files.items():
            (tmp_path / "in" / f"{name}.csv").write_text("\n".join([HEADER, *lines]))
        query = load_stream(
            spark,
            "orders",
            str(tmp_path / "in"),
            str(tmp_path / "orders"),
            str(tmp_path / checkpoint),
            LOAD,
        )
        query.awaitTermination()
        orders = Sources(spark, {"orders": str(tmp_path / "orders")})["orders"]
        return sorted((r.order_id, r.status) for r in orders.collect())

    return run


def test_files_are_loaded_by_key(stream):
    assert stream(a=[order(1, "Processing"), order(2, "Processing")]) == [
        (1, "Processing"),
        (2, "Processing"),
    ]
    # A key that comes twice in a micro-batch: the later change stays.
    more = [order(2, "Completed", "2024-01-05"), order(2, "Shipped", "2024-01-03"), order(3, "New")]
    want = [(1, "Processing"), (2, "Completed"), (3, "New")]
    assert stream(b=more) == want
    assert stream() == want


def test_a_repeated_micro_batch_changes_nothing(stream, tmp_path):
    """The driver dies after the rows are in, before the stream has put that down."""
    want = stream(a=[order(1, "Processing"), order(2, "Processing")])
    commits = tmp_path / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    assert stream() == want
    # Even a stream that has forgotten everything loads the same rows once more.
    shutil.rmtree(tmp_path / "checkpoint")
    assert stream(checkpoint="another") == want


def test_unreadable_text_stops_the_stream(stream):
    with pytest.raises(Exception, match="cannot read user_id"):
        stream(a=[order(1, "New").replace("1,1,", "1,x,", 1)])
