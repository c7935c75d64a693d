from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import sample_data
from footfall.functions.time import ntz
from footfall.sources.csv import ingest, read_csv, read_csv_with_rejects
from footfall.sources.registry import Sources, stg_users
from footfall.sources.schemas import TABLES

LOAD = datetime(2024, 6, 1)
UUID = "ABCDEF01-2345-6789-abcd-ef0123456789"
EVENT_HEADER = (
    "id,user_id,sequence_number,session_id,created_at,ip_address,city,state,postal_code,"
    "browser,traffic_source,uri,event_type"
)
EVENT = f"7,42,3,{UUID},2024-01-05 12:34:56.789 UTC,10.0.0.1,Oslo,,0150,Chrome,Email,/a,cart"
ORDER_HEADER = (
    "order_id,user_id,status,gender,created_at,returned_at,shipped_at,delivered_at,num_of_item"
)


@pytest.fixture
def csv(tmp_path):
    def write(*lines: str, name: str = "in.csv") -> str:
        folder = tmp_path / "csv"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n")
        return str(folder)

    return write


def test_values_and_defaults(spark, csv):
    row = read_csv(spark, "events", csv(EVENT_HEADER, EVENT), LOAD).head()
    assert row.session_id == UUID.lower()
    assert row.created_at == datetime(2024, 1, 5, 12, 34, 56)
    assert (row.state, row.postal_code) == ("", "0150")
    assert (row.sys_effective_date, row.sys_create_date) == (row.created_at, LOAD)


def test_columns_are_found_by_name(spark, csv):
    header, values = EVENT_HEADER.split(","), EVENT.split(",")
    path = csv(",".join(reversed(header)) + ",extra", ",".join(reversed(values)) + ",x")
    row = read_csv(spark, "events", path, LOAD).head()
    assert (row.id, row.user_id, row.event_type) == (7, 42, "cart")
    assert read_csv(spark, "events", path, LOAD).columns == TABLES["events"].logical


def test_files_with_other_column_orders_are_refused(spark, csv):
    csv(EVENT_HEADER, EVENT, name="a.csv")
    path = csv(",".join(reversed(EVENT_HEADER.split(","))), EVENT, name="b.csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, "events", path, LOAD).collect()


def test_missing_column(spark, csv):
    with pytest.raises(ValueError, match="uri, event_type"):
        read_csv(spark, "events", csv(EVENT_HEADER.rsplit(",", 2)[0]), LOAD)


def test_missing_values(spark, csv):
    row = read_csv(spark, "events", csv(EVENT_HEADER, "," * 12), LOAD).head()
    assert (row.id, row.user_id, row.browser, row.ip_address) == (0, 0, "", "0.0.0.0")
    assert row.session_id == "00000000-0000-0000-0000-000000000000"
    assert row.created_at == datetime(1970, 1, 1)


def test_order_moments(spark, csv):
    path = csv(
        ORDER_HEADER,
        "1,1,Completed,F,2024-01-01 00:00:00 UTC,,2024-01-02 00:00:00 UTC,2024-01-03 01:00:00 UTC,2",
        "2,1,Processing,M,2024-01-01 00:00:00 UTC,,,,1",
    )
    first, second = read_csv(spark, "orders", path, LOAD).orderBy("order_id").collect()
    assert first.returned_at is None
    assert first.updated_at == first.sys_effective_date == datetime(2024, 1, 3, 1)
    assert second.updated_at == second.created_at


def test_quotes_commas_and_backslashes(spark, csv):
    line = EVENT.replace("Oslo", '"O""s,lo\\"').replace("/a", '"/a\\b"')
    row = read_csv(spark, "events", csv(EVENT_HEADER, line), LOAD).head()
    assert (row.city, row.uri) == ('O"s,lo\\', "/a\\b")


def test_line_breaks_inside_quotes(spark, csv):
    path = csv(EVENT_HEADER, EVENT.replace("Oslo", '"Os\nlo"'), EVENT)
    cities = [r.city for r in read_csv(spark, "events", path, LOAD, multiline=True).collect()]
    assert sorted(cities) == ["Os\nlo", "Oslo"]


BAD = {
    "id": EVENT.replace("7,42", "x,42"),
    "user_id": EVENT.replace("42", "18446744073709551616"),
    "sequence_number": EVENT.replace(",3,", ",4294967296,"),
    "session_id": EVENT.replace(UUID, "not-an-id"),
    "created_at": EVENT.replace("2024-01-05", "2024-13-05"),
    "ip_address": EVENT.replace("10.0.0.1", "10.0.0.256"),
}


@pytest.mark.parametrize("address", ["10.0.0.1.", "10.0.0", ".10.0.0.1", "10.0.0.1.2", "10..0.1"])
def test_addresses_that_only_look_right(spark, csv, address):
    path = csv(EVENT_HEADER, EVENT.replace("10.0.0.1", address))
    sound, rejected = read_csv_with_rejects(spark, "events", path, LOAD)
    assert sound.isEmpty()
    assert rejected.head().problems == ["ip_address"]


@pytest.mark.parametrize("column", BAD)
def test_unreadable_text_stops_the_load(spark, csv, column):
    with pytest.raises(PySparkException, match=f"cannot read {column}"):
        read_csv(spark, "events", csv(EVENT_HEADER, EVENT, BAD[column]), LOAD).collect()


@pytest.mark.parametrize("line", ["7,42,3", EVENT + ",more"])
def test_lines_of_another_length_stop_the_load(spark, csv, line):
    with pytest.raises(Exception, match="Malformed"):
        read_csv(spark, "events", csv(EVENT_HEADER, EVENT, line), LOAD).collect()


def test_rejects(spark, csv):
    path = csv(EVENT_HEADER, EVENT, *BAD.values(), "7,42,3", EVENT + ",more")
    sound, rejected = read_csv_with_rejects(spark, "events", path, LOAD)
    assert [r.id for r in sound.collect()] == [7]
    problems = [r.problems for r in rejected.collect()]
    assert sorted(p[0] for p in problems) == sorted([*BAD, "line", "line"])
    lines = [r.line for r in rejected.collect() if "line" in r.problems]
    assert sorted(lines) == sorted(["7,42,3", EVENT + ",more"])


def test_ingest_counts_rejects(spark, csv, tmp_path):
    target, rejects = str(tmp_path / "events"), str(tmp_path / "rejects")
    path = csv(EVENT_HEADER, EVENT, BAD["id"])
    assert ingest(spark, "events", path, target, LOAD, rejects=rejects) == 1
    assert Sources(spark, {"events": target})["events"].count() == 1


def test_rejects_of_all_loads_stay(spark, csv, tmp_path):
    target, rejects = str(tmp_path / "events"), str(tmp_path / "rejects")
    path = csv(EVENT_HEADER, EVENT, BAD["id"])
    for load in (LOAD, datetime(2024, 6, 2)):
        assert ingest(spark, "events", path, target, load, rejects=rejects) == 1
    stored = spark.read.parquet(rejects)
    assert sorted(r.load_ts for r in stored.collect()) == [LOAD, datetime(2024, 6, 2)]
    assert {r.id for r in stored.collect()} == {"x"}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "events", "rejects"]


def test_a_changed_order_replaces_its_row(spark, csv, tmp_path):
    target, day = str(tmp_path / "orders"), "2024-01-01 00:00:00 UTC"
    old = [f"{n},1,Processing,F,{day},,,,1" for n in (1, 2, 3)]
    ingest(spark, "orders", csv(ORDER_HEADER, *old), target, LOAD, mode="replace")
    new = [f"2,1,Completed,F,{day},,2024-01-05 00:00:00 UTC,,1", f"4,1,Processing,F,{day},,,,1"]
    for _ in range(2):  # the same load again changes nothing
        ingest(spark, "orders", csv(ORDER_HEADER, *new), target, LOAD, mode="replace")
        orders = Sources(spark, {"orders": target})["orders"].collect()
        got = {(r.order_id, r.status, str(r.updated_day)) for r in orders}
        assert len(orders) == 4
        assert got == {
            (1, "Processing", "2024-01-01"),
            (2, "Completed", "2024-01-05"),
            (3, "Processing", "2024-01-01"),
            (4, "Processing", "2024-01-01"),
        }
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "orders"]


def test_replacing_in_a_layout_of_two_levels(spark, csv, tmp_path):
    header = ",".join(TABLES["users"].columns)
    target = str(tmp_path / "users")

    def user(number, source, day="2024-01-05"):
        return f"{number},A,B,a@b,30,F,S,1 St,0150,Oslo,No,1.5,2.5,{source},{day} 00:00:00 UTC"

    ingest(spark, "users", csv(header, user(1, "a b:c"), user(2, ""), user(3, "x")), target, LOAD)
    changed = csv(header, user(1, "y%z"), user(2, "x", "2024-02-05"))
    ingest(spark, "users", changed, target, LOAD, mode="replace")
    got = {r.id: r.traffic_source for r in Sources(spark, {"users": target})["users"].collect()}
    assert got == {1: "y%z", 2: "x", 3: "x"}
    assert Sources(spark, {"users": target})["users"].count() == 3


def test_loading_twice_appends_unless_told_otherwise(spark, csv, tmp_path):
    target, path = str(tmp_path / "events"), csv(EVENT_HEADER, EVENT)
    events = Sources(spark, {"events": target})
    for mode, count in [("append", 1), ("append", 2), ("ignore", 2), ("overwrite", 1)]:
        ingest(spark, "events", path, target, LOAD, mode=mode)
        assert events["events"].count() == count


def test_layout_prunes_and_keeps_empty_text(spark, csv, tmp_path):
    header = ",".join(TABLES["users"].columns)
    path = csv(
        header,
        "1,A,B,a@b,30,F,S,1 St,0150,Oslo,No,1.5,2.5,Email,2024-01-05 00:00:00 UTC",
        "2,A,B,a@b,255,,S,1 St,0150,Oslo,No,1.5,2.5,,2024-02-05 00:00:00 UTC",
    )
    target = str(tmp_path / "users")
    ingest(spark, "users", path, target, LOAD)
    sources = Sources(spark, {"users": target})
    users = stg_users(sources)
    assert users.columns == TABLES["users"].logical
    assert {r.id: r.traffic_source for r in spark.table("stg_users").collect()} == {1: "Email", 2: ""}
    assert {r.id: (r.age, r.gender) for r in users.collect()} == {1: (30, "F"), 2: (255, "")}
    january = sources["users"].where("created_month = '202401'")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month" in plan
    assert january.count() == 1


def test_system_columns_from_the_file(spark, csv):
    columns = [c for c in TABLES["inventory_items"].columns]
    line = "1,2,2024-01-01 00:00:00 UTC,,3.5,c,n,b,9.5,d,s,4"
    plain = read_csv(spark, "inventory_items", csv(",".join(columns), line), LOAD).head()
    assert (plain.sold_at, plain.sys_effective_date) == (None, datetime(2024, 1, 1))
    path = csv(
        ",".join([*columns, "sys_effective_date", "sys_create_date"]),
        line + ",2023-05-05 00:00:00 UTC,",
    )
    own = read_csv(spark, "inventory_items", path, LOAD).head()
    assert (own.sys_effective_date, own.sys_create_date) == (datetime(2023, 5, 5), LOAD)


def test_products_have_exact_prices(spark, csv):
    path = csv(
        ",".join(TABLES["products"].columns), "1,2.51875,Jeans,N,B,49.990001678466797,Men,S,4"
    )
    row = read_csv(spark, "products", path, LOAD).head()
    assert (row.cost, row.retail_price) == (Decimal("2.5188"), Decimal("49.9900"))


def test_registry_knows_its_tables(spark, rows):
    with pytest.raises(KeyError, match="suppliers"):
        Sources(spark, {"suppliers": "x"})
    with pytest.raises(KeyError, match="no source given"):
        Sources(spark, {})["users"]


@pytest.mark.parametrize("name", sorted(TABLES))
def test_every_table_comes_back_from_its_layout(spark, tmp_path, name):
    typed = sample_data.read(spark, "/root/testdata/sf0.001", sample_data.RAW[name])
    csv, target = str(tmp_path / "csv"), str(tmp_path / name)
    sample_data.write_csv(typed, csv)
    assert ingest(spark, name, csv, target, LOAD) == 0
    stored = Sources(spark, {name: target}).logical(name)
    assert stored.schema.simpleString() == TABLES[name].schema.simpleString()
    columns = typed.columns
    assert sorted(map(str, stored.select(columns).collect())) == sorted(map(str, typed.collect()))
    assert stored.where(F.col("sys_create_date") != ntz(LOAD)).isEmpty()
    for column in TABLES[name].partition_by:
        assert list((tmp_path / name).glob(f"**/{column}=*"))
