"""The seven raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Kinds of column -> Spark type. Unsigned integers take the next wider signed type, but
# those of eight bytes a long all the same (see ``functions/ids.py``).
SPARK_TYPES = {
    "uint8": "smallint",
    "uint32": "bigint",
    "uint64": "bigint",
    "float32": "float",
    "float64": "double",
    "decimal": "decimal(18,4)",
    "string": "string",
    "letter": "string",
    "uuid": "string",
    "ipv4": "string",
    "datetime": "timestamp_ntz",
    "datetime?": "timestamp_ntz",
}

LOAD_TIME = "load time"


@dataclass(frozen=True)
class Table:
    """Columns of a table as they come in its file, and how it is laid out on disk.

    ``derived`` gives SQL for columns computed from the others. ``system`` gives the
    columns a load fills in: ``LOAD_TIME``, or the column whose value they take; a
    table with ``system_in_file`` prefers its file's own values. ``key`` tells its rows
    apart. ``partition_by``
    gives SQL for the partition columns, which are extra to the logical ones: a
    partition value that is empty text would come back as NULL.
    """

    columns: Mapping[str, str]
    system: Mapping[str, str]
    partition_by: Mapping[str, str]
    sort_by: tuple[str, ...]
    derived: Mapping[str, str] = field(default_factory=dict)
    system_in_file: bool = False
    key: str = "id"

    @property
    def days(self) -> dict[str, str]:
        """The partition columns that hold a day, and their SQL; they may hold longer spans."""
        return {name: sql for name, sql in self.partition_by.items() if sql.startswith("to_date(")}

    @property
    def wide_ids(self) -> list[str]:
        """Columns whose ids may lie above 2**63 - 1 and are stored less 2**64 then."""
        return [name for name, kind in self.columns.items() if kind == "uint64"]

    @property
    def logical(self) -> list[str]:
        return [*self.columns, *self.derived, *self.system]

    @property
    def schema(self) -> StructType:
        stamps = {name: "datetime" for name in (*self.derived, *self.system)}
        kinds = {**self.columns, **stamps}
        return StructType.fromDDL(", ".join(f"{n} {SPARK_TYPES[k]}" for n, k in kinds.items()))

    @property
    def stored_schema(self) -> StructType:
        """With the partition columns: days, months, or a copy of a logical column."""
        schema = self.schema
        for name, sql in self.partition_by.items():
            if sql in schema.fieldNames():
                schema = schema.add(name, schema[sql].dataType)
            else:
                schema = schema.add(name, "date" if sql.startswith("to_date") else "string")
        return schema


_AT_LOAD = {"sys_effective_date": LOAD_TIME, "sys_create_date": LOAD_TIME}
_AT_CREATION = {"sys_effective_date": "created_at", "sys_create_date": LOAD_TIME}
_BY_DAY = {"created_day": "to_date(created_at)"}

# Names, kinds and keys of the raw tables. Orders are laid out by the
# day of their last change and not of their creation, because that is how a daily
# batch reads them.
TABLES: dict[str, Table] = {
    "users": Table(
        columns={
            "id": "uint32",
            "first_name": "string",
            "last_name": "string",
            "email": "string",
            "age": "uint8",
            "gender": "letter",
            "state": "string",
            "street_address": "string",
            "postal_code": "string",
            "city": "string",
            "country": "string",
            "latitude": "float64",
            "longitude": "float64",
            "traffic_source": "string",
            "created_at": "datetime",
        },
        system=_AT_LOAD,
        partition_by={
            "created_month": "date_format(created_at, 'yyyyMM')",
            "source": "traffic_source",
        },
        sort_by=("created_at", "traffic_source", "id"),
    ),
    "orders": Table(
        columns={
            "order_id": "uint64",
            "user_id": "uint64",
            "status": "string",
            "gender": "string",
            "created_at": "datetime",
            "returned_at": "datetime?",
            "shipped_at": "datetime?",
            "delivered_at": "datetime?",
            "num_of_item": "uint32",
        },
        derived={"updated_at": "greatest(created_at, shipped_at, delivered_at, returned_at)"},
        system={"sys_create_date": LOAD_TIME, "sys_effective_date": "updated_at"},
        partition_by={"updated_day": "to_date(updated_at)"},
        sort_by=("created_at", "user_id", "order_id"),
        key="order_id",
    ),
    "order_items": Table(
        columns={
            "id": "uint64",
            "order_id": "uint64",
            "user_id": "uint64",
            "product_id": "uint64",
            "inventory_item_id": "uint64",
            "status": "string",
            "created_at": "datetime",
            "shipped_at": "datetime?",
            "delivered_at": "datetime?",
            "returned_at": "datetime?",
            "sale_price": "float64",
        },
        system=_AT_CREATION,
        partition_by=_BY_DAY,
        sort_by=("created_at", "user_id", "order_id", "product_id", "inventory_item_id"),
    ),
    "events": Table(
        columns={
            "id": "uint64",
            "user_id": "uint64",
            "sequence_number": "uint32",
            "session_id": "uuid",
            "created_at": "datetime",
            "ip_address": "ipv4",
            "city": "string",
            "state": "string",
            "postal_code": "string",
            "browser": "string",
            "traffic_source": "string",
            "uri": "string",
            "event_type": "string",
        },
        system=_AT_CREATION,
        partition_by=_BY_DAY,
        sort_by=("created_at", "user_id"),
    ),
    "products": Table(
        columns={
            "id": "uint32",
            "cost": "decimal",
            "category": "string",
            "name": "string",
            "brand": "string",
            "retail_price": "decimal",
            "department": "string",
            "sku": "string",
            "distribution_center_id": "uint32",
        },
        system=_AT_LOAD,
        partition_by={"center": "distribution_center_id"},
        sort_by=("distribution_center_id", "category", "id"),
    ),
    "distribution_centers": Table(
        columns={
            "id": "uint32",
            "name": "string",
            "latitude": "float32",
            "longitude": "float32",
        },
        system=_AT_LOAD,
        partition_by={"effective_day": "to_date(sys_effective_date)"},
        sort_by=("name",),
    ),
    "inventory_items": Table(
        columns={
            "id": "uint64",
            "product_id": "uint64",
            "created_at": "datetime",
            "sold_at": "datetime?",
            "cost": "float64",
            "product_category": "string",
            "product_name": "string",
            "product_brand": "string",
            "product_retail_price": "float64",
            "product_department": "string",
            "product_sku": "string",
            "product_distribution_center_id": "uint32",
        },
        system=_AT_CREATION,
        partition_by=_BY_DAY,
        sort_by=("created_at", "product_id"),
        system_in_file=True,
    ),
}
