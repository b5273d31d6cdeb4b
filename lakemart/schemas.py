"""Declared schemas and the registry of source datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DATE_PARTITIONS = ("year_partition", "month_partition", "day_partition")

STRING, NUMBER, INTEGER = T.StringType(), T.DoubleType(), T.IntegerType()
BOOLEAN, TIME = T.BooleanType(), T.TimestampNTZType()


def columns(*named: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in named])


# The names and types of the source files, the status events and the
# sensitive columns are given by the data, so they are stated here as they are.

MONEY = columns(("value", STRING), ("currency", STRING))

GARNISH_ITEM = columns(
    ("name", STRING),
    ("addition", MONEY),
    ("discount", MONEY),
    ("quantity", NUMBER),
    ("sequence", INTEGER),
    ("unitPrice", MONEY),
    ("categoryId", STRING),
    ("externalId", STRING),
    ("totalValue", MONEY),
    ("categoryName", STRING),
    ("integrationId", STRING),
)

ITEM = columns(
    ("name", STRING),
    ("addition", MONEY),
    ("discount", MONEY),
    ("quantity", NUMBER),
    ("sequence", INTEGER),
    ("unitPrice", MONEY),
    ("externalId", STRING),
    ("totalValue", MONEY),
    ("customerNote", STRING),
    ("garnishItems", T.ArrayType(GARNISH_ITEM)),
    ("integrationId", STRING),
    ("totalAddition", MONEY),
    ("totalDiscount", MONEY),
)

ITEMS = T.ArrayType(ITEM)

# Coordinates are double: typed as long they would lose their decimals.
ORDERS = columns(
    ("cpf", STRING),
    ("customer_id", STRING),
    ("customer_name", STRING),
    ("delivery_address_city", STRING),
    ("delivery_address_country", STRING),
    ("delivery_address_district", STRING),
    ("delivery_address_external_id", STRING),
    ("delivery_address_latitude", NUMBER),
    ("delivery_address_longitude", NUMBER),
    ("delivery_address_state", STRING),
    ("delivery_address_zip_code", STRING),
    ("items", ITEMS),
    ("merchant_id", STRING),
    ("merchant_latitude", NUMBER),
    ("merchant_longitude", NUMBER),
    ("merchant_timezone", STRING),
    ("order_created_at", TIME),
    ("order_id", STRING),
    ("order_scheduled", BOOLEAN),
    ("order_scheduled_date", TIME),
    ("order_total_amount", NUMBER),
    ("origin_platform", STRING),
)

ORDER_STATUSES = columns(
    ("created_at", TIME),
    ("order_id", STRING),
    ("status_id", STRING),
    ("value", STRING),
)

RESTAURANTS = columns(
    ("id", STRING),
    ("created_at", TIME),
    ("enabled", BOOLEAN),
    ("price_range", STRING),
    ("average_ticket", NUMBER),
    ("takeout_time", STRING),
    ("delivery_time", STRING),
    ("minimum_order_value", NUMBER),
    ("merchant_zip_code", STRING),
    ("merchant_city", STRING),
    ("merchant_state", STRING),
    ("merchant_country", STRING),
)

CONSUMERS = columns(
    ("customer_id", STRING),
    ("language", STRING),
    ("created_at", TIME),
    ("active", BOOLEAN),
    ("customer_name", STRING),
    ("customer_phone_area", STRING),
    ("customer_phone_number", STRING),
)

STATUS_EVENTS = ("CONCLUDED", "REGISTERED", "CANCELLED", "PLACED")

SENSITIVE = (
    "cpf",
    "customer_name",
    "customer_phone_number",
    "delivery_address_latitude",
    "delivery_address_longitude",
)


@dataclass(frozen=True)
class Dataset:
    """One source: its file format, declared columns, row keys and time column.

    indexed: columns by whose values the marts look up rows of the whole history.
    """

    name: str
    format: str
    schema: T.StructType
    keys: tuple[str, ...]
    time: str
    indexed: tuple[str, ...] = ()

    @property
    def key_fixes_partition(self) -> bool:
        """A key that holds the time column can never move to another date partition."""
        return self.time in self.keys


DATASETS = {
    dataset.name: dataset
    for dataset in (
        Dataset(
            "orders",
            "json",
            ORDERS,
            ("order_id", "order_created_at"),
            "order_created_at",
            indexed=("order_id", "customer_id", "merchant_id"),
        ),
        Dataset(
            "order_statuses",
            "json",
            ORDER_STATUSES,
            ("order_id", "status_id", "created_at"),
            "created_at",
            indexed=("order_id",),
        ),
        Dataset("restaurants", "csv", RESTAURANTS, ("id",), "created_at"),
        Dataset("consumers", "csv", CONSUMERS, ("customer_id",), "created_at"),
    )
}
