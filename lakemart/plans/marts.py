"""The three data marts: frames of the raw layer in, the mart frame out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import to_local, with_date_partitions
from lakemart.functions.privacy import mask
from lakemart.operators.items import explode_items
from lakemart.operators.joins import lookup
from lakemart.operators.latest import dedup, latest
from lakemart.operators.statuses import status_pivot, status_timeline
from lakemart.schemas import DATE_PARTITIONS, ITEMS, SENSITIVE, STATUS_EVENTS


def orders_mart(
    orders: DataFrame,
    statuses: DataFrame,
    consumers: DataFrame,
    restaurants: DataFrame,
    sensitive: Sequence[str] = SENSITIVE,
    salt: str | None = None,
    ties: str = "one",
    hot_share: float | None = None,
) -> DataFrame:
    """One row per order with its consumer, restaurant and last status, masked.

    `order_created_at` becomes the wall clock of the restaurant's zone and gives the date
    partition; the instant stays in `order_created_at_utc` and gives it where the zone is
    missing or unknown. `consumers` and `restaurants` are unique by their ids.
    ties="all" keeps every version and every status that shares the newest instant, and
    with them more than one row for such an order. hot_share: orders of a consumer or restaurant
    with this share of the rows of `orders` meet it by a broadcast; see `lookup`.
    """
    versions = orders
    orders = latest(orders.drop(*DATE_PARTITIONS), ["order_id"], ["order_created_at"], ties)
    status = latest(statuses.drop(*DATE_PARTITIONS), ["order_id"], ["created_at"], ties)
    # Masking goes before the joins: only then do all sensitive columns stay, and masked.
    orders = mask(orders, sensitive, salt)
    consumers = mask(consumers.drop(*DATE_PARTITIONS), sensitive, salt)
    restaurants = mask(restaurants.drop(*DATE_PARTITIONS), sensitive, salt)

    # Both sides are already partitioned by order_id, so this join moves nothing.
    status = status.select(
        F.col("order_id").alias("_status_order"),
        F.struct(*(F.col(name) for name in status.columns)).alias("status"),
    )
    joined = orders.join(
        status, F.col("order_id") == F.col("_status_order"), "left"
    ).drop("_status_order")
    split = {"spread_by": ["order_id"], "hot_share": hot_share, "counted": versions}
    joined = lookup(joined, consumers, ("customer_id", "customer_id"), "consumers", **split)
    joined = lookup(joined, restaurants, ("merchant_id", "id"), "restaurants", **split)
    local = joined.withColumns(
        {
            "order_created_at_utc": F.col("order_created_at"),
            "order_created_at": to_local("order_created_at", "merchant_timezone"),
        }
    )
    # The parts of a row come in the order the joins do not give: sources first, status last.
    packed = ["consumers", "restaurants", "status"]
    plain = [name for name in local.columns if name not in packed]
    dated = F.coalesce("order_created_at", "order_created_at_utc")
    return with_date_partitions(local.select(*plain, *packed), dated)


def orders_partitions(orders: DataFrame) -> DataFrame:
    """The date partitions in which the orders may stand in the orders mart: the UTC date of every
    version and the days beside it, whatever zone a version has now or had before it came again.
    No zone is a day away from UTC."""
    days = orders.select(F.col("order_created_at").cast("date").alias("day")).distinct()
    beside = F.explode(F.array(F.date_sub("day", 1), F.col("day"), F.date_add("day", 1)))
    return with_date_partitions(days.select(beside.alias("day")), "day").select(*DATE_PARTITIONS)


def order_items_mart(orders: DataFrame, ties: str = "one") -> DataFrame:
    """One row per order and item sequence, from the newest version of each order.

    `items` may still be JSON text: then only the newest versions are parsed.
    """
    newest = latest(
        orders.select("order_id", "order_created_at", "items"),
        ["order_id"],
        ["order_created_at"],
        ties,
    )
    if isinstance(newest.schema["items"].dataType, T.StringType):
        newest = newest.withColumn("items", F.from_json("items", ITEMS))
    items = explode_items(newest).withColumn("_sequence", F.col("item.sequence"))
    # All items of an order are in one task already, so this needs no further shuffle.
    items = dedup(items, ["order_id", "_sequence"]).drop("_sequence")
    return with_date_partitions(items, "order_created_at")


def order_statuses_mart(
    statuses: DataFrame, grain: str | None = None, segment: int | None = None
) -> DataFrame:
    """One row per order with the list of its events, on the date of the first one; with a grain,
    one per order and period; with a segment, one per so many events."""
    needed = [name for name in statuses.columns if name not in DATE_PARTITIONS]
    timeline = status_timeline(statuses.select(*needed), grain=grain, segment=segment)
    return with_date_partitions(timeline, "date_partition")


def order_status_times_mart(
    statuses: DataFrame, events: Sequence[str] = STATUS_EVENTS
) -> DataFrame:
    """One row per order with one time column per event, on the date of the first one."""
    return with_date_partitions(status_pivot(statuses, events=events), "date_partition")
