"""Nested order items: one row per item, one row per garnish item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _each(df: DataFrame, array: str, name: str, keep_empty: bool) -> DataFrame:
    """One row per element of an array.

    The outer form with a filter on the position, because below an inner explode Spark adds
    a filter on the array's size: an array that is just being parsed would be parsed twice.
    """
    rows = df.select("*", F.posexplode_outer(array).alias("_position", name))
    if not keep_empty:
        rows = rows.where("_position IS NOT NULL")
    return rows.drop("_position")


def explode_items(orders: DataFrame, items: str = "items", keep_empty: bool = False) -> DataFrame:
    """One row per item, the item as the struct column `item`.

    An order whose items are null or empty gives no row, or one with a null item when
    `keep_empty` is set.
    """
    return _each(orders, items, "item", keep_empty).drop(items)


def explode_garnish(items: DataFrame, keep_empty: bool = True) -> DataFrame:
    """One row per garnish item of each item, as the struct column `garnish`."""
    rows = _each(items, "item.garnishItems", "garnish", keep_empty)
    return rows.withColumn("item", F.col("item").dropFields("garnishItems"))


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, f"{column}.*")
