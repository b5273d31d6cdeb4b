"""Newest row per key, and one row per key among duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _newest_first(df: DataFrame, name: str):
    """A variant has no order; its JSON text, with keys sorted, has one."""
    variant = name in df.columns and isinstance(df.schema[name].dataType, T.VariantType)
    return (F.to_json(name) if variant else F.col(name)).desc_nulls_last()


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: str = "one",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key by the `order` columns.

    ties="one" keeps a single row. Rows equal in `order` are told apart by `tie_breakers`,
    or by all other columns, so the choice does not depend on how the rows arrive.
    ties="all" keeps every row that shares the newest place.

    The limit on the row number is applied in each task before the shuffle: a key sends at
    most one row per task, however many rows it has.
    """
    if ties == "all":
        return _latest_with_ties(df, keys, order)
    if ties != "one":
        raise ValueError(f"ties is 'one' or 'all', not {ties!r}")
    if tie_breakers is None:
        tie_breakers = [
            field.name
            for field in df.schema
            if field.name not in {*keys, *order} and not isinstance(field.dataType, T.MapType)
        ]
    # A frame of nothing but keys has equal rows per key, so any order will do.
    newest_first = [_newest_first(df, name) for name in [*order, *tie_breakers] or keys]
    window = W.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")
    )


def _latest_with_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest place per key first, then the rows that hold it.

    A rank over the key would gather all tied rows of a key in one task. The maximum is
    combined before its shuffle, and an adaptive join can split a key with many rows.
    """
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    best = df.groupBy(*(F.col(key).alias(f"_best_{i}") for i, key in enumerate(keys))).agg(
        F.max(place).alias("_newest")
    )
    same = place.eqNullSafe(F.col("_newest"))
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_best_{i}"))
    return df.join(best, same, "left_semi")


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), tie_breakers=None
) -> DataFrame:
    """One row per key; null counts as a key. The same row is kept on every run."""
    return latest(df, keys, order, tie_breakers=tie_breakers)
