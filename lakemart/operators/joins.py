"""Left lookups that keep their balance when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.quality import hot_keys


def matching(left: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Left semi join: the rows whose `key` is in `ids`, a frame with that column.

    Joined by the key and its hash, so Spark does not take the result as partitioned by the
    key alone. A window or aggregate on the key then first reduces the rows in each task
    and shuffles what is left, and the adaptive split of a key with many rows stays free to
    act; partitioned by the key, all its rows would go into one task.
    """
    listed = ids.select(F.col(key).alias("_id"), F.xxhash64(key).alias("_id_hash"))
    same = (F.col(key) == F.col("_id")) & (F.xxhash64(key) == F.col("_id_hash"))
    return left.join(listed, same, "left_semi")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    name: str,
    spread_by: Sequence[str],
    hot_share: float | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join `right`, unique by its key, as one struct column; null where there is no match.

    Rows without a key travel by a hash of `spread_by`, so they do not pile up in one task. A key
    with very many rows goes into one partition of the shuffle, which the adaptive skew split
    cuts: nothing stands between the shuffles and the join.

    hot_share: plan the split instead. The keys with at least this share of the left rows are
    counted first, by two scans of the key; their rows stay where they are and meet a broadcast
    of those few rows of `right`, at most 2 / hot_share of them; all others go through the shuffle.
    counted: where `left` is costly to scan, a frame with its key to count in; it decides which way
    a row takes, not what comes out.
    """
    left_key, right_key = on
    if hot_share is not None:
        keys = (left if counted is None else counted).where(F.col(left_key).isNotNull())
        rows = hot_keys(keys, left_key, hot_share).collect()
        hot = [row["key"] for row in rows]
        if hot:
            is_hot = F.coalesce(F.col(left_key).isin(hot), F.lit(False))
            few = packed(right.where(F.col(right_key).isin(hot)), right_key, name)
            beside = left.where(is_hot).join(F.broadcast(few), F.col(left_key) == F.col("_key"), "left")
            rest = lookup(left.where(~is_hot), right, on, name, spread_by)
            return beside.drop("_key", "_key_hash").unionByName(rest)
    away = F.xxhash64(F.lit(name), *(F.col(c) for c in spread_by))
    spread = F.when(F.col(left_key).isNull(), away).otherwise(F.xxhash64(left_key))
    left = left.withColumn("_spread", spread)
    joined = left.join(
        packed(right, right_key, name),
        (F.col(left_key) == F.col("_key")) & (F.col("_spread") == F.col("_key_hash")),
        "left",
    )
    return joined.drop("_spread", "_key", "_key_hash")


def packed(right: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of the looked-up side as one struct column, with their key and its hash."""
    whole = F.struct(*(F.col(c) for c in right.columns)).alias(name)
    return right.select(F.col(key).alias("_key"), whole, F.xxhash64(key).alias("_key_hash"))
