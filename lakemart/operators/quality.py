"""Checks on loaded tables: completeness, uniqueness, nulls, skew."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import known_zone
from lakemart.schemas import DATE_PARTITIONS


class QualityError(Exception):
    """A table does not hold what it should."""


def _sides(source: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key once, with whether the source and the table have it.

    Grouping takes null as equal to null, needs one shuffle for both sides, and a key with
    many rows sends one row per task.
    """
    both = source.select(*keys, F.lit(True).alias("in_source")).unionAll(
        table.select(*keys, F.lit(False).alias("in_source"))
    )
    return both.groupBy(*keys).agg(
        F.bool_or("in_source").alias("in_source"), F.bool_or(~F.col("in_source")).alias("in_table")
    )


def missing_keys(source: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys the table does not have: an anti join of the keys, null safe."""
    return _sides(source, table, keys).where("in_source AND NOT in_table").select(*keys)


def require_complete(source: DataFrame, table: DataFrame, keys: Sequence[str]) -> None:
    missing = missing_keys(source, table, keys).count()
    if missing:
        raise QualityError(f"{missing} source keys are missing from the table")


def id_counts(source: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys in the source, in the table, in both, and in only one of them."""
    return _sides(source, table, keys).agg(
        F.count_if("in_source").alias("source_ids"),
        F.count_if("in_table").alias("table_ids"),
        F.count_if(F.expr("in_source AND in_table")).alias("common_ids"),
        F.count_if(F.expr("NOT in_table")).alias("missing_ids"),
        F.count_if(F.expr("NOT in_source")).alias("unexpected_ids"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many rows they have."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, and the rows in which each key is null."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(F.col(key).isNull()).alias(f"null_{key.replace('.', '_')}") for key in keys),
    )


def key_summary(
    df: DataFrame, unique: Sequence[str], not_null: Sequence[str] = ()
) -> dict[str, int]:
    """Rows, most rows of one key, and rows in which each of `not_null` is null; one job."""
    per_key = df.groupBy(*(F.col(key).alias(key.replace(".", "_")) for key in unique)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(key).isNull()).alias(f"_null_{i}") for i, key in enumerate(not_null)),
    )
    return (
        per_key.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
            F.coalesce(F.max("_rows"), F.lit(0)).alias("max_rows_per_key"),
            *(
                F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"null {key}")
                for i, key in enumerate(not_null)
            ),
        )
        .first()
        .asDict()
    )


def require_keys(df: DataFrame, unique: Sequence[str], not_null: Sequence[str] = ()) -> int:
    """Raise when the `unique` columns repeat, or one of `not_null` is null; else the row count."""
    summary = key_summary(df, unique, not_null)
    row_count, most = summary.pop("row_count"), summary.pop("max_rows_per_key")
    if any(summary.values()):
        raise QualityError(f"null keys: {summary}")
    if most > 1:
        raise QualityError(f"{list(unique)} is not unique: one key has {most} rows")
    return row_count


def partition_counts(df: DataFrame, partitions: Sequence[str] = DATE_PARTITIONS) -> DataFrame:
    return df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("row_count"))


def partition_skew(df: DataFrame, partitions: Sequence[str] = DATE_PARTITIONS) -> DataFrame:
    """One row: number of partitions, their mean and largest row count, and the ratio."""
    counts = partition_counts(df, partitions)
    return counts.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("row_count").alias("total_rows"),
        F.avg("row_count").alias("mean_rows"),
        F.median("row_count").alias("median_rows"),
        F.max("row_count").alias("max_rows"),
        (F.max("row_count") / F.avg("row_count")).alias("max_over_mean"),
    )


# The sketch keeps so many items for each one that may be hot: its error is then below a fourth of
# the share asked for (3.5 of its size, which is at least half of what is asked for).
ITEMS_PER_HOT_KEY = 32
LEAST_SHARE = 0.0001


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """(key, row_count, row_share): every key, null too, that has at least this share of all rows.

    A sketch of frequent items, merged over the tasks, names the candidates: at most 2 / share of
    them, and no key with the share is missing, as the sketch errs by less than a fourth of it. One more scan
    counts those exactly. Both combine before their shuffle, so no task gets the rows of a key.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share is between {LEAST_SHARE} and 1, not {share}")
    tracked, most = math.ceil(ITEMS_PER_HOT_KEY / share), math.ceil(2 / share)
    text = F.col(key).cast("string")
    found = df.select(text.alias("item")).agg(
        F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(item, {most}, {tracked})").alias("top")
    )
    row = found.first()
    total = row["total"]
    items = [item["item"] for item in row["top"] or ()]
    wanted = text.isNull() | text.isin([item for item in items if item is not None])
    counts = df.where(wanted).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    counts = counts.where(F.col("row_count") >= F.lit(share) * total)
    return counts.withColumn("row_share", F.col("row_count") / total)


def unknown_zones(df: DataFrame, zone: str) -> DataFrame:
    """Rows whose zone name is not null and not known, which get no local time."""
    return df.where(F.col(zone).isNotNull() & known_zone(zone).isNull())
