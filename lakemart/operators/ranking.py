"""Ranks of rows within a key that no single task could hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.session import scratch_path

TASK_BITS = 33


def ranked(df: DataFrame, key: str, order: Sequence[str], name: str = "rank") -> DataFrame:
    """The rows with their place, from 0, among those of their key in the order of some columns.

    Rows are dealt by ranges of key and order, so a key with any share of them lies in many tasks, in
    turn. The sorted rows are written once, to the shared scratch folder: the second pass counts the
    rows of each key by task, and a key's earlier tasks give the offset of a later one. Rows that are
    equal in key and order take their places by a hash of the whole row. Null is a key, and the
    smallest value. Columns are of types that can be hashed.
    """
    spark = df.sparkSession
    by = [F.col(key).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    # Many rows of a key may be equal in order; a hash of the other columns deals them out too.
    by.append(F.xxhash64(*df.columns))
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    path = scratch_path(spark, "ranked")
    placed = dealt.withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    task = F.shiftright("_at", TASK_BITS)
    runs = placed.groupBy(F.col(key).alias("_key"), task.alias("_task")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row for each key and task that has rows of it.
    before = W.partitionBy("_key").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.shiftright("_at", TASK_BITS) == F.col("_task"))
    joined = placed.join(runs.drop("_rows"), same)
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.withColumn(name, place).drop("_at", "_key", "_task", "_first", "_before")
