"""Files sorted by key with Bloom filters, and the lookups that pass over most of a partition."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakemart.functions.dates import with_date_partitions
from lakemart.plans import jobs
from lakemart.operators.upsert import upsert
from lakemart.session import MOST_LISTED, job_settings
from lakemart.sources.tables import read_table, write_table

KEYS = ("order_id", "status_id", "created_at")


@pytest.fixture
def small_row_groups(spark):
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", str(1 << 18))
    yield
    settings.unset("parquet.block.size")


def events(spark, n):
    """Two events of each of n / 2 orders, in the order of a hash, over two days."""
    made = spark.range(n).select(
        F.concat(F.lit("o"), F.pmod(F.xxhash64(F.col("id") % (n // 2)), F.lit(10**12))).alias("order_id"),
        F.col("id").cast("string").alias("status_id"),
        F.lit("PLACED").alias("value"),
        F.timestamp_add("HOUR", (F.col("id") % 48).cast("int"), F.lit("2018-01-01").cast("timestamp_ntz")).alias("created_at"),
    )
    return with_date_partitions(made, "created_at")


def rows_scanned(df):
    """(rows returned, rows that the scan gave); a plan without a shuffle."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return len(found), plan.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_a_few_orders_read_a_few_row_groups(spark, tmp_path, small_row_groups):
    path = str(tmp_path / "events")
    rows = events(spark, 200_000)
    with job_settings(spark):
        upsert(spark, path, rows, KEYS, key_fixes_partition=True)
        upsert(spark, path, rows.where("cast(status_id AS int) % 10 = 0"), KEYS, key_fixes_partition=True)
        files = glob.glob(f"{path}/*/*/*/*.parquet")
        groups = sum(pq.ParquetFile(f).num_row_groups for f in files)
        for f in files:
            ids = pq.ParquetFile(f).read(["order_id"])["order_id"].to_pylist()
            assert ids == sorted(ids)
        assert groups >= 16
        table = read_table(spark, path)
        ids = table.select("order_id").distinct().orderBy("order_id").limit(3)
        found, scanned = rows_scanned(jobs.history_of(table, ids))
        assert found == 6
        # A key is in one row group of a file at most, or in two that meet there.
        assert scanned <= 200_000 / groups * 3 * len(files) < 200_000 / 2
        absent = spark.createDataFrame([("o5x",)], "order_id string")
        assert rows_scanned(jobs.history_of(table, absent)) == (0, 0)


def test_few_and_many_ids_give_the_same_history(spark, rows):
    table = events(spark, 2_000)
    every = table.select("order_id").distinct()
    for n in (0, 1, MOST_LISTED, MOST_LISTED + 1):
        ids = every.orderBy("order_id").limit(n)
        asked = ids.unionAll(ids).unionAll(spark.createDataFrame([(None,)], "order_id string"))
        wanted = table.join(ids, "order_id").select(*table.columns)
        assert rows(jobs.history_of(table, asked)) == rows(wanted)


def test_partitions_without_a_value_stay_null(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("b", None, "x"), ("a", None, "y"), ("c", "", "z"), (None, "2018", "w"), ("a", "2018", "v")],
        "k string, year_partition string, month_partition string",
    )
    for sort_by in (None, "k"):
        path = str(tmp_path / str(sort_by))
        write_table(df, path, ["year_partition", "month_partition"], sort_by=sort_by)
        wanted = [(k, y or None, m) for k, y, m in df.collect()]
        assert rows(read_table(spark, path, ["year_partition", "month_partition"])) == sorted(wanted, key=repr)
