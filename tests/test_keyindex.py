"""The index from keys to partition folders, and the jobs that read only what it names."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from lakemart.functions.dates import with_date_partitions
from lakemart.plans import jobs
from lakemart.schemas import ORDERS
from lakemart.sources import keyindex
from lakemart.sources.keyindex import KeyIndex
from lakemart.sources.tables import exists, read_table

YEAR = datetime(2018, 1, 1), datetime(2019, 1, 1)
ORDER = "order_id string, customer_id string, merchant_id string, order_created_at string"
EVENT = "order_id string, status_id string, value string, created_at string"


def orders(spark, *rows):
    df = spark.createDataFrame([(*ids, f"2018-{day}T10:00:00") for *ids, day in rows], ORDER)
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in ORDERS if f.name not in df.columns})
    df = df.withColumn("order_created_at", F.col("order_created_at").cast("timestamp_ntz"))
    return with_date_partitions(df.select(*ORDERS.names), "order_created_at")


def events(spark, *rows):
    df = spark.createDataFrame([(o, s, "PLACED", f"2018-{d}T11:00:00") for o, s, d in rows], EVENT)
    df = df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    return with_date_partitions(df, "created_at")


def folder(day):
    return f"year_partition=2018/month_partition={day[:2]}/day_partition={day[3:]}"


def test_pairs_are_kept_by_every_ingest(spark, tmp_path, rows):
    lake = str(tmp_path / "lake")
    jobs.ingest(spark, "orders", orders(spark, ("1", "c1", "m", "01-01"), ("2", "c2", None, "01-02")), lake, *YEAR)
    more = orders(spark, ("1", "c1", "m", "01-01"), ("1", "c9", "m", "03-03"))
    for _ in range(2):
        jobs.ingest(spark, "orders", more, lake, *YEAR)
        index = jobs.key_index(spark, lake, "orders")
        assert rows(index.pairs()) == sorted(
            [
                ("order_id", "1", folder("01-01")), ("order_id", "1", folder("03-03")), ("order_id", "2", folder("01-02")),
                ("customer_id", "c1", folder("01-01")), ("customer_id", "c9", folder("03-03")),
                ("customer_id", "c2", folder("01-02")), ("merchant_id", "m", folder("01-01")),
                ("merchant_id", "m", folder("03-03")),
            ],
            key=repr,
        )
    asked = spark.createDataFrame([("1",), ("1",), ("7",), (None,)], "x string")
    assert index.folders("order_id", asked) == [folder("01-01"), folder("03-03")]
    assert index.folders("customer_id", asked) == []


def test_a_table_without_index_gets_one_and_a_crowded_one_is_built_anew(spark, tmp_path, rows, monkeypatch):
    lake = str(tmp_path / "lake")
    for i in range(3):
        jobs.ingest(spark, "order_statuses", events(spark, (str(i), "s", f"01-0{i + 1}")), lake, *YEAR)
    index = jobs.key_index(spark, lake, "order_statuses")
    wanted = rows(index.pairs())
    assert len(wanted) == 3
    os.remove(f"{lake}/index/order_statuses/_index.json")
    assert rows(jobs.key_index(spark, lake, "order_statuses").pairs()) == wanted
    first = index._state()["generation"]
    monkeypatch.setattr(keyindex, "FILES_PER_BUCKET", 0)
    assert rows(jobs.key_index(spark, lake, "order_statuses").pairs()) == wanted
    assert index._state()["generation"] != first and not exists(spark, f"{index.path}/{first}")


def test_pairs_stand_before_rows_do(spark, tmp_path, monkeypatch, rows):
    lake = str(tmp_path / "lake")
    jobs.ingest(spark, "order_statuses", events(spark, ("1", "s", "01-01")), lake, *YEAR)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as stopped:
        stopped.setattr(jobs, "upsert", stop)
        with pytest.raises(RuntimeError):
            jobs.ingest(spark, "order_statuses", events(spark, ("2", "s", "01-02")), lake, *YEAR)
    assert jobs.key_index(spark, lake, "order_statuses").pairs().count() == 2
    jobs.ingest(spark, "order_statuses", events(spark, ("2", "s", "01-02")), lake, *YEAR)
    index = jobs.key_index(spark, lake, "order_statuses")
    raw = read_table(spark, jobs.raw_path(lake, "order_statuses"))
    assert index.pairs().count() == 2
    assert jobs.history_of(raw, raw.select("order_id").limit(2), index).count() == 2


def test_a_lookup_does_not_move_the_index(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    index = KeyIndex(spark, str(tmp_path / "index"), ["order_id"])
    days = spark.range(5000).select(
        (F.col("id") % 700).cast("string").alias("order_id"),
        F.timestamp_add("HOUR", (F.col("id") % 720).cast("int"), F.lit("2018-01-01").cast("timestamp_ntz")).alias("t"),
    )
    index.rebuild(with_date_partitions(days, "t"))
    asked = spark.range(40).select(F.col("id").cast("string"))
    found = index.places("order_id", asked)
    wanted = with_date_partitions(days, "t").where("cast(order_id AS int) < 40").select("order_id", "day_partition").distinct()
    assert found.count() == wanted.count() > 100
    plan = plan_of(found)
    scan = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scan) == 1 and "Bucketed: true" in scan[0]
    above = plan.split("FileScan")[0]
    assert "hashpartitioning" in plan and "Exchange" not in above.split("SortMergeJoin")[1].split("Exchange")[0]
    index_side = plan.split("SortMergeJoin")[1].split("FileScan")[0]
    assert "Exchange" not in index_side


def test_marts_read_no_partition_without_touched_orders(spark, tmp_path, rows):
    """Files of partitions that no touched order has rows in are spoilt: nobody opens them."""
    lake = str(tmp_path / "lake")
    first = orders(spark, ("1", "c1", "m1", "01-01"), ("2", "c2", "m2", "02-01"), ("3", "c3", "m1", "03-01"))
    past = events(spark, ("1", "a", "01-01"), ("2", "a", "02-01"), ("3", "a", "03-01"), ("1", "b", "01-05"))
    jobs.ingest(spark, "orders", first, lake, *YEAR)
    jobs.ingest(spark, "order_statuses", past, lake, *YEAR)
    jobs.build_marts(spark, lake, *YEAR)
    april = datetime(2018, 4, 1), datetime(2018, 5, 1)
    jobs.ingest(spark, "order_statuses", events(spark, ("1", "z", "04-02")), lake, *april)
    for table in ("raw/orders", "raw/order_statuses"):
        for day in ("02-01", "03-01"):
            place = tmp_path / "lake" / table / folder(day)
            for name in os.listdir(place):
                if name.endswith(".parquet"):
                    (place / name).write_bytes(b"spoilt")
                    os.remove(place / f".{name}.crc")
    jobs.build_marts(spark, lake, *april)
    marts = read_table(spark, jobs.trusted_path(lake, "order_statuses")).where("order_id = '1'")
    ((status,),) = rows(marts, F.transform("status", lambda s: F.date_format(s["created_at"], "MM-dd")))
    assert status == ["01-01", "01-05", "04-02"]


def test_new_pairs_meet_those_of_their_folders_alone(spark, tmp_path, rows, monkeypatch):
    lake = str(tmp_path / "lake")
    jobs.ingest(spark, "order_statuses", events(spark, ("1", "s", "01-01"), ("2", "s", "02-02")), lake, *YEAR)
    index = jobs.key_index(spark, lake, "order_statuses")
    plans = []
    monkeypatch.setattr(KeyIndex, "_append", lambda self, state, pairs: plans.append((plan_of(pairs), rows(pairs))))
    index.add(events(spark, ("1", "t", "01-01"), ("3", "s", "02-02"), ("1", "u", "02-02")))
    plan, added = plans[0]
    filters = [line for line in plan.splitlines() if "FileScan" in line and "In(folder" in line.replace("EqualTo", "In")]
    assert filters and added == [("order_id", "1", folder("02-02")), ("order_id", "3", folder("02-02"))]


def test_an_index_with_too_many_pairs_gets_more_buckets(spark, tmp_path, rows, monkeypatch):
    lake = str(tmp_path / "lake")
    many = [(str(i), "s", f"01-0{i % 9 + 1}") for i in range(50)]
    jobs.ingest(spark, "order_statuses", events(spark, *many), lake, *YEAR)
    index = jobs.key_index(spark, lake, "order_statuses")
    before, wanted = index._state()["buckets"], rows(index.pairs())
    assert before == keyindex.LEAST_BUCKETS and len(wanted) == 50
    monkeypatch.setattr(keyindex, "PAIRS_PER_BUCKET", 5)
    monkeypatch.setattr(keyindex, "SMALL_BUCKET", 5)
    assert rows(jobs.key_index(spark, lake, "order_statuses").pairs()) == wanted
    assert index._state()["buckets"] == 10 and not index.crowded()


def test_marts_are_given_the_newest_version_of_an_order_alone(spark, tmp_path, rows, monkeypatch):
    lake = str(tmp_path / "lake")
    versions = [("1", "c1", "m1", "01-01"), ("1", "c1", "m1", "01-05"), ("1", "c2", "m1", "02-05"), ("2", "c3", "m2", "02-01")]
    jobs.ingest(spark, "orders", orders(spark, *versions), lake, *YEAR)
    jobs.ingest(spark, "order_statuses", events(spark, ("1", "a", "01-01"), ("3", "b", "01-02")), lake, *YEAR)
    given, real = [], jobs.orders_mart
    monkeypatch.setattr(jobs, "orders_mart", lambda of, *a, **k: given.append(rows(of, "order_id")) or real(of, *a, **k))
    jobs.build_marts(spark, lake, *YEAR)
    assert given == [[("1",), ("2",)]]
    mart = read_table(spark, jobs.trusted_path(lake, "orders"))
    assert rows(mart, "order_id", "customer_id") == [("1", "c2"), ("2", "c3")]
    assert rows(read_table(spark, jobs.trusted_path(lake, "order_statuses")), "order_id") == [("1",), ("3",)]


def test_a_stored_batch_without_repeated_keys_is_merged_from_where_it_lies(spark, tmp_path, rows, monkeypatch):
    lake, real, given = str(tmp_path / "lake"), jobs.upsert, []
    monkeypatch.setattr(jobs, "upsert", lambda *a, **k: given.append(k.get("stored_rows")) or real(*a, **k))
    source = str(tmp_path / "statuses")
    line = '{{"order_id":"{}","status_id":"s","value":"v","created_at":"2018-01-0{}T00:00:00Z"}}'
    once = [line.format(i, 1 + i % 2) for i in range(4)]
    for lines in (once, [*once, *once, line.format(9, 3)]):
        spark.createDataFrame([(x,) for x in lines], "value string").write.mode("overwrite").text(source)
        jobs.ingest(spark, "order_statuses", source, lake, *YEAR)
    assert given == [4, None]
    raw = read_table(spark, jobs.raw_path(lake, "order_statuses"))
    assert rows(raw, "order_id") == [(str(i),) for i in (0, 1, 2, 3, 9)]


def test_landed_rows_are_written_once_and_typed_where_they_are_read(spark, tmp_path, rows):
    source, path = str(tmp_path / "orders"), str(tmp_path / "landed")
    items = '[{\\"name\\":\\"a\\",\\"sequence\\":1}]'
    lines = [f'{{"order_id":"1","order_created_at":"2018-01-01T00:00:00Z","items":"{items}","more":1}}', '{"order_id":"2"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(source)
    landed = jobs.land(spark, "orders", source, path, str(tmp_path / "lake"))
    assert "items: string" in spark.read.parquet(path)._jdf.schema().treeString()
    assert rows(landed, "order_id", "items.name", "day_partition") == [("1", ["a"], "01")]
    assert rows(landed.selectExpr("to_json(extra)")) == [('{"more":1}',)]
    assert rows(jobs.read_rejected_rows(spark, str(tmp_path / "lake"), "orders"), "order_id") == [("2",)]
