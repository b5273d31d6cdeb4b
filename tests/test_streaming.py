import json
from datetime import datetime

from pyspark.sql import functions as F

from lakemart.functions.dates import with_date_partitions
from lakemart.plans import jobs
from lakemart.schemas import DATASETS, DATE_PARTITIONS
from lakemart.sources.tables import read_table
from lakemart.streaming.landing import land_new_files

START, END = datetime(2018, 1, 1), datetime(2018, 1, 3)


def write(folder, name, *ids, day=1):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"order_id": i, "status_id": "s", "value": "PLACED", "created_at": f"2018-01-0{day}T05:00:00Z"})
        for i in ids
    ]
    (folder / name).write_text("\n".join([*lines, "{broken"]) + "\n")


def test_each_file_lands_once_and_feeds_the_interval_jobs(spark, tmp_path, rows):
    source, landing, lake = tmp_path / "in", str(tmp_path / "landing"), str(tmp_path / "lake")
    write(source, "1.json", "a", "b")
    bad = str(tmp_path / "bad")
    first = land_new_files(spark, "order_statuses", str(source), landing, bad)
    assert rows(first, "order_id", "day_partition") == [("a", "01"), ("b", "01")]
    write(source, "2.json", "b", "c", day=2)
    second = land_new_files(spark, "order_statuses", str(source), landing, bad)
    assert rows(second, "order_id", "day_partition") == [
        ("a", "01"), ("b", "01"), ("b", "02"), ("c", "02")
    ]
    assert land_new_files(spark, "order_statuses", str(source), landing).count() == 4

    jobs.ingest(spark, "order_statuses", second, lake, START, END)
    jobs.check_ingest(spark, "order_statuses", second, lake, START, END)
    assert [r["_corrupt_record"] for r in spark.read.parquet(bad).collect()] == ["{broken"] * 2
    raw = read_table(spark, jobs.raw_path(lake, "order_statuses"))
    assert sorted(raw.columns) == sorted(
        [*DATASETS["order_statuses"].schema.names, "extra", "year_partition", "month_partition", "day_partition"]
    )
    assert raw.count() == 4


def test_csv_files_land_too(spark, tmp_path, rows):
    source = tmp_path / "in"
    source.mkdir()
    header = "customer_id,language,created_at,active,customer_name,customer_phone_area,customer_phone_number"
    for i in (1, 2):
        (source / f"{i}.csv").write_text(f"{header}\n{i},pt,2018-01-0{i},true,Ana,11,99\n")
    landed = land_new_files(spark, "consumers", str(source), str(tmp_path / "landing"))
    assert rows(landed, "customer_id", "day_partition") == [("1", "01"), ("2", "02")]


def test_fields_that_come_with_later_files(spark, tmp_path, rows):
    source, landing = tmp_path / "in", str(tmp_path / "landing")
    source.mkdir()
    lots = [{}, {"channel": "app"}, {"channel": "web", "device.info": {"os": "x"}}]
    for i, more in enumerate(lots):
        line = {"order_id": str(i), "status_id": "s", "value": "PLACED", "created_at": "2018-01-01T05:00:00Z", **more}
        (source / f"{i}.json").write_text(json.dumps(line) + "\n")
        landed = land_new_files(spark, "order_statuses", str(source), landing)
    found = landed.withColumn("os", F.variant_get("extra", "$['device.info'].os", "string"))
    found = found.withColumn("channel", F.variant_get("extra", "$.channel", "string"))
    assert rows(found, "order_id", "channel", "os") == [("0", None, None), ("1", "app", None), ("2", "web", "x")]


def test_columns_of_files_landed_before_stay(spark, tmp_path, rows):
    """A landing table of an older version had a column of its own for a field, and no other."""
    source, landing = tmp_path / "in", str(tmp_path / "landing")
    source.mkdir()
    line = {"order_id": "a", "status_id": "s", "value": "PLACED", "created_at": "2018-01-01T05:00:00", "channel": "app"}
    (source / "0.json").write_text(json.dumps(line) + "\n")
    schema = "order_id string, status_id string, value string, created_at timestamp_ntz, channel string"
    old = with_date_partitions(spark.readStream.schema(schema).json(str(source)), "created_at")
    writer = old.writeStream.format("parquet").partitionBy(*DATE_PARTITIONS).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{landing}__progress").start(landing).awaitTermination()
    (source / "1.json").write_text(json.dumps({**line, "order_id": "b", "channel": "web"}) + "\n")
    for _ in range(2):
        landed = land_new_files(spark, "order_statuses", str(source), landing)
        found = landed.withColumn("extra", F.to_json("extra"))
        assert rows(found, "order_id", "channel", "extra") == [("a", "app", None), ("b", None, '{"channel":"web"}')]
