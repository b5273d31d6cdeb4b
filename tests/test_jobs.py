"""Marts and jobs on small hand-written orders."""

import gzip
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from lakemart.functions.typing import enforce
from lakemart.operators.quality import QualityError
from lakemart.plans import jobs, marts
from lakemart.plans.ledger import fingerprints
from lakemart.schemas import DATASETS, SENSITIVE
from lakemart.sources.tables import read_table, table_exists

Y2018, Y2019, Y2020 = datetime(2018, 1, 1), datetime(2019, 1, 1), datetime(2020, 1, 1)


def order(id, at, zone="America/Sao_Paulo", items="[]", **values):
    base = dict(
        order_id=id, order_created_at=at, merchant_timezone=zone, items=items, cpf="123",
        customer_id="c1", customer_name="Ana", merchant_id="m1",
        delivery_address_latitude="-23.5", delivery_address_longitude="-46.6",
    )
    return {**base, **values}


def item(*sequences):
    return json.dumps([{"sequence": n, "name": f"item {n}"} for n in sequences])


def status(id, status_id, at, value):
    return dict(order_id=id, status_id=status_id, created_at=at, value=value)


ORDERS = [
    order("1", "2018-12-31T23:30:00.000Z", zone="Asia/Tokyo", items=item(1, 2, 2)),
    order("2", "2018-05-01T12:00:00.000Z", items=item(1, 2), customer_id="nobody", merchant_id=None),
    order("2", "2019-02-01T12:00:00.000Z", items=item(2, 3), customer_id="nobody", merchant_id=None),
    order("3", "2019-01-01T00:00:00.000Z", zone="Mars/Base", items=None),
    order("3", "2019-01-01T00:00:00.000Z", zone="Mars/Base", items=None),
    order("4", "whenever"),
]
STATUSES = [
    status("1", "s1", "2018-12-31T23:31:00.000Z", "PLACED"),
    status("1", "s2", "2019-01-01T00:10:00.000Z", "CONCLUDED"),
    status("2", "s3", "2018-05-01T12:01:00.000Z", "PLACED"),
    status("2", "s4", "2018-05-01T12:01:00.000Z", "REGISTERED"),
    status("2", "s4", "2018-05-01T12:01:00.000Z", "REGISTERED"),
]
RESTAURANTS = [
    "id,created_at,enabled,price_range,average_ticket,takeout_time,delivery_time,"
    "minimum_order_value,merchant_zip_code,merchant_city,merchant_state,merchant_country",
    "m1,2018-01-01T00:00:00Z,true,3,50.0,10,20,30.0,01000,OLD NAME,SP,BR",
    "m1,2018-06-01T00:00:00Z,true,3,50.0,10,20,30.0,01000,SAO PAULO,SP,BR",
]
CONSUMERS = [
    "customer_id,language,created_at,active,customer_name,customer_phone_area,customer_phone_number",
    "c1,pt-br,2018-01-01T00:00:00Z,true,Ana,11,5555",
]


@pytest.fixture
def sources(tmp_path):
    texts = {
        "orders": [json.dumps(row) for row in ORDERS],
        "order_statuses": [json.dumps(row) for row in STATUSES],
        "restaurants": RESTAURANTS,
        "consumers": CONSUMERS,
    }
    paths = {}
    for name, lines in texts.items():
        path = tmp_path / f"{name}.{DATASETS[name].format}"
        path.write_text("\n".join(lines) + "\n")
        paths[name] = str(path)
    return paths


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


def tables(spark, lake, rows):
    """Every table of a lake as sorted rows, and its column names."""
    found = {}
    for layer, names in (
        ("raw", DATASETS),
        ("trusted", ["orders", "order_items", "order_statuses", "order_status_times"]),
    ):
        for name in names:
            table = read_table(spark, f"{lake}/{layer}/{name}")
            columns = sorted(table.columns)
            found[f"{layer}/{name}"] = columns, rows(table, *columns)
    return found


def test_intervals_in_turn_equal_one_interval(spark, sources, tmp_path, rows):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    jobs.run_interval(spark, sources, whole, Y2018, Y2020)
    jobs.backfill(spark, sources, parts, Y2018, Y2020)
    assert tables(spark, whole, rows) == tables(spark, parts, rows)
    jobs.run_interval(spark, sources, parts, Y2018, Y2019)
    again = tables(spark, parts, rows)
    assert {k: v for k, v in again.items() if "trusted" in k} == {
        k: v for k, v in tables(spark, whole, rows).items() if "trusted" in k
    }

    trusted = {row.order_id: row for row in read_table(spark, jobs.trusted_path(parts, "orders")).collect()}
    assert set(trusted) == {"1", "2", "3"}
    one, two, three = (trusted[key] for key in "123")
    # The partition is the restaurant's date, eight and a half hours into the next year.
    assert (one.order_created_at, one.order_created_at_utc) == (
        datetime(2019, 1, 1, 8, 30), datetime(2018, 12, 31, 23, 30)
    )
    assert (one.year_partition, one.month_partition, one.day_partition) == ("2019", "01", "01")
    assert (one.status.value, one.status.status_id) == ("CONCLUDED", "s2")
    assert (one.restaurants.merchant_city, one.consumers.language) == ("SAO PAULO", "pt-br")
    # Two events at one instant still give one row; missing sides are null, not empty.
    assert two.status.status_id == "s4" and two.consumers is None and two.restaurants is None
    assert two.order_created_at_utc == datetime(2019, 2, 1, 12)
    # A zone nobody knows gives no local time; the row stands at its UTC date, and is listed.
    assert three.order_created_at is None and three.status is None
    assert (three.year_partition, three.month_partition, three.day_partition) == ("2019", "01", "01")
    zones = jobs.read_rejected_rows(spark, parts, "order_zones")
    assert rows(zones, "order_id", "merchant_timezone") == [("3", "Mars/Base")]
    assert three.order_created_at_utc == Y2019

    items = read_table(spark, jobs.trusted_path(parts, "order_items"))
    # Item 1 of order 2 is gone with its newer version; the second item 2 of order 1 is a copy.
    assert rows(items, "order_id", "item.sequence") == [("1", 1), ("1", 2), ("2", 2), ("2", 3)]
    assert rows(items, "order_id", "year_partition")[0] == ("1", "2018")

    lists = {r.order_id: r for r in read_table(spark, jobs.trusted_path(parts, "order_statuses")).collect()}
    assert [s.event for s in lists["1"].status] == ["PLACED", "CONCLUDED"]
    assert lists["1"].year_partition == "2018"
    times = {r.order_id: r for r in read_table(spark, jobs.trusted_path(parts, "order_status_times")).collect()}
    assert times["1"].concluded == datetime(2019, 1, 1, 0, 10) and times["1"].cancelled is None


def test_check_finds_what_the_raw_table_lacks(spark, sources, lake):
    with pytest.raises(QualityError, match="2 source keys"):
        jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2019, Y2020)
    jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
    jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
    # An end within a day must not fail what is complete.
    jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, datetime(2019, 1, 1, 6))
    jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, datetime(2019, 1, 1, 6))
    with pytest.raises(QualityError, match="1 source keys"):
        jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2020)


def test_rejected_rows_are_kept(spark, sources, lake, rows):
    for _ in range(2):
        jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
        kept = jobs.read_rejected_rows(spark, lake, "orders")
        assert rows(kept, "order_id", "reject_reasons") == [("4", "order_created_at:unreadable")]


def test_a_lost_row_fails_the_check(spark, sources, lake, tmp_path):
    jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, Y2020)
    jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2020)
    with open(sources["orders"], "a") as f:
        f.write("{cut short\n")
    with pytest.raises(QualityError, match="1 rejected rows kept"):
        jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2020)


def test_backfill_keeps_rejected_rows_and_reports_skew(spark, sources, lake, rows):
    report = jobs.backfill(spark, sources, lake, Y2018, Y2020)
    assert rows(jobs.read_rejected_rows(spark, lake, "orders"), "order_id") == [("4",)]
    assert rows(report, "mart") == [("order_items",), ("order_status_times",), ("order_statuses",), ("orders",)]


def test_later_dimension_rows_reach_earlier_orders(spark, sources, tmp_path, rows):
    """The consumer comes after the order, the restaurant is renewed after it."""
    with open(sources["consumers"], "a") as f:
        f.write("nobody,en,2019-03-01T00:00:00Z,true,Bob,11,7\n")
    with open(sources["restaurants"], "a") as f:
        f.write("m1,2019-06-01T00:00:00Z,true,3,50.0,10,20,30.0,01000,NEW,SP,BR\n")
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    jobs.run_interval(spark, sources, whole, Y2018, Y2020)
    jobs.backfill(spark, sources, parts, Y2018, Y2020, step=timedelta(days=250))
    assert tables(spark, whole, rows) == tables(spark, parts, rows)
    trusted = {r.order_id: r for r in read_table(spark, jobs.trusted_path(parts, "orders")).collect()}
    assert trusted["2"].consumers.language == "en"
    assert trusted["1"].restaurants.merchant_city == "NEW"


def test_a_version_that_comes_again_in_another_zone_moves(spark, sources, lake, rows):
    """The old row is found where the zone put it that the raw table no longer has."""
    days = {"America/Sao_Paulo": "30", "-18:00": "30"}
    zones = ["America/Sao_Paulo", "Asia/Tokyo", "-18:00", None, "America/Sao_Paulo", "Mars/Base"]
    for zone in zones:
        with open(sources["orders"], "w") as f:
            f.write(json.dumps(order("9", "2018-05-01T01:00:00.000Z", zone=zone)) + "\n")
        jobs.run_interval(spark, sources, lake, Y2018, Y2019)
        trusted = read_table(spark, jobs.trusted_path(lake, "orders")).where("order_id = '9'")
        assert rows(trusted, "merchant_timezone", "day_partition") == [(zone, days.get(zone, "01"))]


def test_a_hot_order_is_split_by_the_status_grain_over_intervals(spark, sources, lake, rows):
    """No list is longer than a period's events, and an interval leaves the other periods' lists."""
    start = datetime(2018, 12, 30)
    hours = [start + timedelta(hours=h) for h in range(96)]
    with open(sources["order_statuses"], "w") as f:
        for i, at in enumerate(hours):
            f.write(json.dumps(status("1", f"s{i}", f"{at:%Y-%m-%dT%H:%M:%SZ}", "PLACED")) + "\n")
    jobs.backfill(spark, sources, lake, Y2018, Y2020, status_grain="day")
    lists = read_table(spark, jobs.trusted_path(lake, "order_statuses"))
    days = [start + timedelta(days=d) for d in range(4)]
    assert rows(lists, "order_id", "period", F.size("status")) == [("1", day, 24) for day in days]


@pytest.mark.parametrize("seed", range(1))
def test_any_cuts_give_the_tables_of_one_interval(spark, tmp_path, rows, seed):
    rng = random.Random(seed)
    days = [datetime(2018, 1, 1) + timedelta(days=d) for d in range(0, 60)]
    text = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    at = lambda: text(rng.choice(days) + timedelta(hours=rng.randrange(24)))
    zones = ["Asia/Tokyo", "America/Sao_Paulo", None, "Mars/Base"]
    content = {
        "orders": [
            json.dumps(order(str(rng.randrange(8)), at(), zone=rng.choice(zones), items=item(*range(rng.randrange(4))), customer_id=str(rng.randrange(4)), merchant_id=str(rng.randrange(3))))
            for _ in range(25)
        ],
        "order_statuses": [json.dumps(status(str(rng.randrange(8)), f"s{i}", at(), rng.choice(["PLACED", "CONCLUDED"]))) for i in range(30)],
        "restaurants": [RESTAURANTS[0], *(f"{rng.randrange(3)},{at()},true,3,50.0,10,20,30.0,01000,city {i},SP,BR" for i in range(6))],
        "consumers": [CONSUMERS[0], *(f"{rng.randrange(4)},lang {i},{at()},true,Ana,11,5555" for i in range(8))],
    }
    paths = {}
    for name, lines in content.items():
        path = tmp_path / f"{name}.{DATASETS[name].format}"
        path.write_text("\n".join(lines) + "\n")
        paths[name] = str(path)
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    start, end = days[0], days[-1] + timedelta(days=1)
    jobs.run_interval(spark, paths, whole, start, end)
    cuts = sorted({start, end, *(rng.choice(days) + timedelta(hours=rng.randrange(24)) for _ in range(2))})
    for interval in zip(cuts, cuts[1:], strict=False):
        jobs.run_interval(spark, paths, parts, *interval)
    assert tables(spark, whole, rows) == tables(spark, parts, rows)


def test_incremental_reads_prune_partitions(spark, sources, lake, conf):
    conf(spark__sql__maxMetadataStringLength="100000")
    jobs.run_interval(spark, sources, lake, Y2018, Y2020)
    raw = jobs.read_raw(spark, lake, "orders")
    ids = spark.createDataFrame([("2",)], "order_id string")
    history = jobs.history_of(raw, ids)
    scans = [line for line in plan_of(history).splitlines() if "FileScan" in line]
    whole = [line for line in scans if "items" in line.split("ReadSchema")[1]]
    assert whole and all("PartitionFilters: []" not in line for line in whole)
    assert history.count() == 2


def test_newest_row_of_a_merge_key(spark, sources, lake, rows):
    jobs.ingest(spark, "restaurants", sources["restaurants"], lake, Y2018, Y2019)
    table = read_table(spark, jobs.raw_path(lake, "restaurants"))
    assert rows(table, "id", "merchant_city", "month_partition") == [("m1", "SAO PAULO", "06")]


def test_intervals_may_come_in_any_order(spark, sources, lake, rows):
    spring, summer = (datetime(2018, 1, 1), datetime(2018, 5, 1)), (datetime(2018, 5, 1), Y2019)
    for interval in (summer, spring, summer, spring):
        jobs.ingest(spark, "restaurants", sources["restaurants"], lake, *interval)
        jobs.check_ingest(spark, "restaurants", sources["restaurants"], lake, *interval)
    table = read_table(spark, jobs.raw_path(lake, "restaurants"))
    assert rows(table, "id", "merchant_city") == [("m1", "SAO PAULO")]


def test_interval_without_rows_changes_nothing(spark, sources, lake):
    jobs.ingest(spark, "orders", sources["orders"], lake, datetime(2010, 1, 1), datetime(2011, 1, 1))
    assert not table_exists(spark, jobs.raw_path(lake, "orders"))
    jobs.build_marts(spark, lake, Y2018, Y2019)
    assert not table_exists(spark, jobs.trusted_path(lake, "orders"))


def test_settings_of_the_session_come_back(spark, sources, lake):
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    jobs.ingest(spark, "consumers", sources["consumers"], lake, Y2018, Y2019)
    assert spark.conf.get(name) == before


def frames(spark):
    """Raw frames for the marts, straight from the hand-written rows."""
    made = {}
    for name, data in (("orders", ORDERS[:-1]), ("order_statuses", STATUSES)):
        schema = DATASETS[name].schema
        text = spark.createDataFrame([{k: row.get(k) for k in schema.names} for row in data],
                                     ", ".join(f"{k} string" for k in schema.names))
        made[name] = enforce(text, schema)
    made["consumers"] = spark.createDataFrame(
        [("c1", "Ana", "5555")], "customer_id string, customer_name string, customer_phone_number string"
    )
    made["restaurants"] = spark.createDataFrame([("m1", "SP")], "id string, merchant_city string")
    return made


def mart_of(made, **options):
    return marts.orders_mart(
        made["orders"], made["order_statuses"], made["consumers"], made["restaurants"], **options
    )


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_marts_do_not_depend_on_session_zone_or_row_order(spark, conf, rows, zone):
    made = frames(spark)
    expected = [rows(mart_of(made).drop("items"))]
    expected.append(rows(marts.order_items_mart(made["orders"]), "order_id", "item.sequence"))
    conf(spark__sql__session__timeZone=zone)
    turned = {name: df.orderBy(F.hash(*df.columns)).repartition(3) for name, df in frames(spark).items()}
    assert [
        rows(mart_of(turned).drop("items")),
        rows(marts.order_items_mart(turned["orders"]), "order_id", "item.sequence"),
    ] == expected


def test_ties_give_more_rows_when_asked_for(spark, rows):
    made = frames(spark)
    one, every = mart_of(made), mart_of(made, ties="all")
    assert rows(one, "order_id") == [("1",), ("2",), ("3",)]
    # Order 2 has events s3 and s4, the latter twice, at one instant; order 3 came twice.
    assert rows(every, "order_id", "status.status_id") == [
        ("1", "s2"), ("2", "s3"), ("2", "s4"), ("2", "s4"), ("3", None), ("3", None)
    ]


def test_dropped_items_stay_when_asked_for(spark, sources, lake, rows):
    for interval in ((Y2018, Y2019), (Y2019, Y2020)):
        jobs.run_interval(spark, sources, lake, *interval, keep_dropped_items=True)
    items = read_table(spark, jobs.trusted_path(lake, "order_items"))
    assert [r for r in rows(items, "order_id", "item.sequence") if r[0] == "2"] == [
        ("2", 1), ("2", 2), ("2", 3)
    ]


def test_sensitive_columns_stay_and_are_masked(spark):
    made = frames(spark)
    mart = mart_of(made)
    row = mart.where("order_id = '1'").first()
    for name in SENSITIVE:
        value = row.consumers[name] if name == "customer_phone_number" else row[name]
        assert len(value) == 40 and value not in {"123", "Ana", "5555", "-23.5", "-46.6"}
    assert row.consumers.customer_name == row.customer_name
    plain = mart_of(made, sensitive=["cpf"], salt="x").where("order_id = '1'").first()
    assert plain.customer_name == "Ana" and len(plain.cpf) == 64


def test_partition_columns_do_not_leak_into_the_nested_parts(spark, sources, lake):
    jobs.run_interval(spark, sources, lake, Y2018, Y2019)
    schema = read_table(spark, jobs.trusted_path(lake, "orders")).schema
    for name in ("consumers", "restaurants", "status"):
        assert not [field for field in schema[name].dataType.names if "partition" in field]


def test_plans_have_no_python_and_no_needless_shuffles(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    made = frames(spark)
    plan = plan_of(mart_of(made))
    assert "Python" not in plan
    # Latest order, latest status (their join reuses both), then one per side and lookup.
    assert plan.count("Exchange hashpartitioning") == 6
    items = plan_of(marts.order_items_mart(made["orders"]))
    assert items.count("Exchange hashpartitioning") == 1 and "Python" not in items
    assert plan_of(marts.order_status_times_mart(made["order_statuses"])).count("Exchange") == 1


def bytes_read(spark):
    """Bytes that this session has read from local files so far."""
    every = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in every if s.getScheme() == "file")


@pytest.mark.parametrize("kind", ["json", "json.gz", "csv"])
def test_ingest_and_check_read_a_source_once_each(spark, tmp_path, kind):
    name = "consumers" if kind == "csv" else "order_statuses"
    # Random text, so that the source is much larger than all that is written of it in between.
    noise = random.Random(1)
    pad = lambda: "%x" % noise.getrandbits(4 * 900)
    at = "2018-01-01T00:00:00Z"
    if kind == "csv":
        lines = ["customer_id,language,created_at,active,customer_name,customer_phone_area,customer_phone_number"]
        lines += [f"{i},{pad()},{at},true,Ana,1{',' * (i % 1000 == 0)},2" for i in range(3000)]
    else:
        lines = [json.dumps(dict(order_id=str(i), status_id="s", value="x", created_at=at, pad=pad())) for i in range(3000)]
        lines += ["{bad"] * 3
    source = tmp_path / f"in.{kind}"
    text = ("\n".join(lines) + "\n").encode()
    source.write_bytes(gzip.compress(text) if kind.endswith("gz") else text)
    options = {"undeclared": False}
    jobs.check_ingest(spark, name, *ingested(spark, name, source, tmp_path / "warm", options), **options)
    before = bytes_read(spark)
    arguments = ingested(spark, name, source, tmp_path / "lake", options)
    once = bytes_read(spark)
    jobs.check_ingest(spark, name, *arguments, **options)
    again = bytes_read(spark)
    size = source.stat().st_size
    written = 2 * size if kind == "csv" else 0  # the long column itself, staged and merged
    assert once - before < 1.25 * size + written and again - once < 1.25 * size
    assert jobs.read_rejected_rows(spark, str(tmp_path / "lake"), name).count() == 3


def ingested(spark, name, source, lake, options):
    arguments = (str(source), str(lake), Y2018, Y2019)
    jobs.ingest(spark, name, *arguments, **options)
    return arguments


def test_counts_of_a_stage_that_ran_twice_are_taken_again(spark, sources, lake, monkeypatch):
    jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
    counts = jobs.Watched.counts
    doubled = lambda self: {k: 2 * v if k == "read" else v for k, v in counts(self).items()}
    monkeypatch.setattr(jobs.Watched, "counts", doubled)
    jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
    monkeypatch.setattr(jobs, "source_counts", lambda *_, **__: {"read": 9, "accepted": 1})
    with pytest.raises(QualityError, match="lines"):
        jobs.check_ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)


def test_a_backfill_publishes_nothing_of_an_interval_that_lacks_rows(spark, sources, lake, monkeypatch):
    upsert = jobs.upsert

    def lossy(spark, path, rows, keys, **options):
        if path.endswith("raw/orders"):
            rows = rows.where("order_id <> '3'")
        upsert(spark, path, rows, keys, **options)

    monkeypatch.setattr(jobs, "upsert", lossy)
    with pytest.raises(QualityError, match="missing"):
        jobs.backfill(spark, sources, lake, Y2018, Y2020)
    mart = read_table(spark, jobs.trusted_path(lake, "orders"))
    # Order 3 is of the second interval; the first one had been published.
    assert mart.where("order_created_at_utc >= '2019-01-01'").count() == 0 and mart.count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_periods_do_not_depend_on_the_session_zone(spark, conf, rows, zone):
    """In Sao Paulo the day 2018-11-04 begins at one o'clock."""
    conf(spark__sql__session__timeZone=zone)
    times = ["2018-11-04 00:00:00", "2018-11-04 00:30:07", "2018-11-03 23:59:59.999999", "2018-12-31 05:06:07"]
    events = spark.createDataFrame([("o", "s", "x", t) for t in times], "order_id string, status_id string, value string, at string")
    events = events.select("order_id", "status_id", "value", F.col("at").cast("timestamp_ntz").alias("created_at"))
    starts = {
        "minute": ["2018-11-03 23:59", "2018-11-04 00:00", "2018-11-04 00:30", "2018-12-31 05:06"],
        "hour": ["2018-11-03 23:00", "2018-11-04 00:00", "2018-12-31 05:00"],
        "day": ["2018-11-03 00:00", "2018-11-04 00:00", "2018-12-31 00:00"],
        "week": ["2018-10-29 00:00", "2018-12-31 00:00"],
        "month": ["2018-11-01 00:00", "2018-12-01 00:00"],
        "quarter": ["2018-10-01 00:00"],
        "year": ["2018-01-01 00:00"],
    }
    for grain, expected in starts.items():
        mart = marts.order_statuses_mart(events, grain=grain)
        assert rows(mart, "period") == [(datetime.fromisoformat(p),) for p in expected]
    with pytest.raises(ValueError, match="unknown grain"):
        marts.order_statuses_mart(events, grain="decade")


def built_intervals(monkeypatch):
    """The intervals of the mart builds that run from now on."""
    seen, build = [], jobs.build_marts

    def noted(spark, lake, start, end, **options):
        seen.append((start, end))
        build(spark, lake, start, end, **options)

    monkeypatch.setattr(jobs, "build_marts", noted)
    return seen


def test_a_backfill_goes_on_where_it_stopped_and_repeats_what_changed(spark, sources, lake, rows, monkeypatch, tmp_path):
    seen = built_intervals(monkeypatch)
    year_1, year_2 = (Y2018, Y2019), (Y2019, Y2020)
    with monkeypatch.context() as stopped:
        stopped.setattr(jobs, "check_ingest", lambda spark, name, source, lake, start, end, **_: 1 / (start < Y2019))
        with pytest.raises(ZeroDivisionError):
            jobs.backfill(spark, sources, lake, Y2018, Y2020)
    assert seen == [year_1]
    seen.clear()
    jobs.backfill(spark, sources, lake, Y2018, Y2020)
    assert seen == [year_2]
    whole = {name: rows(read_table(spark, jobs.trusted_path(lake, name)).drop("extra", "consumers", "restaurants", "status")) for name in ("orders", "order_status_times")}
    seen.clear()
    jobs.backfill(spark, sources, lake, Y2018, Y2020)
    assert seen == []
    # A new event of the second year touches an order of the first: its interval alone is built.
    with open(sources["order_statuses"], "a") as file:
        file.write(json.dumps(status("2", "s9", "2019-05-05T00:00:00Z", "CONCLUDED")) + "\n")
    jobs.backfill(spark, sources, lake, Y2018, Y2020)
    assert seen == [year_2]
    times = rows(read_table(spark, jobs.trusted_path(lake, "order_status_times")), "order_id", "concluded")
    assert ("2", datetime(2019, 5, 5)) in times
    other = str(tmp_path / "other")
    jobs.backfill(spark, sources, other, Y2018, Y2020, resume=False)
    for name in whole:
        again = [rows(read_table(spark, jobs.trusted_path(x, name)).drop("extra", "consumers", "restaurants", "status")) for x in (lake, other)]
        assert again[0] == again[1]
    seen.clear()
    # Other options, an ingest by hand, and no resumption each start anew.
    jobs.backfill(spark, sources, lake, Y2018, Y2020, salt="s")
    assert seen == [year_1, year_2]
    jobs.ingest(spark, "orders", sources["orders"], lake, Y2018, Y2019)
    jobs.backfill(spark, sources, lake, Y2018, Y2020, salt="s")
    assert seen[2:] == [year_1]
    jobs.backfill(spark, sources, lake, Y2018, Y2020, salt="s", resume=False)
    assert seen[3:] == [year_1, year_2]


def test_fingerprints_know_rows_but_not_their_order(spark):
    df = spark.createDataFrame([(1, "a", '{"x":1,"y":2}'), (2, None, None), (2, None, None)], "i int, s string, j string")
    df = df.withColumn("j", F.parse_json("j"))
    (base,) = fingerprints({"t": df}).values()
    assert base[0] == "3"
    same = df.orderBy(F.desc("i")).repartition(3)
    turned = df.withColumn("j", F.when(F.col("i") == 1, F.parse_json(F.lit('{"y":2,"x":1}'))))
    others = [df.where("i = 1"), df.unionAll(df.limit(1)), df.withColumn("s", F.coalesce("s", F.lit(""))), df.limit(0), df.where("i = 2")]
    found = fingerprints({"same": same, "turned": turned, **{str(i): x for i, x in enumerate(others)}})
    assert found["same"] == base == found["turned"]
    assert all(found[str(i)] != base for i in range(len(others)))
    assert found["3"] == ["0", "0", "0"] and fingerprints({}) == {}
