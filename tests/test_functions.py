from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import (
    in_interval,
    in_partition_window,
    intervals,
    parse_utc,
    to_local,
    with_date_partitions,
)
from lakemart.functions.privacy import mask
from lakemart.functions.typing import accepted, enforce, rejected

ZONES = ["UTC", "America/New_York", "America/Sao_Paulo"]


def ntz(spark, pairs, names="id int, t timestamp_ntz"):
    return spark.createDataFrame(pairs, names)


@pytest.mark.parametrize("zone", ZONES)
def test_interval_is_half_open_in_any_session_zone(spark, conf, rows, zone):
    conf(spark__sql__session__timeZone=zone)
    start, end = datetime(2018, 1, 1), datetime(2019, 1, 1)
    df = ntz(
        spark,
        [(1, start), (2, end), (3, end - timedelta(microseconds=1)), (4, None), (5, datetime(2017, 12, 31, 23, 59, 59))],
    )
    assert rows(in_interval(df, "t", start, end), "id") == [(1,), (3,)]


@pytest.mark.parametrize("zone", ZONES)
def test_date_partitions(spark, conf, rows, zone):
    conf(spark__sql__session__timeZone=zone)
    # Midnight of 2018-11-04 did not exist in Sao Paulo.
    df = ntz(spark, [(1, datetime(2018, 11, 4)), (2, datetime(2018, 12, 31, 23, 30)), (3, None)])
    parts = with_date_partitions(df, "t").drop("t")
    assert rows(parts) == [(1, "2018", "11", "04"), (2, "2018", "12", "31"), (3, None, None, None)]


def test_partition_window_keeps_the_day_of_an_end_within_it(spark, rows):
    df = ntz(spark, [(d, datetime(2018, 1, d, 12)) for d in range(1, 6)] + [(9, None)])
    df = with_date_partitions(df, "t")
    midnight = in_partition_window(df, datetime(2018, 1, 2), datetime(2018, 1, 4))
    assert rows(midnight, "id") == [(2,), (3,)]
    noon = in_partition_window(df, datetime(2018, 1, 2, 18), datetime(2018, 1, 4, 9))
    assert rows(noon, "id") == [(2,), (3,), (4,)]


@pytest.mark.parametrize("zone", ZONES)
def test_local_time(spark, conf, rows, zone):
    conf(spark__sql__session__timeZone=zone)
    late = datetime(2018, 12, 31, 23, 30)
    df = spark.createDataFrame(
        [
            (1, late, "America/Sao_Paulo"),
            (2, late, "Asia/Tokyo"),
            (3, datetime(2018, 11, 4, 2, 30), "America/Sao_Paulo"),
            (4, datetime(2018, 11, 4, 3, 30), "America/Sao_Paulo"),
            (5, late, None),
            (6, late, "Not/AZone"),
            (7, None, "Asia/Tokyo"),
        ],
        "id int, t timestamp_ntz, zone string",
    )
    local = dict(df.select("id", to_local("t", "zone")).collect())
    assert local == {
        1: datetime(2018, 12, 31, 21, 30),
        2: datetime(2019, 1, 1, 8, 30),
        3: datetime(2018, 11, 3, 23, 30),
        4: datetime(2018, 11, 4, 1, 30),
        5: None,
        6: None,
        7: None,
    }


def test_no_zone_name_fails_the_job(spark):
    names = ["", " ", "UTC", " UTC ", "Z", "+03", "-03:30", "+3", "10", ".5", "PST", "GMT+2", "UTC+25", "-", "a b",
             "America/Sao_Paulo", "america/sao_paulo", "America/", "T00:00", "+99:00", "Etc/GMT-14", "\u00e9"]
    df = spark.createDataFrame([(n, datetime(2018, 6, 1, 12)) for n in names], "zone string, t timestamp_ntz")
    hours = {r.zone: r.x and (r.x - r.t).total_seconds() / 3600 for r in df.withColumn("x", to_local("t", "zone")).collect()}
    assert hours["UTC"] == hours[" UTC "] == hours["Z"] == 0
    assert (hours["+03"], hours["-03:30"], hours["GMT+2"], hours["Etc/GMT-14"]) == (3, -3.5, 2, 14)
    assert hours["America/Sao_Paulo"] == -3
    assert [n for n in ("", " ", "10", ".5", "-", "a b", "America/", "+99:00", "UTC+25") if hours[n] is not None] == []


@pytest.mark.parametrize("zone", ZONES)
def test_parse_utc(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    at = datetime(2019, 1, 17, 22, 50, 6)
    expected = {
        "2019-01-17T22:50:06.000Z": at,
        "2019-01-17 22:50:06": at,
        "2019-01-17 22:50:06 UTC": at,
        " 2019-01-17T22:50:06z ": at,
        "2019-01-17T22:50:06.123456+02:00": at.replace(microsecond=123456) - timedelta(hours=2),
        "2019-01-17 22:50:06 -0330": at + timedelta(hours=3, minutes=30),
        "2019-01-17T22:50:06-03": at + timedelta(hours=3),
        "2019-01-17": datetime(2019, 1, 17),
        "2019-01-17 22:50:06 America/Sao_Paulo": at + timedelta(hours=2),
        "2019-01-17 22:50:06 Not/AZone": None,
        "1919-01-17T22:50:06Z": at.replace(year=1919),
        "22:50:06Z": None,
        "22:50:06": None,
        "2019-13-17": None,
        "yesterday": None,
        "": None,
    }
    df = spark.createDataFrame([(text,) for text in expected], "text string")
    assert dict(df.select("text", parse_utc(F.col("text"))).collect()) == expected


def test_intervals():
    years = list(intervals(datetime(2018, 1, 1), datetime(2020, 7, 1)))
    assert years == [
        (datetime(2018, 1, 1), datetime(2019, 1, 1)),
        (datetime(2019, 1, 1), datetime(2020, 1, 1)),
        (datetime(2020, 1, 1), datetime(2020, 7, 1)),
    ]
    months = list(intervals(datetime(2018, 11, 15), datetime(2019, 2, 1), "month"))
    assert [start for start, _ in months] == [
        datetime(2018, 11, 15), datetime(2018, 12, 1), datetime(2019, 1, 1)
    ]
    assert len(list(intervals(datetime(2018, 1, 1), datetime(2018, 1, 8), "day"))) == 7
    with pytest.raises(ValueError):
        list(intervals(datetime(2018, 1, 1), datetime(2018, 1, 8), "week"))


def test_mask(spark):
    df = spark.createDataFrame([("ana", 1.5, None)], "name string, amount double, empty string")
    row = mask(df, ["name", "amount", "empty", "absent"]).first()
    # Hex SHA-1 of the hex MD5 of the text, fixed by the masking rule.
    import hashlib

    def twice(text):
        return hashlib.sha1(hashlib.md5(text.encode()).hexdigest().encode()).hexdigest()

    assert (row["name"], row["amount"], row["empty"]) == (twice("ana"), twice("1.5"), None)
    salted = mask(df, ["name"], salt="s").first()["name"]
    assert salted == hashlib.sha256(b"sana").hexdigest()


def test_enforce(spark):
    schema = T.StructType.fromDDL(
        "id string, t timestamp_ntz, n long, x double, b boolean, "
        "items array<struct<sequence: int, price: struct<value: string>>>"
    )
    df = spark.createDataFrame(
        [
            ("1", "2018-01-01", "-23.56", "-23.56", "true", '[{"sequence": 1, "price": {"value": "5"}}]', "kept"),
            ("2", "?", "many", "?", "?", "[{", "kept"),
            ("3", None, "9223372036854775807", "1e3", "FALSE", "[]", "kept"),
        ],
        "id string, t string, n string, x string, b string, items string, other string",
    )
    first, second, third = enforce(df, schema).orderBy("id").collect()
    assert (first.n, first.x, first.b, first.other) == (-23, -23.56, True, "kept")
    assert first["items"][0]["price"]["value"] == "5"
    assert tuple(second)[1:6] == (None,) * 5
    assert (third.n, third.x, third.b, third["items"]) == (2**63 - 1, 1000.0, False, [])
    with pytest.raises(ValueError, match="missing"):
        enforce(df.drop("n"), schema)


def test_accepted_and_rejected_cover_all_rows(spark, rows):
    df = spark.createDataFrame(
        [("1", "2018-01-01"), ("2", "?"), (None, "2018-01-01"), (None, None)], "id string, t string"
    )
    schema = T.StructType.fromDDL("id string, t timestamp_ntz")
    assert rows(accepted(df, schema, ["id", "t"]), "id") == [("1",)]
    bad = rows(rejected(df, schema, ["id", "t"]), "id", "reject_reasons")
    assert bad == [
        ("2", "t:unreadable"),
        (None, "id:null"),
        (None, "id:null,t:null"),
    ]


def test_text_in_utc_reads_as_text_with_any_other_zone(spark):
    times = ["2024-01-01T10:00:00", "2018-11-04 00:30:00.1234567", "2024-02-30T10:00:00", "2024-01-01T24:00:00", "2024-01-01T1:2:3"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    utc, other = (parse_utc(F.concat("t", F.lit(zone))).alias(name) for zone, name in (("Z", "utc"), ("+00:00", "other")))
    read = df.select(utc, other).collect()
    assert all(r["utc"] == r["other"] for r in read)
    assert sum(r["utc"] is not None for r in read) == 3
