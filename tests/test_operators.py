import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from lakemart.operators.items import explode_garnish, explode_items, flatten_struct
from lakemart.operators.joins import lookup, matching
from lakemart.operators.latest import dedup, latest
from lakemart.operators.quality import (
    QualityError,
    duplicate_keys,
    hot_keys,
    id_counts,
    missing_keys,
    null_keys,
    partition_skew,
    require_complete,
    require_keys,
    unknown_zones,
)
from lakemart.operators.ranking import ranked
from lakemart.operators.statuses import status_pivot, status_timeline
from lakemart.schemas import ITEMS

AT = datetime(2018, 1, 1)


def at(hour):
    return AT.replace(hour=hour)


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, "m"), (None, 3, "q"), (None, 2, "r")],
        "id string, t int, v string",
    )


def test_latest_one_and_all(versions, rows):
    assert rows(latest(versions, ["id"], ["t"])) == [("a", 2, "z"), ("b", 1, "m"), (None, 3, "q")]
    assert rows(latest(versions, ["id"], ["t"], ties="all")) == [
        ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "m"), (None, 3, "q")
    ]
    with pytest.raises(ValueError):
        latest(versions, ["id"], ["t"], ties="some")


def test_latest_all_with_only_null_times_and_two_order_columns(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 1, 5), ("b", 1, 5)], "id string, t int, u int")
    assert rows(latest(df, ["id"], ["t"], ties="all")) == rows(df)
    assert rows(latest(df, ["id"], ["t", "u"], ties="all")) == [("a", None, 2), ("b", 1, 5), ("b", 1, 5)]


def test_latest_does_not_depend_on_row_order(spark, rows):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("t"), F.hash("id").alias("v")
    )
    once = rows(latest(df, ["k"], ["t"]))
    assert once == rows(latest(df.orderBy(F.col("v").desc()).repartition(5), ["k"], ["t"]))


def test_latest_limits_rows_before_the_shuffle(versions):
    plan = plan_of(latest(versions, ["id"], ["t"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_dedup_takes_null_as_a_key(versions, rows):
    assert rows(dedup(versions.select("id"), ["id"])) == [("a",), ("b",), (None,)]


def skewed(spark, n=4000):
    """A third of the rows on one key, some without a key, some without a match."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        key.otherwise((F.col("id") % 50).cast("string")).alias("customer_id"),
    )


def people(spark):
    return spark.createDataFrame(
        [("hot", "H")] + [(str(i), f"n{i}") for i in range(40)], "customer_id string, name string"
    )


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_lookup_equals_a_left_join(spark, conf, rows, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    left, right = skewed(spark), people(spark)
    found = lookup(left, right, ("customer_id", "customer_id"), "person", ["order_id"])
    assert found.columns == ["order_id", "customer_id", "person"]
    plain = left.join(right, "customer_id", "left").select("order_id", "customer_id", "name")
    assert rows(found.select("order_id", "customer_id", "person.name")) == rows(plain)
    missing = found.where("person IS NULL").count()
    assert missing == plain.where("name IS NULL").count() > 0


def test_lookup_spreads_null_keys(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    left = skewed(spark).withColumn("customer_id", F.when(F.col("customer_id") != "hot", F.col("customer_id")))
    found = lookup(left, people(spark), ("customer_id", "customer_id"), "person", ["order_id"])
    sizes = [n for _, n in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000 / 4


@pytest.mark.parametrize("broadcast, share", [("-1", 0.3), ("10MB", 0.3), ("-1", 0.0001), ("-1", 1.0)])
def test_a_planned_split_equals_a_left_join(spark, conf, rows, broadcast, share):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    left, right = skewed(spark), people(spark)
    found = lookup(left, right, ("customer_id", "customer_id"), "person", ["order_id"], hot_share=share)
    plain = left.join(right, "customer_id", "left").select("order_id", "customer_id", "name")
    assert found.columns == ["order_id", "customer_id", "person"]
    assert rows(found.select("order_id", "customer_id", "person.name")) == rows(plain)
    # What is counted elsewhere has no say in the result.
    other = spark.createDataFrame([("1",), ("nobody",)], "customer_id string")
    found = lookup(left, right, ("customer_id", "customer_id"), "person", ["order_id"], hot_share=0.5, counted=other)
    assert rows(found.select("order_id", "customer_id", "person.name")) == rows(plain)


def test_a_planned_split_keeps_a_hot_key_out_of_the_shuffle(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    left = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 2000).cast("string")).alias("customer_id"),
    )
    right = spark.range(2000).select(F.col("id").cast("string").alias("customer_id"), F.lit("n").alias("name"))
    right = right.unionAll(spark.createDataFrame([("hot", "h")], "customer_id string, name string"))
    found = lookup(left, right, ("customer_id", "customer_id"), "person", ["order_id"], hot_share=0.1)
    assert found.where("person IS NOT NULL").count() == 30_000
    plan = plan_of(found)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    sizes = sorted(n for _, n in found.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("share", [0.3, 0.05, 0.005, 0.001])
def test_hot_keys_are_counted_exactly(spark, rows, share):
    """Keys of all frequencies, those at the bound too, among thousands of rare ones."""
    n = 20_000
    kinds = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, None).when(F.col("id") % 200 == 2, "bound")
    df = spark.range(0, n, 1, 7).select(
        kinds.when(F.col("id") % 1000 == 4, F.concat(F.lit("rare"), F.col("id") % 7)).otherwise(F.col("id").cast("string")).alias("k")
    )
    wanted = df.groupBy("k").count().where(F.col("count") >= share * n)
    assert rows(hot_keys(df, "k", share), "key", "row_count") == rows(wanted)
    numbers = df.select(F.xxhash64("k").alias("k"))
    wanted = numbers.groupBy("k").count().where(F.col("count") >= share * n)
    assert rows(hot_keys(numbers, "k", share), "key", "row_count") == rows(wanted)
    assert hot_keys(df.limit(0), "k", share).count() == 0
    with pytest.raises(ValueError, match="share"):
        hot_keys(df, "k", 0)


def test_adaptive_skew_split_keeps_all_rows(spark, conf, rows):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
    )
    left = skewed(spark, 20000).repartition(8)
    found = lookup(left, people(spark), ("customer_id", "customer_id"), "person", ["order_id"])
    assert found.count() == 20000
    ties = spark.range(0, 20000, 1, 8).select(F.lit("a").alias("k"), F.lit(1).alias("t"), "id")
    assert latest(ties, ["k"], ["t"], ties="all").count() == 20000


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_matching_is_a_semi_join_that_lets_a_window_reduce_first(spark, conf, rows, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    left = skewed(spark)
    ids = people(spark).select("customer_id").where("customer_id <> '1'").unionAll(
        spark.createDataFrame([("hot",), (None,)], "customer_id string")
    )
    found = matching(left, ids, "customer_id")
    assert rows(found) == rows(left.join(ids, "customer_id", "left_semi").select(*left.columns))
    newest = latest(found, ["customer_id"], ["order_id"])
    plan = plan_of(newest)
    assert plan.count("row_number(), 1, Partial") == plan.count("row_number(), 1, Final") == 1
    assert newest.count() == found.select("customer_id").distinct().count()


@pytest.fixture
def statuses(spark):
    return spark.createDataFrame(
        [
            ("1", "s2", "PLACED", at(9)),
            ("1", "s1", "REGISTERED", at(8)),
            ("1", "s3", "CONCLUDED", at(10)),
            ("1", "s4", "CONCLUDED", at(11)),
            ("2", "s5", "CANCELLED", at(7)),
        ],
        "order_id string, status_id string, value string, created_at timestamp_ntz",
    )


def test_status_timeline(statuses):
    first, second = status_timeline(statuses).orderBy("order_id").collect()
    assert [(s.event, s.created_at) for s in first.status] == [
        ("REGISTERED", at(8)), ("PLACED", at(9)), ("CONCLUDED", at(10)), ("CONCLUDED", at(11))
    ]
    assert first.date_partition == at(8)
    assert [s.event for s in second.status] == ["CANCELLED"]


def test_timeline_by_a_fixed_grain(spark, rows):
    events = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, "long").otherwise((F.col("id") % 30).cast("string")).alias("order_id"),
        F.col("id").cast("string").alias("status_id"),
        F.lit("PLACED").alias("value"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(AT).cast("timestamp_ntz")).alias("created_at"),
    )
    timeline = status_timeline(events, grain="day").cache()
    for row in timeline.collect():
        assert row.status == sorted(row.status, key=lambda s: s.created_at)
        assert {s.created_at.date() for s in row.status} == {row.period.date()}
        assert row.date_partition == row.status[0].created_at
    assert timeline.groupBy("order_id", "period").count().where("count > 1").isEmpty()
    flat = timeline.select("order_id", F.explode("status").alias("s")).select("order_id", "s.event", "s.created_at")
    assert rows(flat) == rows(events, "order_id", "value", "created_at")
    assert status_timeline(events).count() == events.select("order_id").distinct().count()


def test_status_pivot(statuses, rows):
    assert rows(status_pivot(statuses)) == [
        ("1", at(11), at(8), None, at(9), at(8)),
        ("2", None, None, at(7), None, at(7)),
    ]
    plan = plan_of(status_pivot(statuses))
    assert plan.count("Exchange") == 1


def orders_with(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "order_id long, items string")
    return df.withColumn("items", F.from_json("items", ITEMS))


def test_explode_items_and_garnish(spark, rows):
    orders = orders_with(
        spark,
        '[{"sequence": 1, "garnishItems": [{"name": "g1"}, {"name": "g2"}]}, {"sequence": 2}]',
        "[]",
        None,
        "[{oops",
    )
    items = explode_items(orders)
    assert rows(items, "order_id", "item.sequence") == [(0, 1), (0, 2)]
    kept = explode_items(orders, keep_empty=True)
    assert rows(kept, "order_id", "item.sequence") == [(0, 1), (0, 2), (1, None), (2, None), (3, None)]
    garnish = explode_garnish(items)
    assert rows(garnish, "item.sequence", "garnish.name") == [(1, "g1"), (1, "g2"), (2, None)]
    assert rows(explode_garnish(items, keep_empty=False), "garnish.name") == [("g1",), ("g2",)]
    flat = flatten_struct(items, "item")
    assert flat.columns[:2] == ["order_id", "name"] and "garnishItems" in flat.columns


def test_missing_keys_is_null_safe(spark, rows):
    source = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 2), (None, 3)], "k string, n int")
    table = spark.createDataFrame([("a", None), ("a", 1), ("c", 1)], "k string, n int")
    assert rows(missing_keys(source, table, ["k", "n"])) == [("b", 2), (None, 3)]
    with pytest.raises(QualityError, match="2 source keys"):
        require_complete(source, table, ["k", "n"])
    require_complete(source, source, ["k", "n"])
    assert rows(id_counts(source, table, ["k", "n"])) == [(4, 3, 2, 2, 1)]


def test_key_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert rows(duplicate_keys(df, ["k", "n"])) == [("a", 1, 2)]
    assert rows(null_keys(df, ["k", "n"])) == [(3, 1, 0)]
    with pytest.raises(QualityError, match="null keys"):
        require_keys(df, ["k"], ["k"])
    with pytest.raises(QualityError, match="2 rows"):
        require_keys(df, ["k", "n"])
    assert require_keys(df.limit(0), ["k"], ["k"]) == 0
    assert require_keys(df.distinct(), ["k", "n"], ["n"]) == 2


def test_partition_skew(spark):
    df = spark.createDataFrame([("1",)] * 6 + [("2",)] * 2 + [("3",)], "day string")
    report = partition_skew(df, ["day"]).first().asDict()
    assert report == {
        "partitions": 3, "total_rows": 9, "mean_rows": 3.0, "median_rows": 2.0, "max_rows": 6,
        "max_over_mean": 2.0,
    }


def test_unknown_zones(spark, rows):
    df = spark.createDataFrame([("UTC",), ("Mars/Base",), (None,)], "zone string")
    assert rows(unknown_zones(df, "zone")) == [("Mars/Base",)]


def brute_segments(events, size):
    """(key, part, list) by sorting each key's events."""
    lists = {}
    for key, value, at in events:
        lists.setdefault(key, []).append((at, value))
    out = []
    for key, some in lists.items():
        some.sort()
        out += [(key, i // size, some[i : i + size]) for i in range(0, len(some), size)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_segments_are_cut_by_rank(spark, rows, size):
    """A third of all events on one key, many at the same instant, some equal in all."""
    noise = random.Random(size)
    start = datetime(2018, 1, 1)
    events = [
        ("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 40}", noise.choice("abc"), start + timedelta(seconds=noise.randrange(60)))
        for i in range(3000)
    ]
    df = spark.createDataFrame(events, "order_id string, value string, created_at timestamp_ntz").repartition(7)
    got = status_timeline(df, segment=size)
    found = rows(got.withColumn("status", F.transform("status", lambda s: F.struct(s["created_at"], s["event"]))), "order_id", "part", "status")
    assert sorted([(k, p, [tuple(e) for e in s]) for k, p, s in found], key=repr) == brute_segments(events, size)
    firsts = {(r["order_id"], r["part"]): r["date_partition"] for r in got.collect()}
    assert all(firsts[k, p] == some[0][0] for k, p, some in brute_segments(events, size))


def test_a_hot_key_is_ranked_over_many_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(5)).alias("v"),  # few values: rows of the same place are dealt out as well
        "id",
    )
    out = ranked(df, "key", ["v"])
    hot = out.where("key = 'hot'")
    assert hot.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (13_334, 0, 13_333)
    # The order holds: ranks and values rise together.
    bounds = hot.groupBy("v").agg(F.min("rank").alias("a"), F.max("rank").alias("b")).orderBy("v").collect()
    assert all(x["b"] + 1 == y["a"] for x, y in zip(bounds, bounds[1:]))
    written = spark.read.parquet(*out.inputFiles()).groupBy(F.input_file_name()).agg(F.count("*").alias("n"))
    sizes = [r["n"] for r in written.collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
