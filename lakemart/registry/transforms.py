"""Queries over single operators: types, dates, masks, latest rows, lookups, statuses, checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import (
    in_interval,
    to_local,
    with_date_partitions,
)
from lakemart.functions.privacy import mask
from lakemart.functions.typing import enforce, rejected
from lakemart.operators.items import explode_garnish, explode_items
from lakemart.operators.joins import lookup
from lakemart.operators.latest import dedup, latest
from lakemart.operators.quality import (
    hot_keys,
    duplicate_keys,
    id_counts,
    missing_keys,
    null_keys,
    partition_skew,
)
from lakemart.operators.statuses import status_pivot, status_timeline
from lakemart.operators.upsert import merged
from lakemart.registry import adapters
from lakemart.registry.adapters import table, text
from lakemart.registry.catalog import query
from lakemart.schemas import ITEMS


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
    FROM lineitem
    QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) = 1
    """
)
def latest_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return latest(lines, ["l_orderkey"], ["l_shipdate"], ties="all")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC) = 1
    """
)
def latest_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )
    return latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    """
    SELECT l_orderkey, l_shipdate, l_linenumber, l_suppkey
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_shipdate ORDER BY l_linenumber DESC, l_suppkey DESC) = 1
    """
)
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_suppkey"
    )
    return dedup(lines, ["l_orderkey", "l_shipdate"])


@query(
    """
    SELECT cast(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS item_sequence,
           'part ' || l_partkey AS item_name, l_quantity AS item_quantity,
           cast(l_extendedprice AS VARCHAR) AS unit_price
    FROM lineitem
    WHERE l_quantity > 1
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY 'part ' || l_partkey DESC, l_quantity DESC,
                 cast(l_extendedprice AS VARCHAR) DESC) = 1
    """
)
def dedup_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.item_orders(spark, sf_dir).select(
        "order_id", F.from_json("items", ITEMS).alias("items")
    )
    items = explode_items(orders).withColumn("item_sequence", F.col("item.sequence"))
    return dedup(items, ["order_id", "item_sequence"]).select(
        "order_id",
        "item_sequence",
        F.col("item.name").alias("item_name"),
        F.col("item.quantity").alias("item_quantity"),
        F.col("item.unitPrice.value").alias("unit_price"),
    )


@query(
    """
    SELECT c_custkey, sha1(md5(c_name)) AS c_name,
           sha1(md5(cast(c_acctbal AS VARCHAR))) AS c_acctbal, c_mktsegment
    FROM customer
    """
)
def mask_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    return mask(people, ["c_name", "c_acctbal", "not_there"])


ZONE_SQL = """CASE {key} % 5 WHEN 0 THEN 'America/Sao_Paulo' WHEN 1 THEN 'America/New_York'
                            WHEN 2 THEN 'Asia/Tokyo' WHEN 3 THEN 'Europe/Lisbon' END"""


@query(
    f"""
    WITH zoned AS (SELECT event_id, ts, {ZONE_SQL.format(key="event_id")} AS zone FROM events)
    SELECT event_id, ts, zone, timezone(zone, timezone('UTC', ts)) AS local_ts,
           strftime(timezone(zone, timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local_text
    FROM zoned
    """
)
def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    zoned = table(spark, sf_dir, "events").select(
        "event_id", "ts", adapters.zone_of("event_id").alias("zone")
    )
    local = zoned.withColumn("local_ts", to_local("ts", "zone"))
    return local.withColumn("local_text", F.substring(text("local_ts"), 1, 19))


@query(
    """
    SELECT event_id, strftime(ts, '%Y') AS year_partition, strftime(ts, '%m') AS month_partition,
           strftime(ts, '%d') AS day_partition
    FROM events
    """
)
def date_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_date_partitions(events, "ts").drop("ts")


@query(
    """
    SELECT event_id, ts, user_id FROM events
    WHERE ts >= TIMESTAMP '2024-01-08 06:30:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'
    """
)
def interval_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return in_interval(events, "ts", datetime(2024, 1, 8, 6, 30), datetime(2024, 1, 20, 12))


@query(
    """
    SELECT event_id, cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
           json_extract_string(props, '$.absent') AS absent
    FROM events
    """
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k int, absent string")
    events = table(spark, sf_dir, "events").select("event_id", parsed.alias("props"))
    return events.select("event_id", "props.k", "props.absent")


@query(
    """
    SELECT cast(l_orderkey AS VARCHAR) AS order_id, l_returnflag AS version,
           CASE WHEN l_returnflag <> 'R' THEN (count(*) FILTER (l_quantity > 1))::INTEGER END AS n_items,
           CASE WHEN l_returnflag <> 'R' THEN coalesce(sum(l_quantity) FILTER (l_quantity > 1), 0) END AS quantity,
           CASE WHEN l_returnflag <> 'R' THEN coalesce(
               sum((l_discount > 0)::INTEGER + (l_tax > 0)::INTEGER) FILTER (l_quantity > 1), 0)::INTEGER
               END AS n_garnish
    FROM lineitem GROUP BY l_orderkey, l_returnflag
    """
)
def json_items_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version R is cut short, so its text is no JSON any more and gives null."""
    raw = adapters.item_orders(spark, sf_dir)
    cut = F.when(F.col("version") == "R", F.expr("substr(items, 1, 1)")).otherwise(F.col("items"))
    schema = T.StructType([T.StructField("items", ITEMS)])
    orders = enforce(raw.withColumn("items", cut), schema)
    total = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["quantity"])
    garnish = F.aggregate("items", F.lit(0), lambda a, x: a + F.array_size(x["garnishItems"]))
    return orders.select(
        "order_id",
        "version",
        F.array_size(F.col("items")).alias("n_items"),
        total.alias("quantity"),
        garnish.alias("n_garnish"),
    )


@query(
    """
    SELECT cast(l_orderkey AS VARCHAR) AS order_id,
           max(l_shipdate) OVER (PARTITION BY l_orderkey, l_returnflag)
               + to_seconds(ascii(l_returnflag)) AS order_created_at,
           'part ' || l_partkey AS name, l_quantity AS quantity, l_linenumber AS sequence,
           cast(l_extendedprice AS VARCHAR) AS unit_price, 'BRL' AS currency,
           cast(l_suppkey AS VARCHAR) AS external_id
    FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey, l_returnflag) FROM lineitem)
    QUALIFY l_quantity > 1
    """,
    name="explode_items",
)
def explode_items_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.item_orders(spark, sf_dir).select(
        "order_id", "order_created_at", F.from_json("items", ITEMS).alias("items")
    )
    return explode_items(orders).select(
        "order_id",
        "order_created_at",
        "item.name",
        "item.quantity",
        "item.sequence",
        F.col("item.unitPrice.value").alias("unit_price"),
        "item.unitPrice.currency",
        F.col("item.externalId").alias("external_id"),
    )


@query(
    """
    WITH items AS (SELECT * FROM lineitem WHERE l_quantity > 1)
    SELECT cast(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS item_sequence,
           'discount' AS garnish_name, l_discount AS garnish_quantity, 1 AS garnish_sequence
    FROM items WHERE l_discount > 0
    UNION ALL
    SELECT cast(l_orderkey AS VARCHAR), l_linenumber, 'tax', l_tax, 2
    FROM items WHERE l_tax > 0
    UNION ALL
    SELECT cast(l_orderkey AS VARCHAR), l_linenumber, NULL, NULL, NULL
    FROM items WHERE l_tax = 0 AND l_discount = 0
    """,
    name="explode_garnish",
)
def explode_garnish_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.item_orders(spark, sf_dir).select(
        "order_id", F.from_json("items", ITEMS).alias("items")
    )
    return explode_garnish(explode_items(orders)).select(
        "order_id",
        F.col("item.sequence").alias("item_sequence"),
        F.col("garnish.name").alias("garnish_name"),
        F.col("garnish.quantity").alias("garnish_quantity"),
        F.col("garnish.sequence").alias("garnish_sequence"),
    )


LOOKUP_SQL = """
    SELECT cast(l_orderkey AS VARCHAR) AS order_id, l_partkey, l_quantity,
           s_suppkey IS NOT NULL AS found, s_name AS supplier_name, s_acctbal AS supplier_balance
    FROM lineitem LEFT JOIN supplier
        ON s_suppkey = CASE WHEN l_linenumber < 7 THEN l_suppkey % 40 + l_linenumber % 2 * 90 END
    """


def suppliers_of_lines(spark: SparkSession, sf_dir: str, hot_share: float | None = None) -> DataFrame:
    few = F.col("l_suppkey") % 40 + F.col("l_linenumber") % 2 * 90
    lines = table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("order_id"),
        "l_partkey",
        "l_quantity",
        F.when(F.col("l_linenumber") < 7, few).alias("suppkey"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    found = lookup(
        lines,
        suppliers,
        ("suppkey", "s_suppkey"),
        "supplier",
        ["order_id", "l_partkey", "l_quantity"],
        hot_share=hot_share,
    )
    return found.select(
        "order_id",
        "l_partkey",
        "l_quantity",
        F.col("supplier").isNotNull().alias("found"),
        F.col("supplier.s_name").alias("supplier_name"),
        F.col("supplier.s_acctbal").alias("supplier_balance"),
    )


@query(LOOKUP_SQL)
def lookup_heavy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of lines: some keys busy, some unmatched, and null on every line 7."""
    return suppliers_of_lines(spark, sf_dir)


@query(LOOKUP_SQL)
def lookup_hot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the keys with an eightieth of the lines or more met by a broadcast of their rows."""
    return suppliers_of_lines(spark, sf_dir, hot_share=1 / 80)


@query(
    """
    WITH keyed AS (SELECT CASE WHEN l_linenumber < 7 THEN l_suppkey % 40 + l_linenumber % 2 * 90 END AS key FROM lineitem)
    SELECT key, count(*) AS row_count, count(*) / (SELECT count(*) FROM lineitem) AS row_share
    FROM keyed GROUP BY key HAVING count(*) >= 0.0125 * (SELECT count(*) FROM lineitem)
    """
)
def key_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys with an eightieth of all lines or more, null among them."""
    few = F.col("l_suppkey") % 40 + F.col("l_linenumber") % 2 * 90
    lines = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") < 7, few).alias("suppkey"))
    return hot_keys(lines, "suppkey", 0.0125)


EVENT_KINDS = ("view", "click", "purchase", "signup", "error")

TIMELINE_TEXT_SQL = """string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || ' ' || event_type, ';'
                       ORDER BY ts, event_type)"""


def timeline_text(column: str = "status"):
    """The list of events as one text, to compare it as a scalar."""
    return F.array_join(
        F.transform(
            column,
            lambda s: F.concat_ws(
                " ", F.date_format(s["created_at"], "yyyy-MM-dd HH:mm:ss.SSSSSS"), s["event"]
            ),
        ),
        ";",
    )


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, {TIMELINE_TEXT_SQL} AS status,
           count(*) AS n_events, min(ts) AS date_partition
    FROM events GROUP BY user_id
    """,
    name="status_timeline",
)
def status_timeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline = status_timeline(adapters.event_statuses(spark, sf_dir))
    return timeline.select(
        "order_id",
        timeline_text().alias("status"),
        F.array_size("status").cast("long").alias("n_events"),
        "date_partition",
    )


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, date_trunc('day', ts)::TIMESTAMP AS period,
           {TIMELINE_TEXT_SQL} AS status, min(ts) AS date_partition
    FROM events GROUP BY user_id, date_trunc('day', ts)
    """
)
def status_timeline_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed grain: one list per key and day."""
    timeline = status_timeline(adapters.event_statuses(spark, sf_dir), grain="day")
    return timeline.withColumn("status", timeline_text())


SEGMENT = 25


@query(
    f"""
    WITH placed AS (
        SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) - 1) // {SEGMENT} AS part FROM events)
    SELECT cast(user_id AS VARCHAR) AS order_id, part, {TIMELINE_TEXT_SQL} AS status, min(ts) AS date_partition
    FROM placed GROUP BY user_id, part
    """
)
def status_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of at most so many events, by rank alone."""
    timeline = status_timeline(adapters.event_statuses(spark, sf_dir), segment=SEGMENT)
    return timeline.withColumn("status", timeline_text())


@query(
    """
    SELECT cast(user_id AS VARCHAR) AS order_id,
           max(ts) FILTER (WHERE event_type = 'view') AS view,
           max(ts) FILTER (WHERE event_type = 'click') AS click,
           max(ts) FILTER (WHERE event_type = 'purchase') AS purchase,
           max(ts) FILTER (WHERE event_type = 'signup') AS signup,
           max(ts) FILTER (WHERE event_type = 'error') AS error,
           max(ts) FILTER (WHERE event_type = 'never') AS never,
           min(ts) AS date_partition
    FROM events GROUP BY user_id
    """,
    name="status_pivot",
)
def status_pivot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = adapters.event_statuses(spark, sf_dir)
    return status_pivot(statuses, events=(*EVENT_KINDS, "never"))


@query(
    """
    WITH source AS (
        SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    target AS (
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate < TIMESTAMP '1999-01-01')
    SELECT * FROM target ANTI JOIN source USING (o_orderkey)
    UNION ALL SELECT * FROM source
    """
)
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    first, last = datetime(1900, 1, 1), datetime(2100, 1, 1)
    target = in_interval(orders, "o_orderdate", first, datetime(1999, 1, 1))
    source = in_interval(orders, "o_orderdate", datetime(1998, 1, 1), last)
    source = source.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merged(target, source, ["o_orderkey"])


@query(
    """
    SELECT cast(l_orderkey AS VARCHAR) || '/' || l_linenumber AS row_key,
           try_cast(CASE WHEN l_partkey % 7 = 0 THEN 'n/a' ELSE cast(l_extendedprice AS VARCHAR) END
                    AS DOUBLE) AS price,
           CASE WHEN l_partkey % 7 <> 0 THEN -l_linenumber END AS line,
           try_cast(CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'maybe' END AS BOOLEAN) AS even,
           l_shipdate AS shipped,
           CASE WHEN l_partkey % 3 = 0 THEN l_shipdate + INTERVAL 3 HOUR END AS arrived
    FROM lineitem
    """
)
def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text forms, some of them unreadable, to declared types; '-3.56' as a whole number is -3."""
    readable = F.col("l_partkey") % 7 != 0
    day = F.substring(text("l_shipdate"), 1, 10)
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("row_key"),
        F.when(readable, text("l_extendedprice")).otherwise("n/a").alias("price"),
        F.when(readable, F.concat(F.lit("-"), text("l_linenumber"), F.lit(".56")))
        .otherwise("--")
        .alias("line"),
        F.when(F.col("l_partkey") % 2 == 0, "true").otherwise("maybe").alias("even"),
        F.concat(day, F.lit("T00:00:00.000Z")).alias("shipped"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(day, F.lit(" 01:30:00-01:30")))
        .otherwise(F.concat(day, F.lit(" 25:61")))
        .alias("arrived"),
    )
    schema = T.StructType.fromDDL(
        "price double, line int, even boolean, shipped timestamp_ntz, arrived timestamp_ntz"
    )
    return enforce(rows, schema)


@query(
    """
    WITH raw AS (
        SELECT CASE WHEN o_orderkey % 11 > 0 THEN cast(o_orderkey AS VARCHAR) END AS order_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'yesterday' WHEN o_orderkey % 17 = 0 THEN NULL
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created_at,
               o_custkey
        FROM orders)
    SELECT *, concat_ws(',', CASE WHEN order_id IS NULL THEN 'order_id:null' END,
               CASE WHEN created_at IS NULL THEN 'created_at:null'
                    WHEN created_at = 'yesterday' THEN 'created_at:unreadable' END) AS reject_reasons
    FROM raw WHERE order_id IS NULL OR created_at IS NULL OR created_at = 'yesterday'
    """
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.substring(text("o_orderdate"), 1, 10)
    rows = table(spark, sf_dir, "orders").select(
        F.when(key % 11 > 0, text("o_orderkey")).alias("order_id"),
        F.when(key % 13 == 0, "yesterday").when(key % 17 != 0, day).alias("created_at"),
        "o_custkey",
    )
    schema = T.StructType.fromDDL("order_id string, created_at timestamp_ntz")
    return rejected(rows, schema, ["order_id", "created_at"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return missing_keys(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query(
    """
    WITH s AS (SELECT DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey ELSE o_orderkey END AS k
               FROM orders),
         t AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
    SELECT (SELECT count(*) FROM s) AS source_ids, (SELECT count(*) FROM t) AS table_ids,
           (SELECT count(*) FROM s SEMI JOIN t USING (k)) AS common_ids,
           (SELECT count(*) FROM s ANTI JOIN t USING (k)) AS missing_ids,
           (SELECT count(*) FROM t ANTI JOIN s USING (k)) AS unexpected_ids
    """
)
def id_count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    # Some keys are changed, so that either side has keys that the other lacks.
    moved = orders.select(F.when(key % 5 == 0, -key).otherwise(key).alias("o_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return id_counts(moved, lines, ["o_orderkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    """
)
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT count(*) AS row_count, 0::BIGINT AS null_order_id,
           count(*) FILTER (WHERE o_orderkey % 8 = 0) AS null_merchant_id,
           count(*) FILTER (WHERE o_orderkey % 5 = 4) AS null_merchant_timezone
    FROM orders
    """,
    name="null_keys",
)
def null_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_keys(
        adapters.orders(spark, sf_dir), ["order_id", "merchant_id", "merchant_timezone"]
    )


@query(
    """
    WITH parts AS (SELECT count(*) AS n FROM lineitem
                   GROUP BY strftime(l_shipdate, '%Y'), strftime(l_shipdate, '%m'))
    SELECT count(*) AS partitions, sum(n)::BIGINT AS total_rows, avg(n) AS mean_rows,
           median(n) AS median_rows, max(n) AS max_rows, max(n) / avg(n) AS max_over_mean
    FROM parts
    """,
    name="partition_skew",
)
def partition_skew_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_date_partitions(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return partition_skew(lines, ["year_partition", "month_partition"])
