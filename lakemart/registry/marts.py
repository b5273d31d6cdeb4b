"""The three marts over the driver's tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.dates import in_interval
from lakemart.operators.joins import matching
from lakemart.plans import marts
from lakemart.registry import adapters
from lakemart.registry.catalog import query
from lakemart.registry.transforms import EVENT_KINDS, TIMELINE_TEXT_SQL, ZONE_SQL, timeline_text
from lakemart.schemas import DATE_PARTITIONS

DATE_SQL = """strftime({t}, '%Y') AS year_partition, strftime({t}, '%m') AS month_partition,
           strftime({t}, '%d') AS day_partition"""


def flat_orders(mart: DataFrame) -> DataFrame:
    """The mart with the nested parts as plain columns, to compare them as scalars."""
    return mart.select(
        "order_id",
        "cpf",
        "customer_id",
        "merchant_id",
        "order_created_at",
        "order_created_at_utc",
        "order_total_amount",
        "origin_platform",
        F.col("customer_name").alias("order_customer_name"),
        "delivery_address_city",
        "delivery_address_country",
        "delivery_address_district",
        "delivery_address_external_id",
        "delivery_address_state",
        "delivery_address_zip_code",
        "delivery_address_latitude",
        "delivery_address_longitude",
        "merchant_latitude",
        "merchant_longitude",
        "merchant_timezone",
        "order_scheduled",
        "order_scheduled_date",
        F.array_join(F.transform("items", lambda x: x["name"]), ",").alias("item_names"),
        F.col("consumers").isNotNull().alias("has_consumer"),
        F.col("consumers.customer_name").alias("customer_name"),
        F.col("consumers.customer_phone_number").alias("customer_phone_number"),
        F.col("consumers.language").alias("language"),
        F.col("restaurants.id").alias("restaurant_id"),
        F.col("restaurants.merchant_city").alias("restaurant_city"),
        F.col("status").isNotNull().alias("has_status"),
        F.col("status.value").alias("last_status"),
        F.col("status.created_at").alias("last_status_at"),
        *DATE_PARTITIONS,
    )


@query(
    f"""
    WITH last_status AS (
        SELECT l_orderkey, l_returnflag || l_linestatus AS value, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey
            ORDER BY l_shipdate DESC, l_linenumber || '-' || l_partkey || '-' || l_suppkey DESC,
                     l_returnflag || l_linestatus DESC) = 1),
    local AS (
        SELECT *, {ZONE_SQL.format(key="o_orderkey")} AS zone,
               timezone({ZONE_SQL.format(key="o_orderkey")}, timezone('UTC', o_orderdate)) AS local_at,
               CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 120 END AS merchant
        FROM orders)
    SELECT cast(o_orderkey AS VARCHAR) AS order_id, sha1(md5('cpf-' || o_custkey)) AS cpf,
           cast(o_custkey AS VARCHAR) AS customer_id, cast(merchant AS VARCHAR) AS merchant_id,
           local_at AS order_created_at, o_orderdate AS order_created_at_utc,
           o_totalprice AS order_total_amount, o_orderpriority AS origin_platform,
           sha1(md5('name ' || o_custkey)) AS order_customer_name,
           'city ' || (o_custkey % 50) AS delivery_address_city,
           'country ' || (o_custkey % 50) AS delivery_address_country,
           'district ' || (o_custkey % 50) AS delivery_address_district,
           'external_id ' || (o_custkey % 50) AS delivery_address_external_id,
           'state ' || (o_custkey % 50) AS delivery_address_state,
           'zip_code ' || (o_custkey % 50) AS delivery_address_zip_code,
           sha1(md5((o_custkey % 90) || '.5')) AS delivery_address_latitude,
           sha1(md5(cast(CAST(o_custkey % 180 - 90.5 AS DOUBLE) AS VARCHAR))) AS delivery_address_longitude,
           (o_orderkey % 120) / 4.0::DOUBLE AS merchant_latitude,
           (o_orderkey % 120) / -8.0::DOUBLE AS merchant_longitude,
           zone AS merchant_timezone, o_orderkey % 2 = 0 AS order_scheduled,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS order_scheduled_date,
           array_to_string(list_transform(range(1, o_orderkey % 3 + 2), lambda i: 'item ' || i), ',') AS item_names,
           c_custkey IS NOT NULL AS has_consumer, sha1(md5(c_name)) AS customer_name,
           sha1(md5(cast(c_acctbal AS VARCHAR))) AS customer_phone_number,
           c_mktsegment AS language, cast(s_suppkey AS VARCHAR) AS restaurant_id,
           s_name AS restaurant_city, l_orderkey IS NOT NULL AS has_status, value AS last_status,
           l_shipdate AS last_status_at, {DATE_SQL.format(t="coalesce(local_at, o_orderdate)")}
    FROM local
    LEFT JOIN last_status ON l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN supplier ON s_suppkey = merchant
    """
)
def orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.orders(spark, sf_dir)
    mart = marts.orders_mart(
        orders,
        adapters.line_statuses(spark, sf_dir),
        adapters.consumers(spark, sf_dir),
        adapters.restaurants(spark, sf_dir),
    )
    return flat_orders(mart)


@query(
    f"""
    WITH version AS (
        SELECT l_orderkey, l_returnflag,
               max(l_shipdate) + to_seconds(ascii(l_returnflag)) AS created
        FROM lineitem GROUP BY l_orderkey, l_returnflag
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY created DESC) = 1),
    newest AS (
        SELECT * FROM lineitem JOIN version USING (l_orderkey, l_returnflag) WHERE l_quantity > 1
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY 'part ' || l_partkey DESC, l_quantity DESC,
                     cast(l_extendedprice AS VARCHAR) DESC, cast(l_suppkey AS VARCHAR) DESC) = 1)
    SELECT cast(l_orderkey AS VARCHAR) AS order_id, created AS order_created_at,
           'part ' || l_partkey AS name, l_quantity AS quantity, l_linenumber AS sequence,
           cast(l_extendedprice AS VARCHAR) AS unit_price,
           (l_discount > 0)::INTEGER + (l_tax > 0)::INTEGER AS n_garnish,
           {DATE_SQL.format(t="created")}
    FROM newest
    """
)
def order_items_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.order_items_mart(adapters.item_orders(spark, sf_dir)).select(
        "order_id",
        "order_created_at",
        "item.name",
        "item.quantity",
        "item.sequence",
        F.col("item.unitPrice.value").alias("unit_price"),
        F.array_size("item.garnishItems").alias("n_garnish"),
        *DATE_PARTITIONS,
    )


TOUCHED_SQL = """SELECT DISTINCT user_id FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11 12:00:00'"""


def touched_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history of the keys with an event in the interval."""
    statuses = adapters.event_statuses(spark, sf_dir)
    interval = datetime(2024, 1, 10), datetime(2024, 1, 11, 12)
    touched = in_interval(statuses, "created_at", *interval).select("order_id").distinct()
    return matching(statuses, touched, "order_id")


@query(
    f"""
    WITH touched AS ({TOUCHED_SQL})
    SELECT cast(user_id AS VARCHAR) AS order_id, {TIMELINE_TEXT_SQL} AS status,
           min(ts) AS date_partition, {DATE_SQL.format(t="min(ts)")}
    FROM events SEMI JOIN touched USING (user_id) GROUP BY user_id
    """
)
def order_statuses_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.order_statuses_mart(touched_statuses(spark, sf_dir))
    return mart.withColumn("status", timeline_text())


@query(
    f"""
    WITH touched AS ({TOUCHED_SQL})
    SELECT cast(user_id AS VARCHAR) AS order_id,
           max(ts) FILTER (WHERE event_type = 'view') AS view,
           max(ts) FILTER (WHERE event_type = 'click') AS click,
           max(ts) FILTER (WHERE event_type = 'purchase') AS purchase,
           max(ts) FILTER (WHERE event_type = 'signup') AS signup,
           max(ts) FILTER (WHERE event_type = 'error') AS error,
           min(ts) AS date_partition, {DATE_SQL.format(t="min(ts)")}
    FROM events SEMI JOIN touched USING (user_id) GROUP BY user_id
    """
)
def order_status_times_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.order_status_times_mart(touched_statuses(spark, sf_dir), events=EVENT_KINDS)
