"""The driver's test tables in the shape of the raw layer.

orders -> order versions, lineitem -> item rows and status events, events -> status events
of long-lived keys, customer -> consumers, supplier -> restaurants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = ("America/Sao_Paulo", "America/New_York", "Asia/Tokyo", "Europe/Lisbon", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def zone_of(key: str) -> Column:
    """One of ZONES by the key, the last of them being none at all."""
    chosen = None
    for i, zone in enumerate(ZONES):
        hit = F.col(key) % len(ZONES) == i
        chosen = F.when(hit, F.lit(zone)) if chosen is None else chosen.when(hit, F.lit(zone))
    return chosen.cast("string")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a merchant that every eighth order lacks, and a zone."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 8 != 0, (F.col("o_orderkey") % 120).cast("string")).alias(
            "merchant_id"
        ),
        F.concat(F.lit("cpf-"), text("o_custkey")).alias("cpf"),
        zone_of("o_orderkey").alias("merchant_timezone"),
        F.col("o_orderdate").alias("order_created_at"),
        F.col("o_totalprice").alias("order_total_amount"),
        F.col("o_orderpriority").alias("origin_platform"),
        F.concat(F.lit("name "), text("o_custkey")).alias("customer_name"),
        *(
            F.concat(F.lit(f"{part} "), (F.col("o_custkey") % 50).cast("string")).alias(f"delivery_address_{part}")
            for part in ("city", "country", "district", "external_id", "state", "zip_code")
        ),
        (F.col("o_custkey") % 90 + 0.5).cast("double").alias("delivery_address_latitude"),
        (F.col("o_custkey") % 180 - 90.5).cast("double").alias("delivery_address_longitude"),
        (F.col("o_orderkey") % 120 / 4).cast("double").alias("merchant_latitude"),
        (F.col("o_orderkey") % 120 / -8).cast("double").alias("merchant_longitude"),
        (F.col("o_orderkey") % 2 == 0).alias("order_scheduled"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("order_scheduled_date"),
        F.transform(
            F.sequence(F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")),
            lambda i: F.struct(
                F.concat(F.lit("item "), i.cast("string")).alias("name"), i.alias("sequence")
            ),
        ).alias("items"),
    )


def line_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as status events: several per order, some at the same instant."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("order_id"),
        F.concat_ws("-", text("l_linenumber"), text("l_partkey"), text("l_suppkey")).alias(
            "status_id"
        ),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
        F.col("l_shipdate").alias("created_at"),
    )


def event_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as status events of their user."""
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("order_id"),
        text("event_id").alias("status_id"),
        F.col("event_type").alias("value"),
        F.col("ts").alias("created_at"),
    )


def consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("language"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.col("c_name").alias("customer_name"),
        text("c_nationkey").alias("customer_phone_area"),
        text("c_acctbal").alias("customer_phone_number"),
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("id"),
        (F.col("s_acctbal") > 0).alias("enabled"),
        F.col("s_acctbal").alias("average_ticket"),
        F.col("s_name").alias("merchant_city"),
        text("s_nationkey").alias("merchant_zip_code"),
    )


def money(amount: Column) -> Column:
    return F.struct(amount.cast("string").alias("value"), F.lit("BRL").alias("currency"))


def item_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items grouped into order versions, their items as JSON text.

    The return flag tells the versions of an order apart, up to three of them; a version is as old
    as its last shipping date, and some seconds that differ by flag, so that no two are equal. Its
    array holds all its lines but those of quantity 1, up to 13 of them, with line numbers that
    repeat. An item has a garnish item for its discount and one for its tax where they are not
    zero, so that list has none, one or two elements.
    """
    garnish = F.filter(
        F.array(
            F.when(
                F.col("l_discount") > 0,
                F.struct(
                    F.lit("discount").alias("name"),
                    F.col("l_discount").alias("quantity"),
                    F.lit(1).alias("sequence"),
                ),
            ),
            F.when(
                F.col("l_tax") > 0,
                F.struct(
                    F.lit("tax").alias("name"),
                    F.col("l_tax").alias("quantity"),
                    F.lit(2).alias("sequence"),
                ),
            ),
        ),
        lambda g: g.isNotNull(),
    )
    item = F.struct(
        F.concat(F.lit("part "), text("l_partkey")).alias("name"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").alias("sequence"),
        money(F.col("l_extendedprice")).alias("unitPrice"),
        text("l_suppkey").alias("externalId"),
        garnish.alias("garnishItems"),
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("item", F.when(F.col("l_quantity") > 1, item))
    versions = lines.groupBy("l_orderkey", "l_returnflag").agg(
        F.max("l_shipdate").alias("shipped"), F.array_sort(F.collect_list("item")).alias("items")
    )
    later = F.make_dt_interval(secs=F.ascii("l_returnflag").cast("decimal(18,6)"))
    return versions.select(
        text("l_orderkey").alias("order_id"),
        (F.col("shipped") + later).alias("order_created_at"),
        F.to_json("items").alias("items"),
        F.col("l_returnflag").alias("version"),
    )
