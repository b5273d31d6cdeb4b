"""Queries that go through files: sources, tables, upserts, and the run over intervals.

Each writes what it needs from the given tables below a fresh folder in the shared scratch
folder, runs the library's job on it, and reads the result back.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.dates import in_partition_window, with_date_partitions
from lakemart.operators.latest import dedup
from lakemart.operators.upsert import upsert
from lakemart.plans import jobs, marts
from lakemart.registry import adapters
from lakemart.registry.adapters import table, text
from lakemart.registry.catalog import query
from lakemart.registry.marts import DATE_SQL, flat_orders
from lakemart.registry.transforms import TIMELINE_TEXT_SQL, ZONE_SQL, timeline_text
from lakemart.schemas import DATASETS, DATE_PARTITIONS
from lakemart.session import scratch_path
from lakemart.sources.tables import read_table, table_files, write_table
from lakemart.streaming.landing import land_new_files

# Columns of the orders mart that the sources of the backfill queries leave empty.
NO_VALUES_SQL = ", ".join(
    [
        f"NULL::{kind} AS {name}"
        for kind, names in {
            "VARCHAR": "origin_platform order_customer_name delivery_address_city"
            " delivery_address_country delivery_address_district delivery_address_external_id"
            " delivery_address_state delivery_address_zip_code delivery_address_latitude"
            " delivery_address_longitude",
            "DOUBLE": "merchant_latitude merchant_longitude",
            "BOOLEAN": "order_scheduled",
            "TIMESTAMP": "order_scheduled_date",
        }.items()
        for name in names.split()
    ]
)

JANUARY = datetime(2024, 1, 1), datetime(2024, 2, 1)


def utc_text(name: str):
    """ISO text with a zone letter, as the JSON sources write time."""
    return F.concat(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, cast(event_id AS VARCHAR) AS status_id,
           event_type AS value, ts AS created_at, {DATE_SQL.format(t="ts")}
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21 18:00:00'
    """
)
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events as JSON lines, a third of them twice, into the raw table."""
    path = scratch_path(spark, "ingest_json")
    events = adapters.event_statuses(spark, sf_dir)
    lines = events.withColumn("created_at", utc_text("created_at"))
    lines = lines.unionAll(lines.where(F.col("status_id").cast("long") % 3 == 0))
    lines.write.json(f"{path}/source")
    start, end = datetime(2024, 1, 5), datetime(2024, 1, 21, 18)
    jobs.ingest(spark, "order_statuses", f"{path}/source", path, start, end)
    jobs.check_ingest(spark, "order_statuses", f"{path}/source", path, start, end)
    return read_table(spark, jobs.raw_path(path, "order_statuses")).drop("extra")


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, cast(event_id AS VARCHAR) AS status_id,
           event_type AS value, ts AS created_at, {DATE_SQL.format(t="ts")}
    FROM events
    """
)
def land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events as JSON files that arrive in two lots, landed after each."""
    path = scratch_path(spark, "land_stream")
    events = adapters.event_statuses(spark, sf_dir)
    lines = events.withColumn("created_at", utc_text("created_at"))
    odd = F.col("status_id").cast("long") % 2 == 1
    for lot in (lines.where(odd), lines.where(~odd)):
        lot.write.mode("append").json(f"{path}/source")
        landed = land_new_files(spark, "order_statuses", f"{path}/source", f"{path}/landed")
    return landed.drop("extra")


@query(
    f"""
    SELECT cast(event_id AS VARCHAR) AS status_id, ts AS created_at,
           CASE WHEN event_id % 3 > 0 THEN 'by ' || event_type END AS channel,
           CASE WHEN event_id % 3 = 2 THEN user_id END AS device_user, {DATE_SQL.format(t="ts")}
    FROM events
    """
)
def land_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are not declared and come with the second and the third lot of files only."""
    path = scratch_path(spark, "land_undeclared")
    lines = adapters.event_statuses(spark, sf_dir).withColumn("created_at", utc_text("created_at"))
    third = F.col("status_id").cast("long") % 3
    channel = F.concat(F.lit("by "), "value")
    device = F.struct(F.col("order_id").cast("long").alias("user"))
    lots = [
        lines.where(third == 0),
        lines.where(third == 1).withColumn("channel", channel),
        lines.where(third == 2).withColumns({"channel": channel, "device.info": device}),
    ]
    for lot in lots:
        lot.write.mode("append").json(f"{path}/source")
        landed = land_new_files(spark, "order_statuses", f"{path}/source", f"{path}/landed")
    return landed.select(
        "status_id",
        "created_at",
        F.variant_get("extra", "$.channel", "string").alias("channel"),
        F.variant_get("extra", "$['device.info'].user", "long").alias("device_user"),
        *DATE_PARTITIONS,
    )


CREATED_SQL = "TIMESTAMP '2018-01-01 10:00:00' + to_days(CAST(c_custkey % 40 AS INTEGER))"


@query(
    f"""
    SELECT cast(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS language,
           {CREATED_SQL} AS created_at, c_acctbal > 0 AS active, c_name AS customer_name,
           cast(c_nationkey AS VARCHAR) AS customer_phone_area,
           cast(c_acctbal AS VARCHAR) AS customer_phone_number,
           {DATE_SQL.format(t=CREATED_SQL)}
    FROM customer
    """
)
def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumers as gzip CSV files with a header each; every second one has an older version."""
    path = scratch_path(spark, "ingest_csv")
    people = adapters.consumers(spark, sf_dir).withColumn(
        "created_at",
        F.lit("2018-01-01 10:00:00").cast("timestamp_ntz")
        + F.make_dt_interval((F.col("customer_id").cast("int") % 40)),
    )
    older = people.where(F.col("customer_id").cast("long") % 2 == 0).withColumns(
        {
            "created_at": F.col("created_at") - F.make_dt_interval(F.lit(1)),
            "customer_name": F.lit('an older name, with a comma and a "quote"'),
        }
    )
    rows = people.unionByName(older).withColumn("created_at", text("created_at"))
    rows.write.option("header", True).option("escape", '"').csv(
        f"{path}/source", compression="gzip"
    )
    start, end = datetime(2017, 1, 1), datetime(2019, 1, 1)
    jobs.ingest(spark, "consumers", f"{path}/source", path, start, end)
    jobs.check_ingest(spark, "consumers", f"{path}/source", path, start, end)
    return read_table(spark, jobs.raw_path(path, "consumers")).drop("extra")


def events_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Events written as a date-partitioned table and scanned again."""
    path = scratch_path(spark, name)
    write_table(with_date_partitions(table(spark, sf_dir, "events"), "ts"), path)
    return read_table(spark, path)


@query(
    f"""
    SELECT event_id, ts, user_id, event_type, value, props, {DATE_SQL.format(t="ts")} FROM events
    """
)
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_table(spark, sf_dir, "write_roundtrip")


@query(
    f"""
    SELECT event_id, ts, {DATE_SQL.format(t="ts")} FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-14'
    """
)
def partition_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole day partitions: an end within a day keeps that day's partition."""
    events = events_table(spark, sf_dir, "partition_window")
    window = in_partition_window(events, datetime(2024, 1, 10, 8), datetime(2024, 1, 13, 8))
    return window.select("event_id", "ts", "year_partition", "month_partition", "day_partition")


@query(
    f"""
    SELECT {DATE_SQL.format(t="ts")}, count(*) AS row_count, true AS few_files
    FROM events GROUP BY 1, 2, 3
    """
)
def layout_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition, and whether its files are no more than its size calls for."""
    files = table_files(events_table(spark, sf_dir, "layout_file_counts"))
    allowed = 1 + F.ceil(F.col("bytes") / F.lit(8 * 1024 * 1024))
    few = (F.col("files") <= allowed).alias("few_files")
    return files.select("year_partition", "month_partition", "day_partition", "row_count", few)


@query(
    """
    WITH line AS (
        SELECT l_orderkey, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS sequence,
               l_suppkey, l_quantity, l_returnflag FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, CASE WHEN l_linenumber < 7 THEN l_linenumber END
            ORDER BY l_suppkey DESC, l_quantity DESC, l_returnflag DESC) = 1),
    source AS (
        SELECT * REPLACE (l_quantity + 100 AS l_quantity,
                          CASE WHEN sequence = 1 THEN 'Z' ELSE l_returnflag END AS l_returnflag)
        FROM line WHERE l_orderkey % 3 = 0),
    target AS (SELECT * FROM line WHERE l_orderkey % 3 > 0 OR l_orderkey % 4 > 0)
    SELECT t.* FROM target t ANTI JOIN source s
        ON t.l_orderkey = s.l_orderkey AND t.sequence IS NOT DISTINCT FROM s.sequence
    UNION ALL SELECT * FROM source
    """
)
def upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys, one of them null at times; some rows move to another partition."""
    path = scratch_path(spark, "upsert_composite") + "/lines"
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("sequence"),
        "l_suppkey",
        "l_quantity",
        "l_returnflag",
    )
    keys, partitions = ["l_orderkey", "sequence"], ["l_returnflag"]
    # Written once: the upserts below read it several times.
    dedup(lines, keys).write.parquet(f"{path}__lines")
    lines = spark.read.parquet(f"{path}__lines")
    moved = F.when(F.col("sequence") == 1, "Z").otherwise(F.col("l_returnflag"))
    source = lines.where(F.col("l_orderkey") % 3 == 0).withColumns(
        {"l_quantity": F.col("l_quantity") + 100, "l_returnflag": moved}
    )
    # Every key is in the table, in the batch, or in both.
    first = lines.where((F.col("l_orderkey") % 3 > 0) | (F.col("l_orderkey") % 4 > 0))
    upsert(spark, path, first, keys, partitions=partitions)
    upsert(spark, path, source, keys, partitions=partitions)
    upsert(spark, path, source, keys, partitions=partitions)
    return read_table(spark, path, partitions)


FIRST_HALF = datetime(2024, 1, 1), datetime(2024, 1, 15)
SECOND_HALF = datetime(2024, 1, 15), datetime(2024, 2, 1)


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, cast(event_id AS VARCHAR) AS status_id,
           event_type AS value, ts AS created_at,
           CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'by ' || event_type END AS channel,
           {DATE_SQL.format(t="ts")}
    FROM events
    """
)
def ingest_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is not declared, and that the source has from the second interval on."""
    path = scratch_path(spark, "ingest_undeclared")
    lines = adapters.event_statuses(spark, sf_dir).withColumn("created_at", utc_text("created_at"))
    lines.write.json(f"{path}/source/1")
    lines.withColumn("channel", F.concat(F.lit("by "), "value")).write.json(f"{path}/source/2")
    for lot, interval in (("1", FIRST_HALF), ("2", SECOND_HALF)):
        jobs.ingest(spark, "order_statuses", f"{path}/source/{lot}", path, *interval)
        jobs.check_ingest(spark, "order_statuses", f"{path}/source/{lot}", path, *interval)
    raw = read_table(spark, jobs.raw_path(path, "order_statuses"))
    channel = F.variant_get("extra", "$.channel", "string").alias("channel")
    return raw.select("order_id", "status_id", "value", "created_at", channel, *DATE_PARTITIONS)


# Names that break a schema: dots, names that differ in case, and names the library uses itself.
ODD_NAMES = ("utm.source", "Value", "year_partition", "_place", "extra", "a`b'c")


@query(
    f"""
    SELECT 'json' AS format, cast(event_id AS VARCHAR) AS id, event_type AS declared,
           'utm ' || user_id AS field_0, cast(value AS VARCHAR) AS field_1, '1999' AS field_2,
           CASE WHEN event_id % 2 = 0 THEN 'place' END AS field_3, 'more' AS field_4, 'quoted' AS field_5,
           {DATE_SQL.format(t="ts")}
    FROM events
    UNION ALL
    SELECT 'csv', cast(c_custkey AS VARCHAR), c_mktsegment, 'utm ' || c_nationkey, cast(c_acctbal AS VARCHAR), '1999',
           CASE WHEN c_custkey % 2 = 0 THEN 'place' END, 'more', 'quoted', '2018', '01', '01'
    FROM customer
    """
)
def ingest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines and CSV files with fields of odd names beside the declared ones."""
    path = scratch_path(spark, "ingest_names")

    def odd(source, amount, number):
        values = [
            F.concat(F.lit("utm "), source), amount, F.lit("1999"),
            F.when(number.cast("long") % 2 == 0, "place"), F.lit("more"), F.lit("quoted"),
        ]
        return list(zip(ODD_NAMES, values, strict=True))

    events = table(spark, sf_dir, "events").select(
        text("user_id").alias("order_id"), text("event_id").alias("status_id"),
        F.col("event_type").alias("value"), utc_text("ts").alias("created_at"), text("value").alias("amount"),
    )
    declared = ["order_id", "status_id", "value", "created_at"]
    fields = odd(F.col("order_id"), F.col("amount"), F.col("status_id"))
    # Written by hand: no frame can hold `value` and `Value` side by side.
    pairs = [(name, F.col(name)) for name in declared] + fields
    cells = [F.when(v.isNotNull(), F.concat(F.lit(f'"{n}":"'), v, F.lit('"'))) for n, v in pairs]
    line = F.concat(F.lit("{"), F.concat_ws(",", *cells), F.lit("}"))
    events.select(line).write.text(f"{path}/json")
    people = adapters.consumers(spark, sf_dir).withColumn("created_at", F.lit("2018-01-01 10:00:00"))
    columns = DATASETS["consumers"].schema.names
    fields = odd(F.col("customer_phone_area"), F.col("customer_phone_number"), F.col("customer_id"))
    names = [*columns, "LANGUAGE", *[name for name, _ in fields]]
    cells = [*(text(c) for c in columns), F.lit("other"), *[v for _, v in fields]]
    line = F.concat_ws(",", *[F.coalesce(cell, F.lit("")) for cell in cells])
    begins = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = F.when(begins, F.array(F.lit(",".join(names)), line)).otherwise(F.array(line))
    people.select(F.explode(lines)).write.text(f"{path}/csv")
    both = None
    for kind, name, id, value, span in (
        ("json", "order_statuses", "status_id", "value", JANUARY),
        ("csv", "consumers", "customer_id", "language", (datetime(2018, 1, 1), datetime(2019, 1, 1))),
    ):
        jobs.ingest(spark, name, f"{path}/{kind}", path, *span)
        jobs.check_ingest(spark, name, f"{path}/{kind}", path, *span)
        rows = read_table(spark, jobs.raw_path(path, name)).select(
            F.lit(kind).alias("format"),
            F.col(id).alias("id"),
            F.col(value).alias("declared"),
            *[field(name).alias(f"field_{i}") for i, name in enumerate(ODD_NAMES)],
            *DATE_PARTITIONS,
        )
        both = rows if both is None else both.unionAll(rows)
    return both


def field(name: str):
    """A field of `extra` as text, by any name; null where a row has none."""
    return F.element_at(F.from_json(F.to_json("extra"), "map<string,string>"), name)


REJECTED_SQL = """CASE WHEN event_id % 13 = 0 THEN 'line:malformed,order_id:null,status_id:null,created_at:null'
    ELSE concat_ws(',', CASE WHEN event_id % 11 = 0 THEN 'order_id:null' END,
                   CASE WHEN event_id % 7 = 0 THEN 'created_at:unreadable' END) END"""


@query(
    f"""
    SELECT reject_reasons, count(*) AS row_count
    FROM (SELECT {REJECTED_SQL} AS reject_reasons FROM events) WHERE reject_reasons <> '' GROUP BY 1
    UNION ALL SELECT '', count(*) FROM (SELECT {REJECTED_SQL} AS r FROM events) WHERE r = ''
    """
)
def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are cut short, ids that are missing, times that cannot be read: each line of the
    source is in the raw table (no reason) or among the rejected rows."""
    path = scratch_path(spark, "ingest_rejected")
    events = adapters.event_statuses(spark, sf_dir)
    number = F.col("status_id").cast("long")
    time = F.when(number % 7 == 0, "yesterday").otherwise(utc_text("created_at"))
    id = F.when(number % 11 != 0, F.col("order_id"))
    line = F.to_json(F.struct(id.alias("order_id"), "status_id", "value", time.alias("created_at")))
    cut = F.when(number % 13 == 0, F.expr("substr(line, 1, length(line) - 9)")).otherwise(F.col("line"))
    events.withColumn("line", line).select(cut).write.text(f"{path}/source")
    jobs.ingest(spark, "order_statuses", f"{path}/source", path, *JANUARY)
    jobs.check_ingest(spark, "order_statuses", f"{path}/source", path, *JANUARY)
    kept = jobs.read_rejected_rows(spark, path, "order_statuses").select("reject_reasons")
    taken = read_table(spark, jobs.raw_path(path, "order_statuses"))
    every = kept.unionAll(taken.select(F.lit("").alias("reject_reasons")))
    return every.groupBy("reject_reasons").agg(F.count("*").alias("row_count"))


@query(
    """
    SELECT cast(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, true AS taken
    FROM customer WHERE c_custkey % 5 > 0
    UNION ALL
    SELECT cast(c_custkey AS VARCHAR), 'Silva', false FROM customer WHERE c_custkey % 5 = 0
    """
)
def ingest_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth line has a comma in its name that no quotes protect, so its columns shift: it is
    rejected, not taken with parts of the name under other columns."""
    path = scratch_path(spark, "ingest_csv_malformed")
    names = DATASETS["consumers"].schema.names
    people = adapters.consumers(spark, sf_dir).withColumn("created_at", F.lit("2018-01-01 10:00:00"))
    number = F.col("customer_id").cast("long")
    comma = F.when(number % 5 == 0, "Silva, Joao").otherwise(F.col("customer_name"))
    people = people.withColumn("customer_name", comma)
    line = F.concat_ws(",", *(F.col(name).cast("string") for name in names))
    # The first line of each file is the header.
    begins = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = F.when(begins, F.array(F.lit(",".join(names)), line)).otherwise(F.array(line))
    people.select(F.explode(lines)).write.text(f"{path}/source")
    year = datetime(2018, 1, 1), datetime(2019, 1, 1)
    jobs.ingest(spark, "consumers", f"{path}/source", path, *year)
    jobs.check_ingest(spark, "consumers", f"{path}/source", path, *year)
    taken = read_table(spark, jobs.raw_path(path, "consumers"))
    kept = jobs.read_rejected_rows(spark, path, "consumers").where("reject_reasons = 'line:malformed'")
    return taken.select("customer_id", "customer_name", F.lit(True).alias("taken")).unionAll(
        kept.select("customer_id", "customer_name", F.lit(False))
    )


@query(
    f"""
    SELECT event_id, ts, user_id, event_type, value, props, {DATE_SQL.format(t="ts")} FROM events
    """
)
def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without rows leaves the table as it is."""
    path = scratch_path(spark, "empty_batch") + "/events"
    events = with_date_partitions(table(spark, sf_dir, "events"), "ts")
    upsert(spark, path, events, ["event_id"])
    upsert(spark, path, events.where("event_id < 0"), ["event_id"])
    return read_table(spark, path)


@query(
    f"""
    WITH people AS (
        SELECT *,
               {ZONE_SQL.format(key="user_id")} AS zone FROM events),
    newest AS (
        SELECT * FROM people QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1),
    local AS (SELECT *, timezone(zone, timezone('UTC', ts)) AS local_at FROM newest)
    SELECT cast(user_id AS VARCHAR) AS order_id, sha1(md5('cpf-' || user_id)) AS cpf,
           cast(user_id AS VARCHAR) AS customer_id, cast(event_id % 120 AS VARCHAR) AS merchant_id,
           local_at AS order_created_at, ts AS order_created_at_utc, value AS order_total_amount,
           {NO_VALUES_SQL}, zone AS merchant_timezone,
           (SELECT string_agg(event_type || ' ' || i, ',' ORDER BY i) FROM range(event_id % 3 + 1) r(i)) AS item_names,
           c_custkey IS NOT NULL AS has_consumer, sha1(md5(c_name)) AS customer_name,
           sha1(md5(cast(c_acctbal AS VARCHAR))) AS customer_phone_number,
           CASE WHEN c_custkey % 3 = 0 THEN 'later ' ELSE '' END || c_mktsegment AS language,
           cast(s_suppkey AS VARCHAR) AS restaurant_id,
           s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' II' ELSE '' END AS restaurant_city, true AS has_status, event_type AS last_status,
           ts AS last_status_at, {DATE_SQL.format(t="coalesce(local_at, ts)")}
    FROM local
    LEFT JOIN customer ON c_custkey = user_id
    LEFT JOIN supplier ON s_suppkey = event_id % 120
    """
)
def backfill_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders mart after three intervals in turn; the SQL has all of January at once.

    Consumers and restaurants begin on all days of the month, some have a second version later, so
    their rows reach orders of earlier intervals.
    """
    return flat_orders(backfilled(spark, sf_dir, "orders"))


@query(
    f"""
    WITH newest AS (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
    SELECT cast(user_id AS VARCHAR) AS order_id, ts AS order_created_at,
           event_type || ' ' || i AS name, i::INTEGER AS sequence, {DATE_SQL.format(t="ts")}
    FROM (SELECT *, unnest(range(event_id % 3 + 1)) AS i FROM newest)
    """
)
def backfill_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items mart after three intervals: the items of each order's newest version."""
    return backfilled(spark, sf_dir, "order_items").select(
        "order_id", "order_created_at", "item.name", "item.sequence", *DATE_PARTITIONS
    )


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, {TIMELINE_TEXT_SQL} AS status,
           min(ts) AS date_partition, {DATE_SQL.format(t="min(ts)")}
    FROM events GROUP BY user_id
    """
)
def backfill_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statuses mart after three intervals: the whole list of events of each order."""
    return backfilled(spark, sf_dir, "order_statuses").withColumn("status", timeline_text()).drop("part")


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, {TIMELINE_TEXT_SQL} AS status,
           min(ts) AS date_partition, {DATE_SQL.format(t="min(ts)")}
    FROM events GROUP BY user_id
    """
)
def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statuses mart after a backfill of sources that lack some days of the second interval, and
    one of the whole sources, which builds that interval alone again."""
    path = scratch_path(spark, "backfill_resumed")
    for some in ("ts < '2024-01-13' OR ts >= '2024-01-16'", "true"):
        sources = write_sources(spark, sf_dir, path, some)
        jobs.backfill(spark, sources, path, *JANUARY, step=timedelta(days=11))
    statuses = read_table(spark, jobs.trusted_path(path, "order_statuses"))
    return statuses.withColumn("status", timeline_text()).drop("part")


def backfilled(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    """A mart of a lake that a backfill of its own has built."""
    path = scratch_path(spark, "backfill")
    sources = write_sources(spark, sf_dir, path)
    jobs.backfill(spark, sources, path, *JANUARY, step=timedelta(days=11))
    return read_table(spark, jobs.trusted_path(path, mart))


def versions(people: DataFrame, key: str, renewed_every: int, name: str, value) -> DataFrame:
    """Rows that begin on some day of January, and a second version of some six days later."""
    days = F.col(key).cast("int") % 24
    begin = F.lit("2024-01-01 06:00:00").cast("timestamp_ntz") + F.make_dt_interval(days)
    first = people.withColumn("created_at", begin)
    again = people.where(F.col(key).cast("int") % renewed_every == 0).withColumn(name, value)
    again = again.withColumn("created_at", begin + F.make_dt_interval(F.lit(6)))
    return first.unionByName(again).withColumn("created_at", utc_text("created_at"))


def write_sources(
    spark: SparkSession, sf_dir: str, path: str, some: str = "true"
) -> dict[str, str]:
    """Every event as a version of its user's order and as a status of it, with both sides."""
    events = table(spark, sf_dir, "events").where(some)
    items = F.transform(
        F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")),
        lambda i: F.struct(
            F.concat_ws(" ", F.col("event_type"), i.cast("string")).alias("name"),
            i.alias("sequence"),
            adapters.money(F.col("value")).alias("unitPrice"),
        ),
    )
    later = F.concat(F.lit("later "), "language")
    second = F.concat("merchant_city", F.lit(" II"))
    frames = {
        "orders": events.select(
            text("user_id").alias("order_id"),
            text("user_id").alias("customer_id"),
            (F.col("event_id") % 120).cast("string").alias("merchant_id"),
            F.concat(F.lit("cpf-"), text("user_id")).alias("cpf"),
            adapters.zone_of("user_id").alias("merchant_timezone"),
            utc_text("ts").alias("order_created_at"),
            F.col("value").alias("order_total_amount"),
            F.to_json(items).alias("items"),
        ),
        "order_statuses": events.select(
            text("user_id").alias("order_id"),
            text("event_id").alias("status_id"),
            F.col("event_type").alias("value"),
            utc_text("ts").alias("created_at"),
        ),
        "consumers": versions(adapters.consumers(spark, sf_dir), "customer_id", 3, "language", later),
        "restaurants": versions(adapters.restaurants(spark, sf_dir), "id", 2, "merchant_city", second),
    }
    sources = {}
    for name, frame in frames.items():
        dataset = DATASETS[name]
        missing = [column for column in dataset.schema.names if column not in frame.columns]
        frame = frame.withColumns({column: F.lit(None).cast("string") for column in missing})
        sources[name] = f"{path}/source/{name}"
        writer = frame.write.mode("overwrite").option("header", True).option("escape", '"')
        writer.format(dataset.format).save(sources[name])
    return sources


# January 2024 laid over October to November 2018, when a day in Sao Paulo began at one o'clock.
SHIFT_DAYS = 1898


@query(
    f"""
    WITH shifted AS (SELECT user_id, event_type, ts - to_days({SHIFT_DAYS}) AS ts FROM events)
    SELECT cast(user_id AS VARCHAR) AS order_id, date_trunc('day', ts)::TIMESTAMP AS period,
           {TIMELINE_TEXT_SQL} AS status, min(ts) AS date_partition, {DATE_SQL.format(t="min(ts)")}
    FROM shifted GROUP BY user_id, date_trunc('day', ts)
    """
)
def status_periods_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statuses mart by day, written by a session of a zone that skips a midnight."""
    path = scratch_path(spark, "status_periods_zone")
    events = adapters.event_statuses(spark, sf_dir)
    events = events.withColumn("created_at", F.col("created_at") - F.make_dt_interval(F.lit(SHIFT_DAYS)))
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "America/Sao_Paulo")
    try:
        write_table(marts.order_statuses_mart(events, grain="day"), path)
    finally:
        spark.conf.set(zone, before)
    return read_table(spark, path).withColumn("status", timeline_text())


FOLDER_SQL = """'year_partition=' || strftime(ts, '%Y') || '/month_partition=' || strftime(ts, '%m')
    || '/day_partition=' || strftime(ts, '%d')"""


@query(
    f"""
    SELECT DISTINCT 'order_id' AS kind, cast(user_id AS VARCHAR) AS key, {FOLDER_SQL} AS folder FROM events
    """
)
def key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index that two ingests keep, the second with some rows of the first."""
    path = scratch_path(spark, "key_index")
    index_two_lots(spark, sf_dir, path)
    return jobs.key_index(spark, path, "order_statuses").pairs()


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, cast(event_id AS VARCHAR) AS status_id,
           event_type AS value, ts AS created_at, {DATE_SQL.format(t="ts")}
    FROM events WHERE user_id IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND user_id % 7 = 0)
    """
)
def history_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history of some keys of the last days, from the partitions that the index names."""
    path = scratch_path(spark, "history_lookup")
    index_two_lots(spark, sf_dir, path)
    raw = jobs.read_raw(spark, path, "order_statuses")
    late = raw.where("created_at >= '2024-01-29' AND cast(order_id AS bigint) % 7 = 0")
    index = jobs.key_index(spark, path, "order_statuses")
    return jobs.history_of(raw, late.select("order_id").distinct(), index)


@query(
    f"""
    SELECT cast(user_id AS VARCHAR) AS order_id, cast(event_id AS VARCHAR) AS status_id,
           event_type AS value, ts AS created_at, {DATE_SQL.format(t="ts")}
    FROM events WHERE user_id IN (SELECT user_id FROM events WHERE ts = (SELECT max(ts) FROM events))
    """
)
def history_of_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history of the keys with the newest event: few, so row groups without them are not read."""
    path = scratch_path(spark, "history_of_newest")
    index_two_lots(spark, sf_dir, path)
    raw = jobs.read_raw(spark, path, "order_statuses")
    newest = raw.agg(F.max("created_at").alias("newest"))
    late = raw.join(newest, F.col("created_at") == F.col("newest"))
    index = jobs.key_index(spark, path, "order_statuses")
    return jobs.history_of(raw, late.select("order_id").distinct(), index)


def index_two_lots(spark: SparkSession, sf_dir: str, path: str) -> None:
    rows = with_date_partitions(adapters.event_statuses(spark, sf_dir), "created_at")
    for lot in ("created_at < '2024-01-20'", "created_at >= '2024-01-15'"):
        jobs.ingest(spark, "order_statuses", rows.where(lot), path, *JANUARY)
