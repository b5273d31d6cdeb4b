"""Jobs over a lake folder: ingest, completeness check, marts, and the run over intervals.

A lake is a folder with `raw/<dataset>`, `trusted/<mart>` and `rejected/<dataset>` below it.
Every job can be run again for the same interval and leaves the same tables.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import in_interval, in_partition_window, intervals, with_date_partitions
from lakemart.operators.joins import matching
from lakemart.operators.latest import dedup, latest
from lakemart.operators.quality import (
    QualityError,
    key_summary,
    partition_skew,
    require_complete,
    unknown_zones,
)
from lakemart.operators.upsert import recover, upsert
from lakemart.plans.ledger import Ledger, fingerprints
from lakemart.plans.marts import (
    order_items_mart,
    order_status_times_mart,
    order_statuses_mart,
    orders_mart,
    orders_partitions,
)
from lakemart.plans.staging import Staged, Watched, stage
from lakemart.schemas import DATASETS, DATE_PARTITIONS, Dataset
from lakemart.session import MOST_LISTED, job_settings
from lakemart.sources.files import read_source, source_counts
from lakemart.sources.keyindex import KeyIndex, in_folders
from lakemart.sources.tables import (
    delete_paths,
    exists,
    list_folders,
    partition_path,
    read_table,
    scratch_folder,
    table_exists,
)


# Events of a list in the statuses mart; orders have a handful, a key of another kind may have more.
STATUS_SEGMENT = 10_000


def raw_path(lake: str, name: str) -> str:
    return f"{lake}/raw/{name}"


def trusted_path(lake: str, name: str) -> str:
    return f"{lake}/trusted/{name}"


def _dataset(dataset: Dataset | str) -> Dataset:
    return DATASETS[dataset] if isinstance(dataset, str) else dataset


def _together(spark: SparkSession, steps: Iterable[Callable[[], None]]) -> None:
    """Run steps that write different tables side by side, so none waits for a free cluster."""
    steps = list(steps)
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def batch_of(
    spark: SparkSession,
    dataset: Dataset,
    source: str | DataFrame,
    start: datetime,
    end: datetime,
    **options,
) -> DataFrame:
    """The typed source rows of one interval with their date partitions."""
    if isinstance(source, DataFrame):
        rows = in_partition_window(source, start, end)
    else:
        rows = with_date_partitions(read_source(spark, dataset, source, **options), dataset.time)
    return in_interval(rows, dataset.time, start, end)


def key_index(spark: SparkSession, lake: str, name: str) -> KeyIndex | None:
    """The index of a raw table; built from the table where it has none, or has it in too many files.
    None where the dataset has no indexed columns."""
    dataset = DATASETS.get(name)
    if dataset is None or not dataset.indexed:
        return None
    index = KeyIndex(spark, f"{lake}/index/{name}", dataset.indexed)
    if not index.exists() or index.crowded():
        index.rebuild(read_raw(spark, lake, name))
    return index


def _merge_batch(
    spark: SparkSession, dataset: Dataset, batch: DataFrame, lake: str, stored: bool = False
) -> None:
    """stored: the batch is a scan of files that stay. Where none of its keys repeats, it is the
    newest row of each as it is, and is merged from there."""
    index = key_index(spark, lake, dataset.name)
    if index is not None:
        index.add(batch)
    counted = key_summary(batch, dataset.keys) if stored else None
    unique = counted is not None and counted["max_rows_per_key"] <= 1
    upsert(
        spark,
        raw_path(lake, dataset.name),
        batch if unique else dedup(batch, dataset.keys, [dataset.time]),
        dataset.keys,
        key_fixes_partition=dataset.key_fixes_partition,
        # With the time in the key there is no older version that could come back.
        newest_by=None if dataset.key_fixes_partition else dataset.time,
        stored_rows=counted["row_count"] if unique else None,
    )


def ingest(
    spark: SparkSession,
    dataset: Dataset | str,
    source: str | DataFrame,
    lake: str,
    start: datetime,
    end: datetime,
    stored: bool = False,
    **options,
) -> None:
    """Upsert one interval of a source into its raw table, the newest row of each key.

    Intervals may come in any order, and again: a newer row of the table is not replaced.
    `source` is the path of the source files, or their typed rows as `land` gives them. Files are
    read once: the same scan gives the rows of the batch and those that cannot be taken, which are
    written to `rejected/<dataset>`, with the reasons. stored: the typed rows are a scan of files that
    stay as they are while this runs.
    """
    dataset = _dataset(dataset)
    Ledger(spark, lake).forget(start, end)
    with job_settings(spark), scratch_folder(spark, "ingest") as scratch:
        if isinstance(source, DataFrame):
            _merge_batch(spark, dataset, batch_of(spark, dataset, source, start, end), lake, stored)
            return
        staged = stage(spark, dataset, source, f"{scratch}/staged", **options)
        rows = with_date_partitions(staged.taken, dataset.time)
        _merge_batch(spark, dataset, in_interval(rows, dataset.time, start, end), lake, stored=True)
        _keep_rejected(dataset, source, lake, staged.rejected)


def rejected_path(lake: str, name: str) -> str:
    return f"{lake}/rejected/{name}"


def _rejected_folder(dataset: Dataset, source: str, lake: str) -> str:
    return f"{rejected_path(lake, dataset.name)}/source={hashlib.sha256(source.encode()).hexdigest()[:12]}"


def _keep_rejected(dataset: Dataset, source: str, lake: str, rows: DataFrame) -> None:
    """The rejected rows of a source, in a folder of its own; the last reading of a source counts.

    A row without a readable time is of no interval, so these are the rows of the whole source. The
    new rows are complete before the old ones go.
    """
    spark, folder = rows.sparkSession, _rejected_folder(dataset, source, lake)
    before = list_folders(spark, folder)
    rows.write.parquet(f"{folder}/run={uuid.uuid4().hex}")
    delete_paths(spark, [f"{folder}/{name}" for name in before])


def read_rejected_rows(spark: SparkSession, lake: str, name: str) -> DataFrame | None:
    """All rejected rows kept for a dataset, or None."""
    path = rejected_path(lake, name)
    if not exists(spark, path):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path)


def land(
    spark: SparkSession,
    dataset: Dataset | str,
    source: str,
    path: str,
    lake: str | None = None,
    **options,
) -> DataFrame:
    """Type a whole source once and keep it by date, so that intervals read only their days: one
    write, with the rows that cannot be taken beside the others.

    With a lake, the rows that cannot be taken are kept there.
    """
    return _land(spark, dataset, source, path, lake, **options).taken


def _land(
    spark: SparkSession, dataset: Dataset | str, source: str, path: str, lake: str | None, **options
) -> Staged:
    dataset = _dataset(dataset)
    with job_settings(spark):
        staged = stage(spark, dataset, source, path, by_date=True, **options)
        if lake is not None:
            _keep_rejected(dataset, source, lake, staged.rejected)
        return staged


def check_ingest(
    spark: SparkSession,
    dataset: Dataset | str,
    source: str | DataFrame,
    lake: str,
    start: datetime,
    end: datetime,
    **options,
) -> None:
    """Raise when a key of the interval is in the source but not in the raw table, or when some
    line of the source files is neither taken nor among the rejected rows.

    Files are read once: the lines count themselves in the comparison of the keys. Where the counts
    do not add up they are taken once more by themselves, as a stage that was run again after a lost
    executor may have counted twice.
    """
    dataset = _dataset(dataset)
    with job_settings(spark):
        table = read_raw(spark, lake, dataset.name)
        if dataset.key_fixes_partition:
            table = in_partition_window(table, start, end)
        if isinstance(source, DataFrame):
            require_complete(batch_of(spark, dataset, source, start, end), table, dataset.keys)
            return
        watched = Watched(spark, dataset, source, **options)
        batch = in_interval(watched.rows, dataset.time, start, end)
        require_complete(batch, table, dataset.keys)
        folder = _rejected_folder(dataset, source, lake)
        kept = spark.read.parquet(folder).count() if exists(spark, folder) else 0
        counts = watched.counts()
        if counts["read"] != counts["accepted"] + kept:
            counts = source_counts(spark, dataset, source, **options)
        if counts["read"] != counts["accepted"] + kept:
            raise QualityError(f"{dataset.name}: {counts} lines, but {kept} rejected rows kept")


def read_raw(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A raw table; no rows where nothing has been ingested yet."""
    path, dataset = raw_path(lake, name), DATASETS[name]
    recover(spark, path)
    if table_exists(spark, path):
        return read_table(spark, path)
    return with_date_partitions(spark.createDataFrame([], dataset.schema), dataset.time)


def _rows_of_interval(raw: DataFrame, name: str, start: datetime, end: datetime) -> DataFrame:
    """Raw rows of [start, end); the partition filter prunes, the time filter is exact."""
    return in_interval(in_partition_window(raw, start, end), DATASETS[name].time, start, end)


def touched_orders(
    raw: Mapping[str, DataFrame],
    start: datetime,
    end: datetime,
    index: KeyIndex | None = None,
) -> DataFrame:
    """(order_id, by_order, by_status): orders that a version or status event of the interval
    touches, and those whose consumer or restaurant has a row of the interval.

    The latter are found in the order tables by two narrow columns: with an index of the orders, of
    the partitions alone that have orders of such a consumer or restaurant, and by value where the
    index knows of a few such consumers or restaurants only.
    """
    parts = []
    for name in ("orders", "order_statuses"):
        rows = _rows_of_interval(raw[name], name, start, end)
        parts.append(rows.select("order_id", F.lit(name).alias("by")))
    for name, key, column in (
        ("consumers", "customer_id", "customer_id"),
        ("restaurants", "id", "merchant_id"),
    ):
        changed = _rows_of_interval(raw[name], name, start, end).select(F.col(key).alias(column))
        orders, few = raw["orders"], None
        if index is not None:
            folders, few = index.found(column, changed, MOST_LISTED)
            orders = in_folders(orders, folders)
        orders = orders.select("order_id", column)
        theirs = matching(orders, changed.distinct(), column) if few is None else orders.where(F.col(column).isin(few))
        parts.append(theirs.select("order_id", F.lit(name).alias("by")))
    every = reduce(DataFrame.unionAll, parts)
    return every.groupBy("order_id").agg(
        F.bool_or(F.col("by") == "orders").alias("by_order"),
        F.bool_or(F.col("by") == "order_statuses").alias("by_status"),
    )


def _found(
    raw: DataFrame, ids: DataFrame, index: KeyIndex | None
) -> tuple[list[str], list[str] | None]:
    """The partition folders with rows of the orders, and the orders as a list where they are few."""
    few = ids.select("order_id").distinct().limit(MOST_LISTED + 1).collect()
    listed = [row["order_id"] for row in few if row["order_id"] is not None]
    listed = listed if len(few) <= MOST_LISTED else None
    if index is not None:
        return index.folders("order_id", ids), listed
    hits = _of_orders(raw.select("order_id", *DATE_PARTITIONS), ids, listed)
    # At most one row per partition folder of the table.
    found = hits.select(*DATE_PARTITIONS).distinct().collect()
    return sorted(partition_path(row, DATE_PARTITIONS) for row in found), listed


def _of_orders(rows: DataFrame, ids: DataFrame, listed: list[str] | None) -> DataFrame:
    return matching(rows, ids, "order_id") if listed is None else rows.where(F.col("order_id").isin(listed))


def history_of(raw: DataFrame, ids: DataFrame, index: KeyIndex | None = None) -> DataFrame:
    """All raw rows of the orders, found in two steps: the index says which partitions have any, and
    only those are read. Without an index a scan of ids and partitions alone says it. A few orders go
    to the scan by their ids, which passes over the row groups and pages that have none of them."""
    folders, listed = _found(raw, ids, index)
    return _of_orders(in_folders(raw, folders), ids, listed)


def _flagged(rows: DataFrame, ids: DataFrame, flag: str, spread: bool) -> DataFrame:
    """The rows of the orders in `ids`, unique there, with a flag of theirs: the semi join and the
    later ones by that flag in one. spread: by key and hash, as `matching` joins."""
    listed = ids.select(F.col("order_id").alias("_id"), F.xxhash64("order_id").alias("_id_hash"), flag)
    same = F.col("order_id") == F.col("_id")
    if spread:
        same = same & (F.xxhash64("order_id") == F.col("_id_hash"))
    return rows.join(listed, same).drop("_id", "_id_hash")


def build_marts(
    spark: SparkSession,
    lake: str,
    start: datetime,
    end: datetime,
    salt: str | None = None,
    validate: bool = True,
    keep_dropped_items: bool = False,
    status_grain: str | None = None,
    status_segment: int | None = STATUS_SEGMENT,
    hot_share: float | None = None,
) -> None:
    """Rebuild in every mart the orders touched in the interval, from their whole history.

    An order is touched by a version, a status event, or a new row of its consumer or restaurant in
    the interval. What the marts get is checked before it is written. `keep_dropped_items` leaves
    items in the mart that the newest version of their order no longer has. `status_grain` splits
    the lists of events by a unit of time, `status_segment` after so many events (in `part`, from 0);
    both the same in every run over a lake. No list is longer than a segment, so an order may have
    any number of events; without one, an order's list (in a period) is one row. `hot_share`: plan the
    lookups of consumers and restaurants with this share of the orders, instead of leaving the skew to
    the adaptive split. Orders with an unknown zone are listed in
    `rejected/order_zones`.
    """
    with job_settings(spark), scratch_folder(spark, "marts") as scratch:
        raw = {name: read_raw(spark, lake, name) for name in DATASETS}
        indexes = {name: key_index(spark, lake, name) for name in ("orders", "order_statuses")}
        # The touched ids serve every mart, so they are written once and read back.
        touched = touched_orders(raw, start, end, indexes["orders"])
        touched.write.parquet(f"{scratch}/ids")
        ids = spark.read.parquet(f"{scratch}/ids")
        touched = ids.select("order_id")
        by_order = ids.where("by_order").select("order_id")
        by_status = ids.where("by_status").select("order_id")
        searched: dict[str, DataFrame] = {}

        # So does what the marts need of their history: the raw tables are searched for it once. Of
        # the versions of an order that is the newest, which a task finds before it sends any; the
        # rows of the orders that are not touched go afterwards, so no more than those travel.
        def collect_orders() -> None:
            folders, listed = _found(raw["orders"], touched, indexes["orders"])
            searched["orders"] = in_folders(raw["orders"], folders)
            versions = searched["orders"] if listed is None else _of_orders(searched["orders"], touched, listed)
            newest = latest(versions, ["order_id"], ["order_created_at"])
            _flagged(newest, ids, "by_order", spread=False).write.parquet(f"{scratch}/orders")

        def collect_statuses() -> None:
            folders, listed = _found(raw["order_statuses"], touched, indexes["order_statuses"])
            searched["order_statuses"] = in_folders(raw["order_statuses"], folders)
            events = searched["order_statuses"]
            events = events if listed is None else _of_orders(events, touched, listed)
            _flagged(events, ids, "by_status", spread=True).write.parquet(f"{scratch}/order_statuses")

        _together(spark, (collect_orders, collect_statuses))
        flags = {"orders": "by_order", "order_statuses": "by_status"}
        flagged = {
            name: spark.read.schema(T.StructType([*raw[name].schema, T.StructField(flag, T.BooleanType())])).parquet(
                f"{scratch}/{name}"
            )
            for name, flag in flags.items()
        }
        history = {name: flagged[name].drop(flag) for name, flag in flags.items()}
        orders = orders_mart(
            history["orders"],
            history["order_statuses"],
            raw["consumers"],
            raw["restaurants"],
            salt=salt,
            hot_share=hot_share,
        )
        items = order_items_mart(flagged["orders"].where("by_order").drop("by_order"))
        events = flagged["order_statuses"].where("by_status").drop("by_status")
        statuses = order_statuses_mart(events, grain=status_grain, segment=status_segment)
        times = order_status_times_mart(events)
        status_keys = ["order_id"]
        status_keys += [] if status_grain is None else ["period"]
        status_keys += [] if status_segment is None else ["part"]

        # Old rows stand where some version or event of the order would put them, an order in
        # any zone: raw versions keep their time, but not the zone they came with at first.
        # The partitions searched have all their rows.
        places = {
            "orders": orders_partitions(searched["orders"]),
            "order_items": searched["orders"].select(*DATE_PARTITIONS),
            "order_statuses": searched["order_statuses"].select(*DATE_PARTITIONS),
            "order_status_times": searched["order_statuses"].select(*DATE_PARTITIONS),
        }
        changed = _rows_of_interval(raw["orders"], "orders", start, end)

        def write(name: str, mart: DataFrame, keys: list[str], replaced: DataFrame) -> None:
            options = {"candidates": places[name]}
            if validate:
                options["not_null"] = ["order_id"]
            if name != "order_items" or not keep_dropped_items:
                # Old rows go by order: an item a newer version no longer has goes too.
                options |= {"replaced": replaced, "replaced_keys": ["order_id"]}
            upsert(spark, trusted_path(lake, name), mart, keys, **options)

        _together(
            spark,
            (
                partial(write, "orders", orders, ["order_id"], touched),
                partial(write, "order_items", items, ["order_id", "item.sequence"], by_order),
                partial(write, "order_statuses", statuses, status_keys, by_status),
                partial(write, "order_status_times", times, ["order_id"], by_status),
                partial(_keep_unknown_zones, spark, lake, changed, start, end),
            ),
        )


def _keep_unknown_zones(
    spark: SparkSession, lake: str, orders: DataFrame, start: datetime, end: datetime
) -> None:
    """Orders of the interval, `orders`, whose zone is given but not known."""
    rows = unknown_zones(orders, "merchant_timezone")
    folder = f"{rejected_path(lake, 'order_zones')}/interval={start:%Y%m%dT%H%M%S}-{end:%Y%m%dT%H%M%S}"
    before = list_folders(spark, folder)
    rows.select("order_id", "order_created_at", "merchant_timezone").write.parquet(
        f"{folder}/run={uuid.uuid4().hex}"
    )
    delete_paths(spark, [f"{folder}/{name}" for name in before])


def skew_report(spark: SparkSession, lake: str) -> DataFrame:
    """How evenly the rows of each mart lie over its partitions: one row per mart."""
    reports = []
    for name in ("orders", "order_items", "order_statuses", "order_status_times"):
        path = trusted_path(lake, name)
        if table_exists(spark, path):
            report = partition_skew(read_table(spark, path))
            reports.append(report.select(F.lit(name).alias("mart"), "*"))
    if not reports:
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in DATE_PARTITIONS))
        return partition_skew(empty).select(F.lit("").alias("mart"), "*").limit(0)
    return reduce(DataFrame.unionAll, reports)


def run_interval(
    spark: SparkSession,
    sources: Mapping[str, str | DataFrame],
    lake: str,
    start: datetime,
    end: datetime,
    reading: Mapping[str, Mapping] | None = None,
    **mart_options,
) -> DataFrame:
    """Ingest every dataset, check each against its source, and build the marts.

    Nothing is built where a check fails. reading: options of `read_text` by dataset. Returns the
    skew report.
    """

    def load(name: str) -> None:
        options = (reading or {}).get(name, {})
        ingest(spark, name, sources[name], lake, start, end, **options)
        check_ingest(spark, name, sources[name], lake, start, end, **options)

    with job_settings(spark):
        _together(spark, (partial(load, name) for name in sources))
        build_marts(spark, lake, start, end, **mart_options)
        return skew_report(spark, lake)


def backfill(
    spark: SparkSession,
    sources: Mapping[str, str],
    lake: str,
    start: datetime,
    stop: datetime,
    step: str | timedelta = "year",
    reading: Mapping[str, Mapping] | None = None,
    resume: bool = True,
    **mart_options,
) -> DataFrame:
    """Run consecutive half-open intervals in order; the same tables as one long interval.

    The source files are read twice, however many intervals there are: to land their rows by date,
    and for the check of the whole span against the files. Each interval is checked against the
    landed rows before its marts are built. Returns the skew report.

    What is finished is noted in the lake, with a fingerprint of the interval's source rows and the
    options. With `resume`, an interval whose fingerprint is still the same is left as it is: a run
    that was cut short goes on where it stopped, and a second one builds what has changed alone. An
    order's marts are built from its whole history, so an interval that has not changed needs
    nothing when another one has. An ingest by hand takes back what is noted of its span.
    """
    landed: dict[str, Staged] = {}
    reading = reading or {}

    with job_settings(spark), scratch_folder(spark, "landed") as scratch:

        def load(name: str) -> None:
            options = reading.get(name, {})
            landed[name] = _land(spark, name, sources[name], f"{scratch}/{name}", lake, **options)

        _together(spark, (partial(load, name) for name in sources))
        ledger = Ledger(spark, lake)
        settings = json.dumps(mart_options, sort_keys=True, default=str)
        for interval in intervals(start, stop, step):
            rows_of = {name: batch_of(spark, _dataset(name), rows.stored, *interval) for name, rows in landed.items()}
            entry = {"options": settings, "rows": fingerprints(rows_of)}
            if resume and ledger.holds(*interval, entry):
                continue

            def take(name: str, rows: DataFrame, interval=interval) -> None:
                ingest(spark, name, rows, lake, *interval, stored=True)
                check_ingest(spark, name, rows, lake, *interval)

            # Nothing is published of an interval whose rows are not all there.
            _together(spark, (partial(take, name, rows.taken) for name, rows in landed.items()))
            build_marts(spark, lake, *interval, **mart_options)
            ledger.note(*interval, entry)
        _together(
            spark,
            (
                partial(check_ingest, spark, name, path, lake, start, stop, **reading.get(name, {}))
                for name, path in sources.items()
            ),
        )
        return skew_report(spark, lake)
