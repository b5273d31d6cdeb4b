"""Status events per order: the list of events, its first instant, and one column per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.ranking import ranked
from lakemart.schemas import STATUS_EVENTS


def period_start(time: str, grain: str) -> Column:
    """The start of the unit of time that a zone-free time lies in, by its date and clock alone:
    truncating a time as such would go through the session time zone."""
    if grain in ("year", "quarter", "month", "week"):
        return F.trunc(time, grain).cast("timestamp_ntz")
    day = F.col(time).cast("date").cast("timestamp_ntz")
    if grain == "day":
        return day
    hour, minute = F.hour(time), F.minute(time) if grain == "minute" else F.lit(0)
    if grain not in ("hour", "minute"):
        raise ValueError(f"unknown grain {grain!r}: use year, quarter, month, week, day, hour or minute")
    return day + F.make_dt_interval(F.lit(0), hour, minute)


def status_timeline(
    statuses: DataFrame,
    key: str = "order_id",
    event: str = "value",
    time: str = "created_at",
    grain: str | None = None,
    segment: int | None = None,
) -> DataFrame:
    """One row per order: its events as a list sorted by time, and the first instant.

    grain: where a key's events go on for years, a unit of time ("day", "month", "year"); then
    there is one row per order and period, its start in the column `period`, for every order
    alike. What comes out never depends on how many events there are. A row holds its list, so
    choose a grain in which one order has a list of bearable length.

    segment: the most events of a list. Row n, in the column `part`, holds the events of the places
    from n * segment on, in the order of time and event, for every order (and period) alike: most
    have a part 0 alone. Those with more events are ranked over many tasks, so no task holds all
    events of an order; this reads the events several times and writes those of such orders once.
    """
    by = [key]
    if grain is not None:
        statuses = statuses.withColumn("period", period_start(time, grain))
        by.append("period")
    if segment is None:
        return _lists(statuses, by, event, time)
    if segment < 1:
        raise ValueError("a segment holds at least one event")
    hashed = [f.name for f in statuses.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    statuses = statuses.select(*by, event, time, F.xxhash64(*hashed).alias("_row"))
    busy = statuses.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > segment)
    busy = busy.select(*(F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)))
    if busy.isEmpty():
        return _lists(statuses.withColumn("part", F.lit(0).cast("long")), [*by, "part"], event, time)
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    few = statuses.join(busy, same, "left_anti").withColumn("part", F.lit(0).cast("long"))
    many = statuses.join(busy, same, "left_semi").withColumn("_by", F.struct(*by))
    many = ranked(many, "_by", [time, event], "_place")
    many = many.withColumn("part", F.floor(F.col("_place") / segment)).drop("_by", "_place")
    lists = [_lists(rows, [*by, "part"], event, time) for rows in (few, many)]
    return lists[0].unionByName(lists[1])


def _lists(statuses: DataFrame, by: Sequence[str], event: str, time: str) -> DataFrame:
    events = F.struct(F.col(time).alias("created_at"), F.col(event).alias("event"))
    grouped = statuses.groupBy(*by).agg(
        F.sort_array(F.collect_list(events)).alias("status"), F.min(time).alias("date_partition")
    )
    turned = F.transform(
        "status", lambda s: F.struct(s["event"].alias("event"), s["created_at"].alias("created_at"))
    )
    return grouped.withColumn("status", turned)


def status_pivot(
    statuses: DataFrame,
    key: str = "order_id",
    event: str = "value",
    time: str = "created_at",
    events: Sequence[str] = STATUS_EVENTS,
) -> DataFrame:
    """One row per order with the last time of each event, null where it never happened,
    and the first instant of any event as `date_partition`.

    A fixed set of maxima is a partial aggregate, so a busy order costs one row per task.
    """
    return statuses.groupBy(key).agg(
        *(F.max(F.when(F.col(event) == name, F.col(time))).alias(name.lower()) for name in events),
        F.min(time).alias("date_partition"),
    )
