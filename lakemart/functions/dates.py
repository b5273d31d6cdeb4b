"""Date partitions, half-open intervals, UTC parsing and per-row local time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.schemas import DATE_PARTITIONS


def utc_literal(moment: datetime) -> Column:
    """A zone-free literal, so the session time zone cannot shift a filter."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_interval(df: DataFrame, time: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= time < end; a null time drops out."""
    return df.where((F.col(time) >= utc_literal(start)) & (F.col(time) < utc_literal(end)))


def with_date_partitions(df: DataFrame, time: str | Column) -> DataFrame:
    """Add the year, month and day of `time` as the strings yyyy, MM and dd."""
    moment = F.col(time) if isinstance(time, str) else time
    text = moment.cast("date").cast("string")
    year, month, day = DATE_PARTITIONS
    return df.withColumns(
        {year: text.substr(1, 4), month: text.substr(6, 2), day: text.substr(9, 2)}
    )


def partition_date() -> Column:
    """The date spelled by the partition columns; on a scan it prunes directories."""
    return F.make_date(*(F.col(name).cast("int") for name in DATE_PARTITIONS))


def in_partition_window(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Keep every date partition that can hold a row of [start, end).

    An end that is not midnight keeps the partition of its own day; filter with
    `in_interval` as well where the exact bound matters.
    """
    last: date = (end - timedelta(microseconds=1)).date()
    day = partition_date()
    return df.where((day >= F.lit(start.date())) & (day <= F.lit(last)))


# A date with perhaps a time of day, and nothing after it that could name a zone.
WITHOUT_ZONE = r"^\d{4}-[\d-]*([T ][\d:.]*)?$"
# A date and a time of day in UTC, as most sources write it.
IN_UTC = r"^\d{4}-\d\d-\d\d[T ][\d:.]+Z$"
# Text of a time of day alone would be read as of today; it has to start with a date.
STARTS_WITH_DATE = r"^\d{4}-\d"


def parse_utc(text: Column) -> Column:
    """Text to a zone-free UTC timestamp; text that names no zone is taken as UTC.

    Text that does not parse becomes null. The session time zone plays no part: it is only
    asked for when the text has no zone of its own, and then the zone-free type is used.
    """
    trimmed = F.trim(text)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    marked = F.when(
        trimmed.endswith("z"), F.regexp_replace(trimmed, r"(\d)z$", "$1Z")
    ).otherwise(trimmed)
    instant = F.when(trimmed.rlike(STARTS_WITH_DATE), marked).try_cast("timestamp")
    # The zone-free type leaves the zone out, which changes nothing where that is UTC.
    plain = trimmed.rlike(IN_UTC) | trimmed.rlike(WITHOUT_ZONE)
    return F.when(plain, trimmed.try_cast("timestamp_ntz")).otherwise(
        F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    )


def known_zone(zone: str) -> Column:
    """The zone name, or null where it is unknown: an unknown zone would fail the job.

    A cast of text that ends in a zone looks the zone up as the conversion does, but gives
    null where there is no such zone.
    """
    name = F.trim(F.col(zone))
    probe = F.concat(F.lit("2000-01-01 00:00:00 "), name).try_cast("timestamp")
    return F.when(name.rlike("^[A-Za-z+-]") & probe.isNotNull(), name)


def to_local(time: str | Column, zone: str) -> Column:
    """UTC timestamp to the wall clock of the zone named in each row; null in, null out."""
    utc = F.col(time) if isinstance(time, str) else time
    return F.convert_timezone(F.lit("UTC"), known_zone(zone), utc.cast("timestamp_ntz"))


def intervals(
    start: datetime, stop: datetime, step: str | timedelta = "year"
) -> Iterator[tuple[datetime, datetime]]:
    """Consecutive half-open [start, end) pairs from `start` up to `stop`."""
    while start < stop:
        if isinstance(step, timedelta):
            end = start + step
        elif step == "year":
            end = datetime(start.year + 1, 1, 1)
        elif step == "month":
            end = datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
        elif step == "day":
            end = datetime(start.year, start.month, start.day) + timedelta(days=1)
        else:
            raise ValueError(f"unknown step {step!r}: use year, month or day")
        end = min(end, stop)
        yield start, end
        start = end
