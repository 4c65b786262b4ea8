"""Periods and dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_date(ts: Column, zone: str = "Europe/Amsterdam") -> Column:
    """Date in a zone of an instant in UTC."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def previous_week(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of the last whole week before a date."""
    end = F.date_sub(F.date_trunc("week", day).cast("date"), 1)
    return F.date_sub(end, 6), end


def month_of(day: Column, not_before: Column | None = None) -> tuple[Column, Column]:
    """First and last day of a date's month, the first no earlier than not_before."""
    first = F.trunc(day, "month")
    return (first if not_before is None else F.greatest(first, not_before)), F.last_day(day)


def iso_week(day: Column) -> Column:
    """2024-W03 and the like."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def day_gap(a: Column, b: Column, digits: int = 3) -> Column:
    """Days between two instants, as a fraction; 0 if one is missing."""
    gap = F.abs(F.unix_micros(a) - F.unix_micros(b)) / 86_400_000_000
    return F.coalesce(F.round(gap, digits), F.lit(0.0))


def run_key(prefix: str, ts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))


def next_release(ts: Column, day_of_month: int = 3, hour: int = 8) -> Column:
    """The first instant after ts that is day_of_month at the given hour."""
    this = F.trunc(ts, "month").cast("timestamp") + F.make_dt_interval(F.lit(day_of_month - 1), F.lit(hour))
    following = F.add_months(F.trunc(ts, "month"), 1).cast("timestamp") + F.make_dt_interval(F.lit(day_of_month - 1), F.lit(hour))
    return F.when(ts < this, this).otherwise(following)


def instant(value: Column) -> Column:
    """The instant that an ISO text names, in UTC where it names no zone; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(value), "Z$", "+00:00"))


def day_of(value: Column, zone: str = "Europe/Amsterdam") -> Column:
    """The day in a zone of a text that is a time or a day; null if it is neither. A day alone is that day."""
    bare = F.trim(value).rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(bare, F.try_to_date(F.trim(value), "yyyy-MM-dd")).otherwise(local_date(instant(value), zone))


def first_day(*values: Column) -> Column:
    """The day of the first text that has one."""
    return F.coalesce(*map(day_of, values))


def period_fault(start: Column, end: Column) -> Column:
    """What is wrong with a week's bounds; null if nothing is."""
    return F.when(start.isNull(), "no start").when(end < start, "ends before it starts").when(F.weekday(start) != 0, "does not start on Monday")
