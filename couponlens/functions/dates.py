"""Dates: local days of UTC instants, ISO weeks, and range predicates that reach a Parquet scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000

# Partition column of stored fact tables, as yyyy-MM.
MONTH_COLUMN = "return_month"


def stamp(day: date | datetime) -> Column:
    """Literal of the zone-less timestamp type that the fact columns use."""
    moment = day if isinstance(day, datetime) else datetime(day.year, day.month, day.day)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_range(ts: Column, first: date, last: date) -> Column:
    """``first <= date(ts) <= last``, written on the timestamp itself so that the scan can prune on it."""
    return (ts >= stamp(first)) & (ts < stamp(last + timedelta(days=1)))


def month_text(day: date) -> str:
    return f"{day:%Y-%m}"


def local_date(ts: Column, tz: str) -> Column:
    """Calendar day in ``tz`` of a zone-less UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts))


def local_midnight_utc(day: date, tz: str) -> datetime:
    """The UTC moment at which ``day`` begins in ``tz``."""
    start = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    return start.astimezone(timezone.utc).replace(tzinfo=None)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def iso_year_range(year: int) -> tuple[date, date]:
    """First and last day of an ISO year."""
    return date.fromisocalendar(year, 1, 1), date.fromisocalendar(year + 1, 1, 1) - timedelta(days=1)


def iso_week_range(year: int, week: int) -> tuple[date, date]:
    first = date.fromisocalendar(year, week, 1)
    return first, first + timedelta(days=6)


# A week of a year, as (iso_year, week).
Week = tuple[int, int]
# Weeks are numbered on from the one that begins on this Monday, so that the week before is one less in any year.
_FIRST_MONDAY = date(1970, 1, 5)


def week_number(week: Week) -> int:
    return (date.fromisocalendar(*week, 1) - _FIRST_MONDAY).days // 7


def week_before(week: Week) -> Week:
    """The ISO week before; that of week 1 is week 52 or 53 of the year before."""
    year, number, _ = (date.fromisocalendar(*week, 1) - timedelta(days=7)).isocalendar()
    return year, number


def week_numbers(year: Column, week: Column) -> Column:
    """Running number of the ISO weeks in two columns. The fourth of January is always in week 1."""
    return F.floor(F.datediff(F.make_date(year, F.lit(1), F.lit(4)), F.lit(_FIRST_MONDAY)) / 7).cast("int") + week - 1


def week_of_number(number: Column) -> tuple[Column, Column]:
    """ISO year and week of a running number."""
    thursday = F.date_add(F.lit(_FIRST_MONDAY), (number * 7 + 3).cast("int"))
    return F.year(thursday), F.weekofyear(thursday)


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds between two zone-less timestamps, whatever the session's zone."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def week_label(week: Column, start: Column) -> Column:
    """``W<week>``, a line break, then the month and day of the first seen date."""
    return F.concat(F.lit("W"), week.cast("string"), F.lit("\n"), F.date_format(start, "MM-dd"))


def short_date(day: Column) -> Column:
    return F.date_format(day, "MM/dd")
