"""Row filters. Date conditions are ranges on the stored timestamp, so that Parquet can skip row groups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.functions.dates import (
    MONTH_COLUMN, day_range, iso_week_range, iso_year_range, local_midnight_utc, month_text, stamp,
)
from couponlens.functions.rules import contains_any


def filter_campaign(
    df: DataFrame, name: str, division: str, policy_id: str, patterns: Sequence[str], divisions: Sequence[str]
) -> DataFrame:
    """Rows that used a coupon of the campaign, by name pattern or by division."""
    return df.filter(
        F.col(policy_id).isNotNull() & (contains_any(F.col(name), patterns) | F.col(division).isin(*divisions))
    )


def filter_days(df: DataFrame, ts: str, first: date | None, last: date) -> DataFrame:
    """Rows with ``first <= date(ts) <= last``; on a stored fact also as a filter on its month partitions."""
    low = F.lit(True) if first is None else F.col(ts) >= stamp(first)
    kept = low & (F.col(ts) < stamp(last + timedelta(days=1)))
    if MONTH_COLUMN in df.columns:
        month = F.col(MONTH_COLUMN)
        kept &= month <= month_text(last)
        kept &= F.lit(True) if first is None else month >= month_text(first)
    return df.filter(kept)


def filter_iso_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """ISO-year equality as the date range it stands for; year edges belong to the week's year."""
    return filter_days(df, ts, *iso_year_range(year))


def filter_iso_weeks(
    df: DataFrame, ts: str, year: int, first: int, last: int, last_year: int | None = None
) -> DataFrame:
    """ISO weeks ``first`` of a year to ``last`` of the same year or of ``last_year``; a reversed range is an error."""
    start, end = iso_week_range(year, first)[0], iso_week_range(last_year or year, last)[1]
    if end < start:
        raise ValueError(f"week {last} of {last_year or year} ends before week {first} of {year} begins")
    return filter_days(df, ts, start, end)


def filter_until_yesterday(df: DataFrame, ts: str, as_of: date) -> DataFrame:
    """Complete days only: everything before ``as_of``."""
    return filter_days(df, ts, None, as_of - timedelta(days=1))


def last_n_days(df: DataFrame, ts: str, as_of: date, n: int = 7) -> DataFrame:
    """The ``n`` complete days that end the day before ``as_of``."""
    return filter_days(df, ts, as_of - timedelta(days=n), as_of - timedelta(days=1))


def filter_valid_reservation(
    df: DataFrame, ways: Sequence[str], member_flags: Sequence[int], states: Sequence[int],
    created: str, since: date, tz: str,
) -> DataFrame:
    """Real, not cancelled reservations of the given kinds, created on or after a local day."""
    return df.filter(
        F.col("way").isin(*ways)
        & F.col("member_imaginary").isin(*member_flags)
        & F.col("state").isin(*states)
        & (F.col(created) >= stamp(local_midnight_utc(since, tz)))
    )


def filter_periods(df: DataFrame, ts: str, periods: Sequence[tuple[date, date]]) -> DataFrame:
    """Rows of any of several periods of days, as ranges on the stored timestamp; on a stored fact also as a filter on its
    months, so that only the months of the periods are read."""
    kept = reduce(or_, [day_range(F.col(ts), *p) for p in periods])
    if MONTH_COLUMN in df.columns:
        month = F.col(MONTH_COLUMN)
        kept &= reduce(or_, [month.between(month_text(a), month_text(b)) for a, b in periods])
    return df.filter(kept)


def filter_policy_state(df: DataFrame, name: str, pattern: str, state: str, wanted: int) -> DataFrame:
    """Rows under a policy name pattern and coupon state."""
    return df.filter(F.col(name).contains(pattern) & (F.col(state) == wanted))


def filter_return_window(
    df: DataFrame, name: str, pattern: str, state: str, wanted_state: int, end: str, window: tuple[date, date]
) -> DataFrame:
    """Bookings under a policy name pattern and coupon state that return inside a window of days."""
    return filter_policy_state(df, name, pattern, state, wanted_state).filter(day_range(F.col(end), *window))


def drop_empty_series(long_df: DataFrame, series: str, value: str) -> DataFrame:
    """Drops the series that have no positive value on any day.

    For a table with one row per day and series; the window holds one series, whose length the calendar bounds.
    """
    top = F.max(value).over(Window.partitionBy(series))
    return long_df.withColumn("_top", top).filter(F.col("_top") > 0).drop("_top")
