"""Booking behaviour: lead time, duration, weekday, hour, heatmap, month.

Input is a booking table with ``start_at``, ``end_at``, ``revenue``, ``profit`` and the spans ``lead_us`` and
``duration_us`` in microseconds. Each table is one grouped pass with a map-side combine over a handful of groups.

The tables over start, lead time, duration and discount also take a ``booking_cube``: all their groups at once, from one
pass over the bookings. Counts and decimal sums add up exactly, so both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.functions.dates import MICROS_PER_HOUR, day_range
from couponlens.functions.numbers import difference, in_unit, percent, quotient, zero_if_null
from couponlens.functions.rules import (
    DURATION_BOUNDS, DURATION_LABELS, LEAD_BOUNDS, LEAD_LABELS, TIME_BLOCKS, USE_TIME_BOUNDS, USE_TIME_LABELS, hour_bucket,
    label_position, time_block, weekday_name,
)


def span_sum(column: str) -> Column:
    """Sum of microseconds; as decimal, since a bigint would overflow after some ten million bookings."""
    return F.sum(F.col(column).cast("decimal(20,0)"))


def is_cube(df: DataFrame) -> bool:
    return "lead_sum" in df.columns


def booking_totals(bookings: DataFrame, *keys: Column) -> DataFrame:
    """Count and exact sums per group, from bookings or from a cube; unused sums are pruned by the optimizer."""
    if is_cube(bookings):
        sums = [F.sum(c).alias(c) for c in ("cnt", "rev_sum", "profit_sum", "duration_sum", "lead_sum")]
    else:
        sums = [
            F.count(F.lit(1)).alias("cnt"), F.sum("revenue").alias("rev_sum"), F.sum("profit").alias("profit_sum"),
            span_sum("duration_us").alias("duration_sum"), span_sum("lead_us").alias("lead_sum"),
        ]
    return bookings.groupBy(*keys).agg(*sums)


def booking_cube(
    bookings: DataFrame, start: str = "start_at", rate: str = "discount_rate", lead=(LEAD_BOUNDS, LEAD_LABELS),
    duration=(DURATION_BOUNDS, DURATION_LABELS), use_time=(USE_TIME_BOUNDS, USE_TIME_LABELS),
) -> DataFrame:
    """Totals by lead and duration bucket, time group, weekday, hour, month and discount rate. The number of rows is
    bounded by the groups, some hundred thousand per year; store it once and make every table from it."""
    return booking_totals(
        bookings, hour_bucket(F.col("lead_us"), *lead).alias("lead_bucket"),
        hour_bucket(F.col("duration_us"), *duration).alias("duration_bucket"),
        hour_bucket(F.col("duration_us"), *use_time).alias("time_group"), F.dayofweek(start).alias("dow"),
        F.hour(start).alias("hour"), F.date_format(start, "yyyy-MM").alias("month"), F.col(rate).alias("rate"),
    )


def key_of(df: DataFrame, name: str, from_booking: Column, alias: str | None = None) -> Column:
    """A group column: the expression on bookings, the finished column on a cube."""
    return (F.col(name) if is_cube(df) else from_booking).alias(alias or name)


def mean_hours(total_us: str, count: str = "cnt") -> Column:
    return quotient(total_us, F.col(count).cast("double") * F.lit(float(MICROS_PER_HOUR)), 1)


def measures(unit: float) -> dict[str, Column]:
    """The display measures on top of ``booking_totals``."""
    return {
        "cnt": F.col("cnt"), "rev": in_unit("rev_sum", unit, 1), "gpm": percent("profit_sum", "rev_sum"),
        "rpu": quotient("rev_sum", "cnt", 0), "avg_h": mean_hours("duration_sum"),
        "avg_lead": mean_hours("lead_sum"), "gp": in_unit("profit_sum", unit, 1),
    }


def _show(totals: DataFrame, keys: Sequence, wanted: Sequence[str], unit: float) -> DataFrame:
    have = measures(unit)
    return totals.select(*keys, *[have[m].alias(m) for m in wanted])


def bucket_leadtime(
    bookings: DataFrame, bounds=LEAD_BOUNDS, labels=LEAD_LABELS, unit: float = 1e6
) -> DataFrame:
    """Lead-time buckets: count, revenue, margin, per booking, mean hours."""
    bucket = hour_bucket(F.col("lead_us"), bounds, labels)
    totals = booking_totals(bookings, key_of(bookings, "lead_bucket", bucket, "bucket"))
    return _show(totals, ["bucket", label_position(F.col("bucket"), labels).alias("pos")],
                 ["cnt", "rev", "gpm", "rpu", "avg_h"], unit)


def bucket_duration(
    bookings: DataFrame, bounds=DURATION_BOUNDS, labels=DURATION_LABELS, unit: float = 1e6
) -> DataFrame:
    """Duration buckets: count, revenue, margin, per booking, gross profit."""
    bucket = hour_bucket(F.col("duration_us"), bounds, labels)
    totals = booking_totals(bookings, key_of(bookings, "duration_bucket", bucket, "bucket"))
    return _show(totals, ["bucket", label_position(F.col("bucket"), labels).alias("pos")],
                 ["cnt", "rev", "gpm", "rpu", "gp"], unit)


def by_weekday(bookings: DataFrame, start: str = "start_at", unit: float = 1e6) -> DataFrame:
    """Weekdays of the start, Sunday first."""
    totals = booking_totals(bookings, key_of(bookings, "dow", F.dayofweek(start)))
    return _show(totals, ["dow", weekday_name(F.col("dow")).alias("weekday")],
                 ["cnt", "rev", "gpm", "rpu", "avg_h"], unit)


def by_hour(bookings: DataFrame, start: str = "start_at", unit: float = 1e6) -> DataFrame:
    """All 24 start hours; an hour without bookings has count 0, revenue 0 and no means."""
    totals = booking_totals(bookings, key_of(bookings, "hour", F.hour(start)))
    grid = bookings.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    sums = [c for c in totals.columns if c != "hour"]
    # one row of each hour, at most, goes into the same grouping as an empty row of it
    every = totals.unionByName(grid, allowMissingColumns=True).groupBy("hour").agg(*[F.max(c).alias(c) for c in sums])
    shown = _show(every.filter("hour is not null"), ["hour"], ["cnt", "rev", "rpu", "avg_h"], unit)
    return shown.withColumns({"cnt": zero_if_null("cnt"), "rev": zero_if_null("rev")})


def heatmap_long(bookings: DataFrame, start: str = "start_at", blocks=TIME_BLOCKS) -> DataFrame:
    """Weekday by time block: count and revenue per booking. The weekday is that of the start itself, also after
    midnight."""
    hour = F.col("hour") if is_cube(bookings) else F.hour(start)
    totals = booking_totals(
        bookings, key_of(bookings, "dow", F.dayofweek(start)), time_block(hour, blocks).alias("block"))
    return totals.select("dow", "block", "cnt", quotient("rev_sum", "cnt", 0).alias("rpu"))


def heatmap_wide(long: DataFrame, value: str, blocks=TIME_BLOCKS, fill: int | None = None) -> DataFrame:
    """One row per weekday with a column per time block."""
    names = [b[0] for b in blocks]
    wide = long.groupBy("dow").pivot("block", names).agg(F.max(value))
    shown = wide.select(F.col("dow"), weekday_name(F.col("dow")).alias("weekday"), *[F.col(f"`{n}`") for n in names])
    return shown if fill is None else shown.na.fill(fill, names)


def heatmap_count(bookings: DataFrame, start: str = "start_at", blocks=TIME_BLOCKS) -> DataFrame:
    return heatmap_wide(heatmap_long(bookings, start, blocks), "cnt", blocks, fill=0)


def heatmap_rpu(bookings: DataFrame, start: str = "start_at", blocks=TIME_BLOCKS) -> DataFrame:
    return heatmap_wide(heatmap_long(bookings, start, blocks), "rpu", blocks)


def heatmap_cells(long: DataFrame) -> DataFrame:
    """Both heatmaps in one long table: ``matrix``, ``dow``, ``block``, ``value``."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("matrix"), F.col(m).cast("double").alias("value")) for m in ("cnt", "rpu")
    ])
    return long.select("dow", "block", F.inline(pairs))


def monthly_trend(bookings: DataFrame, start: str = "start_at", unit: float = 1e6) -> DataFrame:
    """Start month: count, revenue, margin, per booking, mean hours, mean lead hours."""
    totals = booking_totals(bookings, key_of(bookings, "month", F.date_format(start, "yyyy-MM")))
    return _show(totals, ["month"], ["cnt", "rev", "gpm", "rpu", "avg_h", "avg_lead"], unit)


def first_week_compare(
    bookings: DataFrame, end: str, cur: tuple[date, date], prev: tuple[date, date]
) -> DataFrame:
    """Bookings, hours and mean hours returning in two windows, with differences; one row from one pass."""
    in_cur, in_prev = day_range(F.col(end), *cur), day_range(F.col(end), *prev)
    span = F.col("duration_us").cast("decimal(20,0)")
    totals = bookings.filter(in_cur | in_prev).agg(
        F.count_if(in_cur).alias("cur_cnt"), F.count_if(in_prev).alias("prev_cnt"),
        F.sum(F.when(in_cur, span)).alias("cur_us"), F.sum(F.when(in_prev, span)).alias("prev_us"),
    )
    hours = {f"{s}_hours": zero_if_null(quotient(f"{s}_us", float(MICROS_PER_HOUR), 1)) for s in ("cur", "prev")}
    return totals.withColumns(hours).select(
        "prev_cnt", "cur_cnt", (F.col("cur_cnt") - F.col("prev_cnt")).alias("d_cnt"),
        percent(F.col("cur_cnt") - F.col("prev_cnt"), "prev_cnt").alias("d_cnt_pct"),
        "prev_hours", "cur_hours", difference("cur_hours", "prev_hours").alias("d_hours"),
        percent(F.col("cur_hours") - F.col("prev_hours"), "prev_hours").alias("d_hours_pct"),
        quotient("prev_hours", "prev_cnt", 1).alias("prev_mean_h"), quotient("cur_hours", "cur_cnt", 1).alias("cur_mean_h"),
    )


def subset_share(
    bookings: DataFrame, end: str, window: tuple[date, date], days: Sequence[date]
) -> DataFrame:
    """Share of a chosen set of days among the bookings that return inside a window."""
    chosen = reduce(or_, [day_range(F.col(end), d, d) for d in days])
    return bookings.filter(day_range(F.col(end), *window)).agg(
        F.count_if(chosen).alias("in_set"), F.count_if(~chosen).alias("out_of_set"), F.count(F.lit(1)).alias("total")
    ).withColumn("share", percent("in_set", "total"))


def profit_contribution(grouped: DataFrame, label: str, members: Sequence[str], count: str, profit: str) -> DataFrame:
    """Share of bookings and of gross profit that a set of buckets holds."""
    inside = F.col(label).isin(*members)
    gain = F.col(profit).cast("decimal(28,6)")
    return grouped.agg(
        F.sum(F.when(inside, F.col(count))).alias("members_cnt"), F.sum(count).alias("total_cnt"),
        F.sum(F.when(inside, gain)).alias("members_gp"), F.sum(gain).alias("total_gp"),
    ).select(
        "members_cnt", percent("members_cnt", "total_cnt").alias("cnt_share"),
        F.col("members_gp").cast("double").alias("members_gp"), percent("members_gp", "total_gp").alias("gp_share"),
    )


def extreme_groups(grouped: DataFrame, group: str | Sequence[str], values: Sequence[str], join: str = " ") -> DataFrame:
    """Best and worst group per measure, in long form; equal values are decided by the group itself. Several group columns,
    such as weekday and time block, name the cell of a matrix; their values are joined to one name."""
    columns = [group] if isinstance(group, str) else list(group)
    name = F.concat_ws(join, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]) if len(columns) > 1 else F.col(columns[0]).cast("string")
    entry = {v: F.struct(F.col(v).cast("double").alias("value"), name.alias("group")) for v in values}
    ends = grouped.agg(
        *[F.max(F.when(F.col(v).isNotNull(), entry[v])).alias(f"max_{v}") for v in values],
        *[F.min(F.when(F.col(v).isNotNull(), entry[v])).alias(f"min_{v}") for v in values],
    )
    rows = F.array(*[
        F.struct(F.lit(v).alias("measure"), F.lit(kind).alias("kind"),
                 F.col(f"{end}_{v}.group").alias("group"), F.col(f"{end}_{v}.value").alias("value"))
        for v in values for kind, end in (("best", "max"), ("worst", "min"))
    ])
    return ends.select(F.inline(rows))
