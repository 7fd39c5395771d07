"""Published page sections, composed from the operators. Ratios on a total row come from its sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.functions.dates import Week, iso_week_range, week_before
from couponlens.functions.numbers import percent
from couponlens.operators import behavior, filters, kpi, mix
from couponlens.operators.kpi import exact_sum, grand_total_row, ratio_gpm_cm, ratio_gpm_nonzero, revenue_per_booking
from couponlens.operators.periods import (
    align_day_offset, align_weeks_outer, calendar_tag, dim_label, intensity_minmax, intensity_of_max, pair_weeks, policies_ended,
    policies_new, running_total, sort_delta_desc, sort_gpm_asc, sum_series, top_revenue_shift, wow_rows,
    wow_total_row,
)
from couponlens.session import stage


def report_weekly_detail(weekly: DataFrame, left: str = "eb", right: str = "sd") -> DataFrame:
    """Weekly table of two classes: counts, revenue, margin and contribution margin in percent."""
    wide = align_weeks_outer(weekly, left=left, right=right)
    for c in (left, right):
        wide = ratio_gpm_cm(wide, f"{c}_rev", f"{c}_pft", f"{c}_cm", prefix=f"{c}_")
    columns = [f"{c}_{m}" for c in (left, right) for m in ("cnt", "rev", "gpm", "cm_pct")]
    return wide.select("week", "label", *columns)


def report_creation_detail(daily_named: DataFrame, unit: float) -> DataFrame:
    """Creation date by coupon with net revenue per booking, and the total row with the weighted value."""
    keys = ["create_date", "pid", "coupon_name"]
    rows = grand_total_row(daily_named, keys, ["cnt", "net_rev_m"])
    return revenue_per_booking(rows, "net_rev_m", "cnt", unit)


def report_overview_cards(rollup: DataFrame, cur: Week, prev: Week | None = None, target: float = 25.0) -> DataFrame:
    """Cards of an ISO week: revenue, change on the week before, weighted margin, profit, groups at target."""
    paired = pair_weeks(rollup, cur, ["division"], prev)
    gpm = F.try_divide(F.col("cur_profit") * 100, F.col("cur_rev"))
    total = paired.agg(
        exact_sum(paired, "cur_rev").alias("total_rev"), exact_sum(paired, "prev_rev").alias("prev_total_rev"),
        exact_sum(paired, "cur_profit").alias("total_profit"),
        F.count_if(F.col("in_cur") & (F.col("cur_rev") > 0) & (gpm >= target)).alias("reached"),
        F.count_if("in_cur").alias("groups"),
    )
    return total.select(
        "total_rev", percent(F.col("total_rev") - F.col("prev_total_rev"), "prev_total_rev").alias("rev_pct"),
        percent("total_profit", "total_rev").alias("weighted_gpm"), "total_profit", "reached", "groups",
    )


def report_division_table(rollup: DataFrame, labels: DataFrame) -> DataFrame:
    """Divisions of one week with display name and margin, lowest margin first."""
    return sort_gpm_asc(ratio_gpm_nonzero(dim_label(rollup, "division", labels)))


def report_wow(rollup: DataFrame, cur: Week, labels: DataFrame, prev: Week | None = None) -> DataFrame:
    """Week-over-week table of an ISO week, largest revenue gain first, and its total row (rank 0)."""
    paired = pair_weeks(rollup, cur, ["division"], prev)
    rows = sort_delta_desc(dim_label(wow_rows(paired, ["division"]), "division", labels))
    total = wow_total_row(paired).withColumns({
        "division": F.lit(None).cast("string"), "label": F.lit("total"), "rank": F.lit(0),
    })
    return rows.unionByName(total)


def report_division_daily(daily: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Daily table of the chosen divisions with margin and intensity of revenue, and a total row for each."""
    chosen = daily.filter(F.col("division").isin(*groups))
    detail = intensity_of_max(chosen, ["division"], "rev").withColumn("is_total", F.lit(0))
    total = chosen.groupBy("division").agg(
        *[exact_sum(chosen, c).alias(c) for c in ("rev", "profit", "cnt")]
    ).withColumns({
        "return_date": F.lit(None).cast("date"), "intensity": F.lit(None).cast("double"),
        "level": F.lit(None).cast("string"), "is_total": F.lit(1),
    })
    return ratio_gpm_nonzero(detail.unionByName(total))


def report_first_week(
    bookings: DataFrame, day: str, starts: dict[str, date], days: int, measures: dict[str, Column], holidays: dict[date, str],
) -> DataFrame:
    """Two periods on the day offset: dates with calendar tags, counts, hours, running counts, count difference, and a
    total row (offset null). The total comes from the same grouping, the calendar is part of the expressions."""
    (first, second) = list(starts)
    wide = align_day_offset(bookings, day, starts, days, measures)
    sums = [f"{p}_{m}" for p in (first, second) for m in measures]
    both = grand_total_row(wide, ["offset", *[f"{p}_date" for p in (first, second)]], sums)
    for p in (first, second):
        both = both.withColumn(f"{p}_day_tag", calendar_tag(F.col(f"{p}_date"), holidays))
        both = running_total(both, ["is_total"], "offset", f"{p}_cnt", f"{p}_running")
    change = F.col(f"{second}_cnt") - F.col(f"{first}_cnt")
    return both.drop("is_total").withColumns({"d_cnt": change, "d_cnt_pct": percent(change, f"{first}_cnt")})


def behavior_page(
    bookings: DataFrame, rates: Sequence[int], unit: float = 1e6, stage: Callable[[DataFrame], DataFrame] = stage
) -> dict[str, DataFrame]:
    """All tables of the behaviour and discount pages from one pass over the bookings: the cube is stored, and each table
    groups its few rows."""
    cube = stage(behavior.booking_cube(bookings))
    cells = behavior.heatmap_long(cube)
    return {
        "leadtime": behavior.bucket_leadtime(cube, unit=unit),
        "duration": behavior.bucket_duration(cube, unit=unit),
        "weekday": behavior.by_weekday(cube, unit=unit),
        "hour": behavior.by_hour(cube, unit=unit),
        "heatmap_count": behavior.heatmap_wide(cells, "cnt", fill=0),
        "heatmap_rpu": behavior.heatmap_wide(cells, "rpu"),
        "heatmap_levels": intensity_minmax(behavior.heatmap_cells(cells), ["matrix"], "value"),
        "month": behavior.monthly_trend(cube, unit=unit),
        "discount_matrix": mix.timegroup_discount_matrix(cube, unit=unit),
        "discount_migration": mix.discount_migration(cube, rates),
    }


def division_page(
    fact: DataFrame, cur: Week, labels: DataFrame, groups: Sequence[str], target: float = 25.0, unit: float = 1e6,
    prev: Week | None = None, stage: Callable[[DataFrame], DataFrame] = stage,
) -> dict[str, DataFrame]:
    """All tables of the division page, for an ISO week and the week before, which may be in the year before. They are made
    from one stored rollup of the two weeks, for which the fact is read once."""
    prev = prev or week_before(cur)
    two = filters.filter_iso_weeks(fact, kpi.RETURN_AT, prev[0], prev[1], cur[1], last_year=cur[0])
    joint = stage(kpi.joint_rollup(two, unit))
    weeks, policies = kpi.rollup_of(joint, "weeks"), pair_weeks(kpi.rollup_of(joint, "policies"), cur, ["policy_id"], prev)
    first, last = iso_week_range(*cur)
    daily = kpi.rollup_of(joint, "days").filter(F.col("return_date").between(F.lit(first), F.lit(last)))
    this = weeks.filter((F.col("iso_year") == cur[0]) & (F.col("week") == cur[1])).drop("iso_year", "week")
    return {
        "cards": report_overview_cards(weeks, cur, prev, target),
        "divisions": report_division_table(this, labels),
        "week_over_week": report_wow(weeks, cur, labels, prev),
        "new_policies": policies_new(policies, ["policy_id"]),
        "ended_policies": policies_ended(policies, ["policy_id"]),
        "top_shift": top_revenue_shift(policies, "policy_id"),
        "daily": report_division_daily(daily, groups),
        "daily_sum": sum_series(daily, "division", groups[0], groups[1], "return_date", "rev"),
    }
