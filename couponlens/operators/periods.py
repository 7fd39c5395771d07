"""Comparison of periods.

Two periods are compared through one *paired* table: a row per key with ``cur_<m>`` and ``prev_<m>`` (null where the
key is absent in that period) and the flags ``in_cur`` / ``in_prev``. It comes from one grouping of rows that hold both
periods, so there is no scan per period and no join for new, ended, moved or total rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from couponlens.functions.dates import Week, week_before, week_label, week_numbers, week_of_number
from couponlens.functions.numbers import difference, half_up, percent, zero_if_null
from couponlens.functions.rules import change_status, level_of
from couponlens.operators.filters import filter_periods
from couponlens.operators.kpi import exact_sum

MEASURES = ("rev", "profit", "cnt")


def pair_long(
    long: DataFrame, period: str, cur, prev, key: Sequence[str], measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Pairs two values of ``period`` in a table with one row per period and key."""
    return _pair(long, F.col(period) == F.lit(cur), F.col(period) == F.lit(prev), key, measures)


def pair_weeks(
    rollup: DataFrame, cur: Week, key: Sequence[str], prev: Week | None = None, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Pairs an ISO week with another one, by default with the week before, which may be in the year before. ``rollup`` has a
    row per iso_year, week and key."""

    def of(week: Week) -> Column:
        return (F.col("iso_year") == week[0]) & (F.col("week") == week[1])

    return _pair(rollup, of(cur), of(prev or week_before(cur)), key, measures)


def pair_every_week(rollup: DataFrame, key: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Pairs every ISO week with the one before, by their running numbers, over any span of years: a row per iso_year, week
    and key of either week. Each row counts once for its own week and once for the next, in one grouping without a join."""
    number = week_numbers(F.col("iso_year"), F.col("week"))
    sides = F.array(*[F.struct((number + ahead).alias("_number"), F.lit(ahead == 0).alias("_here")) for ahead in (0, 1)])
    both = rollup.select(*key, *measures, F.inline(sides))
    paired = _pair(both, F.col("_here"), ~F.col("_here"), ["_number", *key], measures)
    year, week = week_of_number(F.col("_number"))
    return paired.select(year.alias("iso_year"), week.alias("week"), *[c for c in paired.columns if c != "_number"])


def _pair(long: DataFrame, here: Column, there: Column, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return (
        long.filter(here | there)
        .groupBy(*key)
        .agg(
            *[F.sum(F.when(here, F.col(m))).alias(f"cur_{m}") for m in measures],
            *[F.sum(F.when(there, F.col(m))).alias(f"prev_{m}") for m in measures],
            F.max(here).alias("in_cur"), F.max(there).alias("in_prev"),
        )
    )


def pair_periods(cur: DataFrame, prev: DataFrame, key: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Pairs two separate tables of the same shape."""
    columns = [*key, *measures]
    tagged = cur.select(*columns, F.lit(1).alias("_side")).unionByName(prev.select(*columns, F.lit(0).alias("_side")))
    return pair_long(tagged, "_side", 1, 0, key, measures)


def zero_filled(paired: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The paired table with 0 for the measures of an absent side."""
    return paired.withColumns({f"{s}_{m}": zero_if_null(f"{s}_{m}") for s in ("cur", "prev") for m in measures})


def _deltas(missing_gpm: float | None) -> list[Column]:
    """Change columns of a paired row. The margins are compared before rounding; one without revenue counts as
    ``missing_gpm``."""
    gpm = {
        side: F.coalesce(
            F.try_divide(F.col(f"{side}_profit").cast("double") * 100, F.col(f"{side}_rev").cast("double")),
            F.lit(missing_gpm).cast("double"),
        )
        for side in ("prev", "cur")
    }
    return [
        difference("cur_rev", "prev_rev").alias("d_rev"),
        percent(F.col("cur_rev") - F.col("prev_rev"), "prev_rev").alias("d_rev_pct"),
        difference("cur_profit", "prev_profit").alias("d_profit"),
        (F.col("cur_cnt") - F.col("prev_cnt")).alias("d_cnt"),
        half_up(gpm["prev"], 1).alias("prev_gpm"), half_up(gpm["cur"], 1).alias("cur_gpm"),
        half_up(gpm["cur"] - gpm["prev"], 1).alias("d_gpm"),
    ]


_SIDES = [f"{s}_{m}" for m in MEASURES for s in ("prev", "cur")]


def wow_rows(paired: DataFrame, key: Sequence[str], include_ended: bool = False) -> DataFrame:
    """Current-period keys with both periods, deltas, margins and margin change. Keys that ended are left out unless
    asked for; they still count in ``wow_total_row``."""
    kept = paired if include_ended else paired.filter("in_cur")
    return zero_filled(kept, MEASURES).select(*key, *_SIDES, *_deltas(missing_gpm=0.0))


def wow_join(cur: DataFrame, prev: DataFrame, key: Sequence[str], include_ended: bool = False) -> DataFrame:
    """``wow_rows`` for two separate period tables."""
    return wow_rows(pair_periods(cur, prev, key), key, include_ended)


def wow_total_row(paired: DataFrame) -> DataFrame:
    """Totals of both periods over all keys of either, deltas, weighted margins and their difference."""
    filled = zero_filled(paired, MEASURES)
    total = filled.agg(*[exact_sum(filled, c).alias(c) for c in _SIDES])
    return total.select(*_SIDES, *_deltas(missing_gpm=None))


def policies_new(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that only the current period has, with their count and margin."""
    return paired.filter("in_cur AND NOT in_prev").select(
        *key, F.col("cur_cnt").alias("cnt"), percent("cur_profit", "cur_rev").alias("gpm")
    )


def policies_ended(paired: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that only the previous period has, with their count and margin then."""
    return paired.filter("in_prev AND NOT in_cur").select(
        *key, F.col("prev_cnt").alias("cnt"), percent("prev_profit", "prev_rev").alias("gpm")
    )


def top_revenue_shift(paired: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` keys with the largest absolute revenue change, ranked, with both counts and the kind of change."""
    rows = zero_filled(paired, ("rev", "cnt"))
    moved = rows.select(
        key, difference("cur_rev", "prev_rev").alias("d_rev"), "prev_cnt", "cur_cnt",
        (F.col("cur_cnt") - F.col("prev_cnt")).alias("d_cnt"),
        change_status(F.col("prev_cnt"), F.col("cur_cnt")).alias("note"),
    )
    top = moved.orderBy(F.abs("d_rev").desc(), key).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("d_rev").desc(), key)))


def period_delta(series: DataFrame, partition: Sequence[str], order: str, value: str, scale: int = 2) -> DataFrame:
    """Change against the previous row of each series: absolute and in percent, null without a base or on base 0."""
    before = F.lag(value).over(Window.partitionBy(*partition).orderBy(order))
    return series.withColumn("prev_value", before).withColumns({
        "delta": difference(value, "prev_value", scale),
        "delta_pct": percent(F.col(value) - F.col("prev_value"), "prev_value"),
    })


def align_weeks_outer(weekly: DataFrame, class_col: str = "ctype", left: str = "eb", right: str = "sd") -> DataFrame:
    """One row per week that either class has; missing side 0; the label takes the left class's date if it has one."""
    both = weekly.filter(F.col(class_col).isin(left, right))
    values = ("cnt", "rev", "cm", "pft")

    def of(label: str, column: str) -> Column:
        return F.max(F.when(F.col(class_col) == label, F.col(column)))

    wide = both.groupBy("week").agg(
        F.coalesce(of(left, "week_start"), of(right, "week_start")).alias("week_start"),
        *[zero_if_null(of(c, m)).alias(f"{c}_{m}") for c in (left, right) for m in values],
    )
    return wide.withColumn("label", week_label(F.col("week"), F.col("week_start")))


def sum_series(long: DataFrame, series: str, left: str, right: str, date_col: str, value: str) -> DataFrame:
    """Two series of a long daily table and their sum by date; a date that one of them lacks counts as 0 there."""

    def of(name: str) -> Column:
        return zero_if_null(F.sum(F.when(F.col(series) == name, F.col(value))))

    both = long.filter(F.col(series).isin(left, right))
    merged = both.groupBy(date_col).agg(of(left).alias("a"), of(right).alias("b"))
    return merged.withColumn("total", half_up(F.col("a") + F.col("b"), 1))


def sum_two_series(a: DataFrame, b: DataFrame, date_col: str, value: str) -> DataFrame:
    """``sum_series`` for two separate daily tables."""
    tagged = a.select(date_col, value, F.lit("a").alias("_series")).unionByName(
        b.select(date_col, value, F.lit("b").alias("_series"))
    )
    return sum_series(tagged, "_series", "a", "b", date_col, value)


def dim_label(df: DataFrame, code: str, labels: DataFrame, name: str = "label") -> DataFrame:
    """Display name of a code, or the code itself. ``labels`` has columns ``code`` and ``label``."""
    names = labels.select(F.col("code").alias(code), F.col("label").alias(name))
    return df.join(names, code, "left").withColumn(name, F.coalesce(F.col(name), F.col(code)))


def _small_table(df: DataFrame, rows: Sequence[tuple], names: tuple[str, str]) -> DataFrame:
    """Literal rows as a table of known size next to ``df``, so that joins with it are planned without a shuffle."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return df.sparkSession.range(1).select(F.inline(F.array(*structs)))


def label_table(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """A label dictionary as a table."""
    return _small_table(df, list(labels.items()), ("code", "label"))


def holiday_table(df: DataFrame, holidays: dict[date, str]) -> DataFrame:
    """A holiday calendar as a table."""
    return _small_table(df, list(holidays.items()), ("day", "holiday"))


def tag_calendar(df: DataFrame, day: str, holidays: DataFrame, prefix: str = "") -> DataFrame:
    """Weekend flag, holiday name, and one tag (holiday before weekend before weekday) for a date column.

    ``holidays`` has columns ``day`` and ``holiday``, one row per day.
    """
    named = holidays.select(F.col("day").alias(day), F.col("holiday").alias(f"{prefix}holiday"))
    weekend = F.dayofweek(day).isin(1, 7)
    return df.join(named, day, "left").withColumns({
        f"{prefix}is_weekend": weekend,
        f"{prefix}day_tag": F.when(F.col(f"{prefix}holiday").isNotNull(), "holiday").when(weekend, "weekend")
        .when(F.col(day).isNotNull(), "weekday"),
    })


def calendar_tag(day: Column, holidays: dict[date, str]) -> Column:
    """The tag of ``tag_calendar`` as an expression, for a calendar that is small enough to be written into the plan."""
    named = F.lit(False) if not holidays else day.isin(*holidays)
    return F.when(named, "holiday").when(F.dayofweek(day).isin(1, 7), "weekend").when(day.isNotNull(), "weekday")


def _in_window(day: Column, start: date, days: int) -> Column:
    return day.between(F.lit(start), F.lit(start + timedelta(days=days - 1)))


def align_day_offset(
    df: DataFrame, day: str, starts: dict[str, date], days: int, measures: dict[str, Column]
) -> DataFrame:
    """Periods side by side on the day offset 0..``days``-1: date and measures of each, 0 where a day has no rows.

    ``day`` is a date or a timestamp; the periods become ranges on it that reach the scan. ``measures`` maps a name to an
    aggregate over rows. The windows must not overlap.
    """
    ordered = sorted(starts.values())
    if any((b - a).days < days for a, b in zip(ordered, ordered[1:])):
        raise ValueError("the periods overlap")
    rows = filter_periods(df, day, [(s, s + timedelta(days=days - 1)) for s in ordered])
    per_day = rows.groupBy(F.to_date(day).alias("_day")).agg(*[a.alias(m) for m, a in measures.items()])
    start_of = F.coalesce(*[F.when(_in_window(F.col("_day"), s, days), F.lit(s)) for s in starts.values()])
    placed = per_day.withColumns({"_start": start_of, "offset": F.datediff("_day", start_of)})
    # Empty rows for every offset go into the same aggregation, so that no offset is missing.
    grid = df.sparkSession.range(days).select(F.col("id").cast("int").alias("offset"))
    wide = placed.unionByName(grid, allowMissingColumns=True).groupBy("offset").agg(
        *[F.max(F.when(F.col("_start") == F.lit(s), F.col(m))).alias(f"{p}_{m}")
          for p, s in starts.items() for m in measures]
    )
    return wide.select(
        "offset",
        *[c for p, s in starts.items() for c in (
            F.date_add(F.lit(s), F.col("offset")).alias(f"{p}_date"),
            *[zero_if_null(f"{p}_{m}").alias(f"{p}_{m}") for m in measures],
        )],
    )


def running_total(df: DataFrame, partition: Sequence[str], order: str, value: str, name: str = "running") -> DataFrame:
    """Cumulative sum inside each period."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def intensity_of_max(
    df: DataFrame, series: Sequence[str], value: str, cuts: Sequence[float] = (0.7, 0.4)
) -> DataFrame:
    """Value relative to the maximum of its series, and its level."""
    ratio = F.try_divide(F.col(value).cast("double"), F.max(value).over(Window.partitionBy(*series)).cast("double"))
    return df.withColumn("_ratio", ratio).withColumns({
        "intensity": half_up("_ratio", 3), "level": level_of(F.col("_ratio"), cuts, ("high", "mid", "low")),
    }).drop("_ratio")


def intensity_minmax(
    df: DataFrame, matrix: Sequence[str], value: str, cuts: Sequence[float] = (0.7, 0.4, 0.2)
) -> DataFrame:
    """Place of a value between minimum and maximum of its whole matrix, and its level. A constant matrix has no
    ratio and gets the lowest level."""
    w = Window.partitionBy(*matrix)
    v, low, high = (c.cast("double") for c in (F.col(value), F.min(value).over(w), F.max(value).over(w)))
    return df.withColumn("_ratio", F.try_divide(v - low, high - low)).withColumns({
        "ratio": half_up("_ratio", 3),
        "level": level_of(F.col("_ratio"), cuts, ("highest", "high", "mid", "low")),
    }).drop("_ratio")


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Adds a 1-based rank. For grouped category tables; the ranking window holds the grouped rows."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def sort_gpm_asc(grouped: DataFrame, key: str = "division", revenue: str = "rev", profit: str = "profit") -> DataFrame:
    """Groups by margin ascending; a group without revenue counts as 0."""
    gpm = F.coalesce(F.try_divide(F.col(profit).cast("double"), F.col(revenue).cast("double")), F.lit(0.0))
    return ranked(grouped, gpm.asc(), F.col(key))


def sort_delta_desc(wow: DataFrame, key: str = "division") -> DataFrame:
    """Groups by revenue change, largest gain first."""
    return ranked(wow, F.col("d_rev").desc(), F.col(key))
