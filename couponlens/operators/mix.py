"""Discount mix, what-if, inflow of first-time users, and transition to the second booking."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from couponlens.functions.dates import local_date, micros_between
from couponlens.functions.numbers import in_unit, percent, quotient
from couponlens.functions.rules import USE_TIME_BOUNDS, USE_TIME_LABELS, hour_bucket, label_position
from couponlens.operators.behavior import booking_totals, key_of
from couponlens.operators.kpi import share_of_total


def use_time(df: DataFrame, bounds=USE_TIME_BOUNDS, labels=USE_TIME_LABELS) -> Column:
    """Time group of the actual use."""
    return key_of(df, "time_group", hour_bucket(F.col("duration_us"), bounds, labels))


def timegroup_discount_matrix(
    bookings: DataFrame, rate: str = "discount_rate", bounds=USE_TIME_BOUNDS, labels=USE_TIME_LABELS,
    unit: float = 1e6,
) -> DataFrame:
    """Time group by discount rate: count, revenue, profit, margin, per booking."""
    totals = booking_totals(bookings, use_time(bookings, bounds, labels), key_of(bookings, "rate", F.col(rate)))
    return totals.select(
        "time_group", "rate", "cnt", in_unit("rev_sum", unit, 1).alias("rev"),
        in_unit("profit_sum", unit, 1).alias("profit"), percent("profit_sum", "rev_sum").alias("gpm"),
        quotient("rev_sum", "cnt", 0).alias("rpu"),
    )


def actual_use_distribution(
    bookings: DataFrame, policy: str, wanted: int, bounds=USE_TIME_BOUNDS, labels=USE_TIME_LABELS
) -> DataFrame:
    """How long the bookings of one policy were really used: count, share, per booking, margin per time group."""
    mine = bookings.filter(F.col(policy) == wanted)
    totals = booking_totals(mine, use_time(mine, bounds, labels))
    return share_of_total(totals, "cnt").select(
        "time_group", label_position(F.col("time_group"), labels).alias("pos"), "cnt", "share",
        quotient("rev_sum", "cnt", 0).alias("rpu"), percent("profit_sum", "rev_sum").alias("gpm"),
    )


def discount_migration(
    bookings: DataFrame, rates: Sequence[int], start: str = "start_at", rate: str = "discount_rate",
    bounds=USE_TIME_BOUNDS, labels=USE_TIME_LABELS,
) -> DataFrame:
    """Time group and month by discount rate: count and margin per rate, null where the rate was not in use."""
    totals = booking_totals(
        bookings, use_time(bookings, bounds, labels), key_of(bookings, "month", F.date_format(start, "yyyy-MM")),
        key_of(bookings, "rate", F.col(rate)),
    )
    cells = totals.select("time_group", "month", "rate", "cnt", percent("profit_sum", "rev_sum").alias("gpm"))

    def at(r: int, column: str) -> Column:
        return F.max(F.when(F.col("rate") == r, F.col(column))).alias(f"{column}_{r}")

    return cells.groupBy("time_group", "month").agg(*[at(r, c) for r in rates for c in ("cnt", "gpm")])


def scenario_weighted_gpm(matrix: DataFrame, segment: str, rate: int) -> DataFrame:
    """Weighted margin now, and if one time group had the margin it shows under another discount rate.

    Revenue stays as it is. Null if the time group has no revenue at that rate.
    """
    mine = F.col("time_group") == segment
    wanted = mine & (F.col("rate") == rate)

    def total(column: str, where: Column | None = None) -> Column:
        value = F.col(column).cast("decimal(28,6)")
        return F.sum(value if where is None else F.when(where, value)).cast("double")

    sums = matrix.agg(
        total("rev").alias("r"), total("profit").alias("p"), total("rev", mine).alias("rs"),
        total("profit", mine).alias("ps"), total("rev", wanted).alias("rt"), total("profit", wanted).alias("pt"),
    )
    moved = F.col("p") - F.col("ps") + F.col("rs") * F.try_divide(F.col("pt"), F.col("rt"))
    return sums.select(
        F.lit(segment).alias("segment"), F.lit(rate).alias("rate"), percent("ps", "rs").alias("segment_gpm"),
        percent("pt", "rt").alias("replacement_gpm"), percent("p", "r").alias("base_gpm"),
        percent(moved, "r").alias("scenario_gpm"),
    )


def time_and_id(ts: Column, id: Column) -> Column:
    """One number that orders like (time, id), a missing id first: 18 digits of microseconds since the year 1, then 20 digits
    of the id. Aggregates over it need no sort, unlike those over a struct."""
    micros = micros_between(F.lit("0001-01-01").cast("timestamp_ntz"), ts).cast("decimal(18,0)")
    place = F.coalesce(id.cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
    return (micros * F.lit(Decimal(10**20)) + place).cast("decimal(38,0)")


def inflow_compare(
    reservations: DataFrame, user: str, created: str, amount: str, periods: dict[str, tuple[date, date]], tz: str,
) -> DataFrame:
    """First-time users per period: number, mean per day, revenue of their first booking, change against the period
    before it. A period without any is a row with 0 users.

    The first booking of a user is the least by ``time_and_id``, a flat number, so it is found by hashing on both sides of
    the shuffle. Bookings without a time are nobody's first.
    """
    first = reservations.groupBy(user).agg(
        F.min(created).alias("at"), F.min_by(amount, time_and_id(F.col(created), F.col("id"))).alias("amount")
    ).select(local_date(F.col("at"), tz).alias("day"), "amount")
    label = F.coalesce(*[F.when(F.col("day").between(F.lit(a), F.lit(b)), F.lit(p)) for p, (a, b) in periods.items()])
    days = F.coalesce(*[F.when(F.col("period") == p, F.lit((b - a).days + 1)) for p, (a, b) in periods.items()])
    seen = first.select(label.alias("period"), F.lit(1).alias("users"), "amount").filter(F.col("period").isNotNull())
    every = reservations.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(p) for p in periods])).alias("period"), F.lit(0).alias("users"))
    totals = (
        seen.unionByName(every, allowMissingColumns=True)
        .groupBy("period").agg(F.sum("users").alias("users"), F.sum("amount").alias("amount"))
        .withColumn("days", days)
        .withColumn("pos", label_position(F.col("period"), list(periods)))
    )
    shown = totals.select("period", "pos", "users", "days", quotient("users", "days", 1).alias("per_day"),
                          quotient("amount", "users", 0).alias("rev_per_booking"))
    w = Window.orderBy("pos")  # one row per period
    return shown.withColumns({
        "users_pct": percent(F.col("users") - F.lag("users").over(w), F.lag("users").over(w)),
        "per_day_pct": percent(F.col("per_day") - F.lag("per_day").over(w), F.lag("per_day").over(w)),
        "rev_pct": percent(F.col("rev_per_booking") - F.lag("rev_per_booking").over(w), F.lag("rev_per_booking").over(w)),
    })


def repeat_transition(bookings: DataFrame, user: str, ts: str, id: str, division: str) -> DataFrame:
    """Distribution of the division of the second booking, given that of the first; a missing division is a value too.

    The rank filter is a group limit of two, which Spark also applies before the shuffle: however many bookings one
    user has, each task sends at most two of them.
    """
    order = Window.partitionBy(user).orderBy(ts, id)
    first_two = bookings.select(user, ts, id, division).withColumn("_n", F.row_number().over(order)).filter("_n <= 2")
    pairs = first_two.groupBy(user).agg(
        F.max("_n").alias("_n"),
        F.max(F.when(F.col("_n") == 1, F.col(division))).alias("first_division"),
        F.max(F.when(F.col("_n") == 2, F.col(division))).alias("second_division"),
    ).filter("_n = 2")
    counts = pairs.groupBy("first_division", "second_division").agg(F.count(F.lit(1)).alias("users"))
    share = percent("users", F.sum("users").over(Window.partitionBy("first_division")))
    return counts.withColumn("share", share)


