"""KPI aggregations on the profit fact and on the coupon tables.

Every aggregation combines on the map side. An exact distinct count of reservations is planned by Spark in two steps whose
first shuffle spreads over (group, reservation), so a class or policy with a third of all rows is still counted by
many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from couponlens.functions.dates import day_range, iso_week, iso_year, local_date
from couponlens.functions.numbers import half_up, in_unit, percent, quotient, zero_if_null
from couponlens.functions.rules import ClassRule, classify
from couponlens.operators.filters import (
    filter_campaign, filter_iso_year, filter_until_yesterday, filter_valid_reservation, last_n_days,
)
from couponlens.operators.lookups import (
    coupon_summary, gross_ledger, join_coupon_policy, single_policy, with_gross, with_policy_name,
)

ID, RETURN_AT = "reservation_id", "return_at"
POLICY_ID, POLICY_NAME, DIVISION = "coupon_policy_id", "coupon_policy_name", "coupon_policy_division"


def return_date() -> Column:
    return F.to_date(RETURN_AT)


def class_column(rules: Sequence[ClassRule]) -> Column:
    return classify(F.col(POLICY_NAME), F.col(DIVISION), rules)


def campaign_rows(fact: DataFrame, rules: Sequence[ClassRule]) -> DataFrame:
    """Rows that any of the class rules covers."""
    patterns = [r.contains for r in rules if r.contains is not None]
    divisions = [d for r in rules for d in r.divisions]
    return filter_campaign(fact, POLICY_NAME, DIVISION, POLICY_ID, patterns, divisions)


def count_distinct_reservation(df: DataFrame, keys: Sequence[str], id: str = ID) -> DataFrame:
    """Exact number of reservations per group, next to the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(id).alias("cnt"))


def with_distinct(df: DataFrame, keys: Sequence[Column], sums: dict[str, Column], id: str = ID) -> DataFrame:
    """Aggregates per group together with ``cnt``, the exact number of distinct ids, from one read of the rows.

    Rows are combined by (group, id) on both sides of a shuffle over (group, id), which spreads a group with most of the
    rows over many tasks; a second, small shuffle puts the groups together.
    """
    return df.groupBy(*keys).agg(F.countDistinct(id).alias("cnt"), *[a.alias(name) for name, a in sums.items()])


def money_sums() -> dict[str, Column]:
    return {
        "rev_sum": F.sum("revenue"), "cm_sum": F.sum("contribution_margin"), "profit_sum": F.sum("profit"),
    }


def money_totals(df: DataFrame, keys: Sequence[Column], id: str = ID) -> DataFrame:
    """Distinct reservations and exact decimal sums per group; the base of the KPI tables."""
    return with_distinct(df, keys, money_sums(), id)


def weekly_class_kpi(
    fact: DataFrame, rules: Sequence[ClassRule], year: int, as_of: date, unit: float = 1e8
) -> DataFrame:
    """ISO week by class: first seen date, reservations, revenue, contribution margin and profit in ``unit``."""
    rows = filter_until_yesterday(filter_iso_year(campaign_rows(fact, rules), RETURN_AT, year), RETURN_AT, as_of)
    keys = [iso_week(return_date()).alias("week"), class_column(rules).alias("ctype")]
    totals = with_distinct(rows, keys, {"week_start": F.min(return_date()), **money_sums()})
    shown = {"rev": "rev_sum", "cm": "cm_sum", "pft": "profit_sum"}
    return totals.select(
        "week", "week_start", "ctype", "cnt", *[in_unit(c, unit).alias(name) for name, c in shown.items()]
    )


def new_coupon_daily(
    tables: dict[str, DataFrame], ids: Sequence[int] | None, valid: dict, ledger_types: dict, vat: float = 1.1,
    unit: float = 1e6,
) -> DataFrame:
    """Local creation date by policy: reservations and net revenue in ``unit``; without ``ids`` over all policies.

    ``valid`` holds the arguments of ``filter_valid_reservation``, ``ledger_types`` those of ``gross_ledger``. The target
    test and the policy lookup share one aggregation of the coupon table, and the reservation, coupon and ledger
    sides are all partitioned by the reservation, so each is shuffled once.

    With ``ids``, every side is first held against the reservations that used a target policy. These semi joins come
    behind the map-side combine of the child rows; where the tables are large, Spark turns them into bloom filters that
    drop the rows of all other reservations at the scans (``spark.sql.optimizer.runtime.bloomFilter.*``). Nothing is
    counted or stored beforehand.
    """
    policies, coupons, charges, payments = (tables[t] for t in ("policy", "coupon", "charge", "payment"))
    kept = filter_valid_reservation(tables["reservation"], created="created_at", **valid).select("id", "created_at")
    ledger = gross_ledger(charges, payments, **ledger_types)
    if ids is not None:
        used = coupons.filter(F.col("policy_id").isin(*ids)).select("reservation_id")
        of_campaign = used.withColumnRenamed("reservation_id", "id")
        kept, ledger = kept.join(of_campaign, "id", "left_semi"), ledger.join(of_campaign, "id", "left_semi")
        coupons = coupons.join(used, "reservation_id", "left_semi")
    targets = coupon_summary(coupons, policies, ids).filter("is_target")
    keyed = kept.join(targets, "id").select(
        "id", single_policy(F.col("pid"), F.col("n_coupons")).alias("pid"),
        local_date(F.col("created_at"), valid["tz"]).alias("create_date"),
    )
    priced = with_gross(keyed, ledger)
    return (
        priced.groupBy("create_date", "pid")
        .agg(F.countDistinct("id").alias("cnt"), F.sum("gross").alias("gross"))
        .select("create_date", "pid", "cnt", quotient("gross", vat * unit, 2).alias("net_rev_m"))
    )


def new_coupon_daily_named(
    tables: dict[str, DataFrame], ids: Sequence[int] | None, valid: dict, ledger_types: dict, vat: float = 1.1,
    unit: float = 1e6,
) -> DataFrame:
    """``new_coupon_daily`` with the policy name, which is joined to the grouped rows."""
    daily = new_coupon_daily(tables, ids, valid, ledger_types, vat, unit)
    return with_policy_name(daily, tables["policy"], "pid").select(
        "create_date", "pid", "coupon_name", "cnt", "net_rev_m"
    )


def ratio_gpm_cm(df: DataFrame, revenue: str = "rev", profit: str = "pft", cm: str = "cm", prefix: str = "") -> DataFrame:
    """Profit and contribution margin in percent of revenue; 0 when revenue is not positive."""
    positive = F.col(revenue) > 0
    return df.withColumns({
        f"{prefix}gpm": F.when(positive, percent(profit, revenue)).otherwise(0.0),
        f"{prefix}cm_pct": F.when(positive, percent(cm, revenue)).otherwise(0.0),
    })


def ratio_gpm_nonzero(df: DataFrame, revenue: str = "rev", profit: str = "profit", name: str = "gpm") -> DataFrame:
    """Profit in percent of revenue; 0 only when revenue is 0, so that negative revenue has a ratio."""
    return df.withColumn(name, zero_if_null(percent(profit, revenue)))


def revenue_per_booking(df: DataFrame, money: str, count: str, unit: float = 1.0, name: str = "per") -> DataFrame:
    """Money divided by count, rounded to whole currency; ``unit`` is what the money column is expressed in."""
    return df.withColumn(name, quotient(F.col(money).cast("double") * F.lit(float(unit)), count, 0))


def exact_sum(df: DataFrame, column: str) -> Column:
    """Sum of a column that does not depend on row order: doubles are summed as decimals."""
    if df.schema[column].dataType.typeName() == "double":
        return F.sum(F.col(column).cast("decimal(28,6)")).cast("double")
    return F.sum(column)


def grand_total_row(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Detail rows plus one total row (``is_total`` = 1, null keys). Ratios put on top of it are weighted ones."""
    return (
        df.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys])
        .agg(
            *[exact_sum(df, c).alias(c) for c in sums],
            F.when(F.grouping_id() > 0, 1).otherwise(0).alias("is_total"),
        )
    )


def weighted_gpm(df: DataFrame, keys: Sequence[str], revenue: str = "revenue", profit: str = "profit") -> DataFrame:
    """Sum of profit over sum of revenue per group; not the mean of ratios."""
    return (
        df.groupBy(*keys).agg(exact_sum(df, revenue).alias("_r"), exact_sum(df, profit).alias("_p"))
        .select(*keys, percent("_p", "_r").alias("weighted_gpm"))
    )


def target_attainment_count(
    grouped: DataFrame, revenue: str = "rev", profit: str = "profit", target: float = 25.0
) -> DataFrame:
    """How many groups with positive revenue reach the target margin, and how many groups there are."""
    gpm = F.try_divide(F.col(profit) * 100, F.col(revenue))
    return grouped.agg(
        F.count_if((F.col(revenue) > 0) & (gpm >= target)).alias("reached"), F.count(F.lit(1)).alias("groups")
    )


def _measures(df: DataFrame, keys: Sequence[str], unit: float) -> DataFrame:
    return df.select(
        *keys, in_unit("rev_sum", unit, 1).alias("rev"), in_unit("profit_sum", unit, 1).alias("profit"), "cnt"
    )


def week_columns() -> list[Column]:
    """ISO year and week of the return date."""
    return [iso_year(return_date()).alias("iso_year"), iso_week(return_date()).alias("week")]


def division_rollup(fact: DataFrame, group: str = DIVISION, unit: float = 1e6) -> DataFrame:
    """ISO year and week by group: revenue and profit in ``unit``, reservations. Equal week numbers of two years stay apart."""
    keyed = money_totals(fact, [*week_columns(), F.col(group).alias("division")])
    return _measures(keyed, ["iso_year", "week", "division"], unit)


ROLLUPS = {"weeks": ("iso_year", "week", "division"), "policies": ("iso_year", "week", "policy_id"), "days": ("return_date", "division")}


def joint_rollup(fact: DataFrame, unit: float = 1e6) -> DataFrame:
    """The three groupings of ``ROLLUPS`` in one table, told apart by ``rollup``, from one read of the fact. Distinct counts
    of one grouping do not add up to those of another, so all three are counted side by side in one aggregation."""
    keys = ("iso_year", "week", "return_date", "division", "policy_id")
    rows = fact.select(
        *week_columns(), return_date().alias("return_date"), F.col(DIVISION).alias("division"), F.col(POLICY_ID).alias("policy_id"), ID,
        "revenue", "contribution_margin", "profit")
    sets = [[F.col(k) for k in chosen] for chosen in ROLLUPS.values()]
    totals = rows.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("_set"), F.countDistinct(ID).alias("cnt"), *[a.alias(name) for name, a in money_sums().items()])
    # a grouping's id has a bit for each key that it leaves out, the first key highest
    left_out = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in chosen) for name, chosen in ROLLUPS.items()}
    name = F.coalesce(*[F.when(F.col("_set") == number, F.lit(rollup)) for rollup, number in left_out.items()])
    return _measures(totals.withColumn("rollup", name), ["rollup", *keys], unit)


def rollup_of(joint: DataFrame, name: str) -> DataFrame:
    """One of the groupings of ``joint_rollup``. Rows without a policy are not one of the policies."""
    mine = joint.filter(F.col("rollup") == name).select(*ROLLUPS[name], "rev", "profit", "cnt")
    return mine.filter(F.col("policy_id").isNotNull()) if name == "policies" else mine


def division_daily(fact: DataFrame, group: str = DIVISION, unit: float = 1e6) -> DataFrame:
    """Return date by group: revenue and profit in ``unit``, reservations."""
    keyed = money_totals(fact, [return_date().alias("return_date"), F.col(group).alias("division")])
    return _measures(keyed, ["return_date", "division"], unit)


def class_daily(
    fact: DataFrame, rules: Sequence[ClassRule], as_of: date, n: int = 7, unit: float = 1e6
) -> DataFrame:
    """Daily revenue and profit per class over the last ``n`` complete days."""
    rows = last_n_days(campaign_rows(fact, rules), RETURN_AT, as_of, n)
    keyed = money_totals(rows, [return_date().alias("return_date"), class_column(rules).alias("ctype")])
    return _measures(keyed, ["return_date", "ctype"], unit)


def policy_kpi(fact: DataFrame, group: Sequence[str] = (POLICY_ID, POLICY_NAME), unit: float = 1e6) -> DataFrame:
    """Per policy: reservations, revenue, margin in percent, revenue per reservation."""
    return money_totals(fact, [F.col(c) for c in group]).select(
        *group, "cnt", in_unit("rev_sum", unit, 1).alias("rev"),
        percent("profit_sum", "rev_sum").alias("gpm"), quotient("rev_sum", "cnt", 0).alias("rpu"),
    )


def cumulative_cards(
    fact: DataFrame, rules: Sequence[ClassRule], left: str, right: str, unit: float = 1e8
) -> DataFrame:
    """Totals of two classes side by side, and how many times more the left one earns per reservation."""
    per_class = money_totals(campaign_rows(fact, rules), [class_column(rules).alias("ctype")])

    def of(label: str, column: str) -> Column:
        return F.sum(F.when(F.col("ctype") == label, F.col(column))).alias(f"{label}_{column}")

    wide = per_class.agg(*[of(c, m) for c in (left, right) for m in ("cnt", "rev_sum", "profit_sum")])
    cards = []
    for c in (left, right):
        cards += [
            F.col(f"{c}_cnt"), in_unit(f"{c}_rev_sum", unit).alias(f"{c}_rev"),
            percent(f"{c}_profit_sum", f"{c}_rev_sum").alias(f"{c}_gpm"),
            quotient(f"{c}_rev_sum", f"{c}_cnt", 0).alias(f"{c}_rpu"),
        ]
    ratio = quotient(
        F.col(f"{left}_rev_sum").cast("double") * F.col(f"{right}_cnt"),
        F.col(f"{right}_rev_sum").cast("double") * F.col(f"{left}_cnt"), 1,
    )
    return wide.select(*cards, ratio.alias("rpu_ratio"))


def policy_period_summary(
    daily: DataFrame, keys: Sequence[str], window: tuple[date, date], unit: float = 1e6
) -> DataFrame:
    """Per policy over a window of days: total, mean per day of the window, net revenue per reservation."""
    days = (window[1] - window[0]).days + 1
    inside = daily.filter(F.col("create_date").between(F.lit(window[0]), F.lit(window[1])))
    totals = inside.groupBy(*keys).agg(F.sum("cnt").alias("total"), exact_sum(daily, "net_rev_m").alias("net"))
    return revenue_per_booking(totals, "net", "total", unit, "net_per_booking").select(
        *keys, "total", quotient("total", float(days), 1).alias("per_day"), half_up("net", 2).alias("net"),
        "net_per_booking",
    )


def creation_day_counts(daily: DataFrame, start: date, days: int = 7) -> DataFrame:
    """Reservations per day index 1..``days`` since the start."""
    index = F.datediff(F.col("create_date"), F.lit(start)) + 1
    return (
        daily.withColumn("day_index", index).filter(F.col("day_index").between(1, days))
        .groupBy("day_index").agg(F.sum("cnt").alias("cnt"))
    )


def return_date_distribution(bookings: DataFrame, end: str, window: tuple[date, date]) -> DataFrame:
    """Bookings per scheduled return date inside a window of days (a month)."""
    return (
        bookings.filter(day_range(F.col(end), *window))
        .groupBy(F.to_date(end).alias("return_date")).agg(F.count(F.lit(1)).alias("cnt"))
    )


def distinct_policies_matched(coupons: DataFrame, policies: DataFrame, pattern: str, state: int) -> DataFrame:
    """Number of policies in use, by coupons of a state, whose name matches. Policies are tested for a coupon, so coupons are
    cut down to one row per task and policy before they are shuffled."""
    in_use = coupons.filter(F.col("state") == state).select(F.col("policy_id").alias("id")).distinct()
    return policies.filter(F.col("name").contains(pattern)).join(in_use, "id", "left_semi").agg(
        F.countDistinct("id").alias("policies")
    )


def issued_counts(coupons: DataFrame, policies: DataFrame) -> DataFrame:
    """Coupons per policy, name and state. They are counted before the policies are joined, so a policy with most of the
    coupons sends one row per task; coupons of unknown policies drop out."""
    counted = coupons.groupBy("policy_id", "state").agg(F.count(F.lit(1)).alias("cnt"))
    return join_coupon_policy(counted, policies).select("policy_id", "coupon_name", "state", "cnt")


def share_of_total(grouped: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Percent of the column total per row. For category tables (buckets, weekdays, divisions): the total is a
    window over the grouped rows."""
    total = F.sum(value).over(Window.partitionBy())
    return grouped.withColumn(name, percent(value, total))
