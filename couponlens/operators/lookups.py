"""Lookups on the normalised coupon tables.

Child tables are aggregated by reservation before they are joined. The map-side combine leaves one row per task and
reservation, so one reservation with a huge number of charges does not load a single task, and the join that
follows finds its input already partitioned by the reservation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.functions.numbers import MONEY, quotient


def join_coupon_policy(coupons: DataFrame, policies: DataFrame) -> DataFrame:
    """Coupon issues with the name of their policy; issues of unknown policies drop out."""
    return coupons.join(policies.select(F.col("id").alias("policy_id"), F.col("name").alias("coupon_name")), "policy_id")


def semi_target_policy(
    reservations: DataFrame, coupons: DataFrame, policies: DataFrame, ids: Sequence[int],
    require_state: int | None = None,
) -> DataFrame:
    """Reservations that used any of the target policies, each once."""
    issued = coupons if require_state is None else coupons.filter(F.col("state") == require_state)
    hits = join_coupon_policy(issued.filter(F.col("policy_id").isin(*ids)), policies)
    keys = hits.select(F.col("reservation_id").alias("id")).distinct()
    return reservations.join(keys, "id", "left_semi")


def coupon_summary(coupons: DataFrame, policies: DataFrame, ids: Sequence[int] | None = ()) -> DataFrame:
    """One row per reservation: number of coupons, policy id, and whether a target policy is among them.
    With ``ids`` None all policies are targets, and coupons or policies that repeat count once.

    Only numbers are aggregated, which keeps the aggregation hash based; names are joined to the result.
    """
    known = coupons.join(policies.select(F.col("id").alias("policy_id")), "policy_id", "left_semi" if ids is None else "inner")
    several = F.when(F.min("policy_id") < F.max("policy_id"), 2).otherwise(1)
    return known.groupBy(F.col("reservation_id").alias("id")).agg(
        (several if ids is None else F.count(F.lit(1))).alias("n_coupons"),
        F.max("policy_id").alias("pid"),
        F.max(F.col("policy_id").isin(*ids) if ids else F.lit(ids is None)).alias("is_target"),
    )


def single_policy(pid: Column, n_coupons: Column) -> Column:
    """Policy id of a reservation: 0 without a coupon, an error with more than one."""
    many = F.raise_error(F.lit("more than one coupon on a reservation")).cast("bigint")
    return F.when(n_coupons > 1, many).otherwise(F.coalesce(pid, F.lit(0)))


def with_policy_name(df: DataFrame, policies: DataFrame, pid: str) -> DataFrame:
    """Adds ``coupon_name`` by policy id, null where there is no such policy."""
    names = policies.select(F.col("id").alias(pid), F.col("name").alias("coupon_name"))
    return df.join(names, pid, "left")


def lookup_policy_one(reservations: DataFrame, coupons: DataFrame, policies: DataFrame) -> DataFrame:
    """Adds ``pid`` (0 if none) and ``coupon_name`` (null if none); fails when a reservation has several coupons."""
    named = reservations.join(with_policy_name(coupon_summary(coupons, policies), policies, "pid"), "id", "left")
    return named.withColumn("pid", single_policy(F.col("pid"), F.col("n_coupons"))).drop("n_coupons", "is_target")


def lookup_amount_sum(
    parent: DataFrame, child: DataFrame, key: str, child_key: str, amount: str, kind: str, types: Sequence[str],
    name: str = "amount_sum",
) -> DataFrame:
    """Adds the sum of a child table's amounts of the given types, 0 if there are none."""
    sums = (
        child.filter(F.col(kind).isin(*types))
        .groupBy(F.col(child_key).alias(key))
        .agg(F.sum(amount).alias(name))
    )
    return parent.join(sums, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast(MONEY)))


def gross_ledger(
    charges: DataFrame, payments: DataFrame, charge_types: Sequence[str], fee_types: Sequence[str],
    discount_types: Sequence[str],
) -> DataFrame:
    """Gross amount per reservation: rent, refunds and fees minus discount payments.

    Both child tables go through one aggregation with signed amounts, which saves a shuffle and a join compared with
    one sum per table.
    """
    wanted = [*charge_types, *fee_types]
    plus = charges.filter(F.col("charge_type").isin(*wanted)).select("reservation_id", F.col("amount").cast(MONEY))
    minus = payments.filter(F.col("paid_type").isin(*discount_types)).select(
        "reservation_id", (-F.col("amount")).cast(MONEY).alias("amount")
    )
    return plus.unionByName(minus).groupBy(F.col("reservation_id").alias("id")).agg(F.sum("amount").alias("gross"))


def with_gross(reservations: DataFrame, ledger: DataFrame) -> DataFrame:
    return reservations.join(ledger, "id", "left").withColumn(
        "gross", F.coalesce(F.col("gross"), F.lit(0).cast(MONEY))
    )


def net_revenue(
    reservations: DataFrame, charges: DataFrame, payments: DataFrame, charge_types: Sequence[str],
    fee_types: Sequence[str], discount_types: Sequence[str], vat: float = 1.1, scale: int = 2,
) -> DataFrame:
    """Adds ``net_revenue``: gross amount of the reservation without tax, 0 if nothing was charged or paid."""
    ledger = gross_ledger(charges, payments, charge_types, fee_types, discount_types)
    return with_gross(reservations, ledger).withColumn("net_revenue", quotient("gross", vat, scale)).drop("gross")
