"""The canonical views under fixed names, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from couponlens.sources.tables import read_bookings, read_coupon_tables, read_profit_fact

NAMES = {
    "reservation": "reservation", "coupon": "coupon_issue", "policy": "coupon_policy", "charge": "charge",
    "payment": "payment",
}


def register_views(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Temporary views ``profit_fact``, ``booking``, ``reservation``, ``coupon_issue``, ``coupon_policy``, ``charge``
    and ``payment``."""
    views = {"profit_fact": read_profit_fact(spark, folder), "booking": read_bookings(spark, folder)}
    views |= {NAMES[name]: table for name, table in read_coupon_tables(spark, folder).items()}
    for name, table in views.items():
        table.createOrReplaceTempView(name)
    return views
