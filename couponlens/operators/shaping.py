"""Wide shapes of the daily coupon table. The list of ids or labels is a parameter, so no extra job looks for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.functions.numbers import zero_if_null


def pivot_daily_policy(daily: DataFrame, ids: Sequence[int]) -> DataFrame:
    """One row per date with ``c<id>`` and ``r<id>`` for each policy, 0 where absent. Other policies add no column;
    a date that only has those is still a row."""

    def at(pid: int, column: str, prefix: str) -> Column:
        return zero_if_null(F.max(F.when(F.col("pid") == pid, F.col(column)))).alias(f"{prefix}{pid}")

    return daily.groupBy("create_date").agg(
        *[at(p, "cnt", "c") for p in ids], *[at(p, "net_rev_m", "r") for p in ids]
    )


def pivot_daily_stack(daily: DataFrame, labels: Sequence[str], label: str = "coupon_name") -> DataFrame:
    """One row per date with the count of each label, 0 where absent."""
    wide = daily.groupBy("create_date").pivot(label, list(labels)).agg(F.sum("cnt"))
    return wide.na.fill(0, list(labels))


def stack_long(wide: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The stacked series back in long form: date, series, value."""
    return wide.unpivot("create_date", [F.col(f"`{x}`") for x in labels], "series", "value")
