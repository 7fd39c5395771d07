"""Number handling shared by all operators.

Money is summed as decimal, so a sum does not depend on the order in which partitions arrive. Divisions run in double
and are rounded half up on a decimal; a zero or null divisor gives null, and the caller decides what null means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
_WIDE = "decimal(38,12)"


def _col(value: Column | str | int | float) -> Column:
    return F.col(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


def half_up(value: Column | str, scale: int) -> Column:
    """Round half up on the decimal value, as double; twelve decimals shed binary noise and keep real ones."""
    return F.round(_col(value).cast(_WIDE), scale).cast("double")


def quotient(num, den, scale: int, factor: int = 1) -> Column:
    """``num * factor / den`` rounded; null when ``den`` is 0 or null."""
    top = _col(num).cast("double")
    if factor != 1:
        top = top * F.lit(float(factor))
    return half_up(F.try_divide(top, _col(den).cast("double")), scale)


def in_unit(amount, unit: float, scale: int = 2) -> Column:
    """An amount expressed in ``unit`` (1e8, 1e6, ...), rounded."""
    return quotient(amount, float(unit), scale)


def percent(part, whole, scale: int = 1) -> Column:
    return quotient(part, whole, scale, factor=100)


def difference(a, b, scale: int = 1) -> Column:
    """``a - b`` without binary noise in the last digits."""
    return half_up(_col(a) - _col(b), scale)


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0))
