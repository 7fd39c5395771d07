"""Numbers and attributes inside human-written text cells, by column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"([+-]?\d[\d,]*(?:\.\d+)?)"


def _number_at(cell: Column, index: int) -> Column:
    found = F.regexp_extract_all(cell, F.lit(_NUMBER), F.lit(1))
    return F.regexp_replace(F.try_element_at(found, F.lit(index)), ",", "").try_cast("double")


def parse_number(cell: Column) -> Column:
    """First number of a cell such as ``10,082명``, ``-52.3%`` or ``560명/일``; ``-`` and plain words give null."""
    return _number_at(cell, 1)


def parse_range(cell: Column) -> Column:
    """``low`` and ``high`` of a cell: ``29.6~31.7%`` gives both ends, a single number twice the same."""
    low = _number_at(cell, 1)
    upper = F.regexp_extract(cell, r"~\s*" + _NUMBER, 1)
    high = F.regexp_replace(upper, ",", "").try_cast("double")
    return F.struct(low.alias("low"), F.coalesce(high, low).alias("high"))


def _captured(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", F.regexp_replace(found, ",", ""))


def policy_name_attributes(name: Column) -> dict[str, Column]:
    """What a policy's display name tells: days, nights, price in won, discount in percent, day-type tag.

    Names carry the Korean units for days, nights and won (or a price in thousands such as ``109K``), a percent sign,
    and the words for weekday or weekend.
    """
    won = _captured(name, r"(\d[\d,]*)원").try_cast("bigint")
    thousands = _captured(name, r"(\d+)K").try_cast("bigint") * 1000
    return {
        "days": _captured(name, r"(\d+)일").try_cast("int"),
        "nights": _captured(name, r"(\d+)박").try_cast("int"),
        "price": F.coalesce(won, thousands),
        "discount_pct": _captured(name, r"(\d+)%").try_cast("int"),
        "day_type": F.when(name.rlike("주중|평일"), "weekday").when(name.contains("주말"), "weekend"),
    }
