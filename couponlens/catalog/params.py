"""Parameters of the operators on the driver tables. They are synthetic analogues of the page settings."""

from __future__ import annotations

from datetime import date

from couponlens.functions.rules import ClassRule

RULES = (
    ClassRule("eb", contains="ring"),
    ClassRule("sd", divisions=("PROMO", "ECONOMY")),
    ClassRule("sd", contains="bolt"),
    ClassRule("sd", contains="rod"),
)
YEAR, AS_OF, EARLIER = 1998, date(1998, 12, 1), date(1998, 11, 24)
WEEK, WEEK_BEFORE = (1998, 15), (1998, 14)
CLASS_UNIT, DAY_UNIT = 1e4, 1e3
LABELS = {"ECONOMY": "Economy class", "PROMO": "Promotions", "SMALL": "Small", "LARGE": "Large"}

POLICY_IDS = tuple(range(4, 404))
PIVOT_IDS = (18, 20, 38, 40, 58, 60, 78, 80)  # the policies that get columns of their own
COUPON_KINDS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")  # last word of a coupon name
ZONE = "Asia/Seoul"
VALID = {
    "ways": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "member_flags": (0, 9), "states": (1, 2, 3),
    "since": date(1996, 1, 1), "tz": ZONE,
}
LEDGER = {"charge_types": ("rent", "refund"), "fee_types": ("protection_fee",), "discount_types": ("coupon",)}
SUMMARY_WINDOW = (date(1996, 1, 2), date(1996, 12, 30))
CREATION_START, CREATION_DAYS = date(1997, 3, 1), 90
INFLOW = {"95Q1": (date(1995, 1, 1), date(1995, 3, 31)), "95Q2": (date(1995, 4, 1), date(1995, 6, 30))}

OFFSET_STARTS = {"may": date(1998, 5, 1), "jun": date(1998, 6, 1)}
END_STARTS = {"jan": date(2024, 1, 8), "feb": date(2024, 2, 1)}
JAN_WEEK = (date(2024, 1, 8), date(2024, 1, 14))
FEB_WEEK = (date(2024, 2, 1), date(2024, 2, 7))
FEBRUARY = (date(2024, 2, 1), date(2024, 2, 29))
HOLIDAY_WEEK = (date(2024, 2, 8), date(2024, 2, 14))
HOLIDAYS = {
    date(2024, 1, 1): "New Year", date(2024, 2, 9): "Lunar New Year", date(2024, 2, 12): "substitute",
    date(2024, 3, 1): "March First",
}
RATES = (40, 45, 50)
