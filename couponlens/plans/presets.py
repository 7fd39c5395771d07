"""Settings under which the published pages are made. Every operator takes them as arguments."""

from __future__ import annotations

from datetime import date

from couponlens.functions.rules import ClassRule

# Class rules in order, first match wins.
CLASS_RULES = (
    ClassRule("eb", contains="미리예약"),
    ClassRule("sd", divisions=("SUPER_DEAL", "SUPER_DEAL_CLOSING_SALE")),
    ClassRule("sd", contains="당일최저가"),
    ClassRule("sd", contains="당일시작"),
)

# The coupon policies of the campaign, its first day, and the zone of its calendar.
CAMPAIGN_POLICIES = (16264, 16265, 16266, 16267, 16268, 16269, 16270, 16271)
CAMPAIGN_START = date(2026, 3, 26)
LOCAL_ZONE = "Asia/Seoul"
REPORT_YEAR = 2026

# What counts as a valid reservation.
VALID_RESERVATION = {
    "ways": ("round", "z2d_oneway", "d2d_oneway", "d2d_round", "d2d_rev"),
    "member_flags": (0, 9),
    "states": (1, 2, 3),
    "since": CAMPAIGN_START,
    "tz": LOCAL_ZONE,
}

# Charge and payment types of net revenue, and its tax divisor.
LEDGER_TYPES = {
    "charge_types": ("rent", "refund"),
    "fee_types": ("protection_fee",),
    "discount_types": (
        "coupon", "bonus", "coupon_oneway", "coupon_refund", "oil_discount", "promotion", "promotion_refund",
        "coupon_oneway_refund", "coupon_pf", "coupon_pf_refund", "oil_discount_refund",
    ),
}
VAT = 1.1

# Display units of the weekly (hundred million) and the daily (million) tables.
WEEKLY_UNIT = 1e8
DAILY_UNIT = 1e6
