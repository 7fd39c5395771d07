"""Derived values of the published pages, recomputed from their published inputs."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from couponlens.functions.cells import parse_number, parse_range, policy_name_attributes
from couponlens.functions.numbers import percent, quotient
from couponlens.functions.rules import (
    DURATION_LABELS, LEAD_LABELS, TIME_BLOCKS, change_status, classify, delta_direction, gpm_band_abs, gpm_band_target,
    signed_text, target_verdict, volume_tier,
)
from couponlens.operators import behavior, kpi, mix, periods
from couponlens.plans import presets, reports
from couponlens.sources.sectioned_text import split_sectioned_text

# Weekly arrays of the two classes (count, revenue, contribution margin, profit).
EB = {
    "cnt": [1281, 598, 763, 888, 840, 928, 4477, 2671, 1583, 264, 281, 485, 755, 221],
    "rev": [2.40, 0.97, 1.27, 1.43, 1.37, 1.44, 5.76, 5.58, 2.23, 0.52, 0.49, 0.86, 1.38, 0.41],
    "cm": [1.59, 0.64, 0.85, 0.94, 0.91, 0.93, 3.59, 4.03, 1.46, 0.39, 0.33, 0.60, 0.96, 0.28],
    "pft": [0.73, 0.27, 0.35, 0.38, 0.39, 0.41, 1.54, 2.04, 0.61, 0.19, 0.16, 0.30, 0.48, 0.15],
}
SD = {
    "cnt": [2908, 2754, 3109, 4589, 3033, 3027, 2575, 1991, 2932, 1795, 2203, 2408, 2196, 596],
    "rev": [1.15, 1.06, 1.21, 1.68, 1.15, 1.17, 0.95, 0.81, 1.21, 0.73, 0.90, 0.99, 0.88, 0.22],
    "cm": [0.59, 0.54, 0.62, 0.84, 0.60, 0.62, 0.48, 0.45, 0.66, 0.39, 0.45, 0.51, 0.45, 0.10],
    "pft": [-0.32, -0.28, -0.44, -0.63, -0.37, -0.28, -0.22, -0.21, -0.27, -0.22, -0.26, -0.29, -0.25, 0.00],
}
# Two weeks by division (revenue, profit, count). The code of the eleventh division is left out, as it is a
# product name.
W14 = [
    ("NORMAL", 3612.9, 898.4, 41916),
    ("TARGET", 940.7, -35.4, 19816),
    ("B2B", 235.5, 66.4, 2880),
    ("MAM", 231.5, -8.8, 3147),
    ("PASSPORT", 117.2, -3.6, 2687),
    ("SUPER_DEAL", 67.7, -8.1, 1472),
    ("SUPER_DEAL_CLOSING_SALE", 38.3, -12.9, 1215),
    ("COMPANY", 33.4, 7.0, 476),
    ("MEMBERSHIP", 18.4, 3.5, 276),
    ("PARTNERSHIP", 9.9, 1.6, 97),
    ("d11", 9.5, -4.0, 190),
    ("VOUCHER", 2.3, -0.4, 81),
    ("CS", 0.3, -0.8, 23),
    ("CARZONE", 0.0, -0.1, 2),
]
W15 = [
    ("NORMAL", 3510.9, 838.7, 40663),
    ("TARGET", 755.8, -31.4, 15071),
    ("MAM", 276.0, -3.9, 3446),
    ("B2B", 228.0, 59.6, 2845),
    ("PASSPORT", 95.7, -2.3, 2154),
    ("SUPER_DEAL", 42.3, -5.8, 934),
    ("COMPANY", 28.4, 5.8, 396),
    ("SUPER_DEAL_CLOSING_SALE", 25.2, -9.6, 788),
    ("MEMBERSHIP", 18.2, 3.0, 279),
    ("PARTNERSHIP", 16.1, 1.4, 160),
    ("d11", 9.9, -4.1, 192),
    ("VOUCHER", 2.2, -0.2, 67),
    ("CS", 0.8, -1.3, 36),
    ("CARZONE", 0.1, 0.0, 2),
]
# First weeks of two months by day (count, hours).
MAY = [(81, 1821), (1150, 36408), (1625, 71935), (871, 40999), (666, 32336), (92, 4139), (73, 2609)]
JUN = [(78, 3661), (106, 4278), (132, 5332), (138, 5326), (171, 7238), (259, 10822), (840, 31480)]
# Bookings by lead time, weekday (count, revenue, margin, per booking) and duration (count, gross profit).
LEAD = [215360, 503916, 98921, 62206, 28368, 18741, 7010]
WEEKDAY = [
    ("Sun", 139329, 13.0, 73266), ("Mon", 123070, 17.3, 72063), ("Tue", 125425, 16.5, 66735), ("Wed", 132817, 15.8, 66549),
    ("Thu", 140337, 14.6, 64884), ("Fri", 123097, 13.8, 82210), ("Sat", 150447, 15.4, 95618),
]
DURATION = [(267951, -1721.2), (290732, 1098.0), (252290, 2506.7), (86511, 4500.2), (22712, 2155.5), (14326, 2050.7)]
# Count heatmap, Sunday first, five blocks from 06 to 22-06.
HEAT = [
    [21672, 44582, 29783, 27240, 16052], [23440, 33943, 24003, 27160, 14524], [26422, 33532, 23268, 28290, 13913],
    [25998, 35201, 25315, 31319, 14984], [27612, 36571, 26380, 32623, 17151], [25436, 36362, 25421, 21002, 14876],
    [31439, 53075, 33571, 17497, 14865],
]


@pytest.fixture(scope="module")
def weekly(spark):
    lines = [
        (w + 1, date(2026, 1, 1), c, a["cnt"][w], a["rev"][w], a["cm"][w], a["pft"][w])
        for c, a in (("eb", EB), ("sd", SD)) for w in range(14)
    ]
    return spark.createDataFrame(
        lines, "week int, week_start date, ctype string, cnt bigint, rev double, cm double, pft double")


@pytest.fixture(scope="module")
def divisions(spark):
    lines = [(2026, w, d, r, p, c) for w, week in ((14, W14), (15, W15)) for d, r, p, c in week]
    return spark.createDataFrame(lines, "iso_year int, week int, division string, rev double, profit double, cnt bigint")


def test_weekly_totals(weekly, rows):
    total = {r["ctype"]: r for r in rows(weekly.groupBy("ctype").agg(
        *[kpi.exact_sum(weekly, c).alias(c) for c in ("cnt", "rev", "cm", "pft")]))}
    assert (total["eb"]["cnt"], total["eb"]["rev"], total["eb"]["cm"], total["eb"]["pft"]) == (16035, 26.11, 17.5, 8.0)
    assert (total["sd"]["cnt"], total["sd"]["rev"], total["sd"]["cm"], total["sd"]["pft"]) == (36116, 14.11, 7.3, -4.04)
    gpm = {r["ctype"]: r["weighted_gpm"] for r in rows(kpi.weighted_gpm(weekly, ["ctype"], "rev", "pft"))}
    assert gpm == {"eb": 30.6, "sd": -28.6}


def test_weekly_detail(weekly, rows):
    table = {r["week"]: r for r in rows(reports.report_weekly_detail(weekly))}
    assert len(table) == 14
    assert (table[1]["eb_gpm"], table[1]["eb_cm_pct"], table[1]["sd_gpm"]) == (30.4, 66.3, -27.8)
    assert (table[14]["sd_gpm"], table[14]["sd_cnt"]) == (0.0, 596)


def test_revenue_per_booking_and_ratio(spark, rows):
    made = spark.createDataFrame([(94, 10.32), (27, 3.82), (1206, 166.24)], "cnt bigint, net double")
    assert [r["per"] for r in rows(kpi.revenue_per_booking(made, "net", "cnt", 1e6))] == [109787.0, 141481.0, 137844.0]
    assert rows(spark.range(1).select(quotient(F.lit(162831.0), 39068.0, 1).alias("r")))[0]["r"] == 4.2


def test_overview_cards(divisions, rows):
    card = rows(reports.report_overview_cards(divisions, (2026, 15)))[0]
    assert card == {"total_rev": 5009.6, "rev_pct": -5.8, "weighted_gpm": 17.0, "total_profit": 849.9, "reached": 1, "groups": 14}


def test_wow(divisions, rows):
    paired = periods.pair_weeks(divisions, (2026, 15), ["division"])
    total = rows(periods.wow_total_row(paired))[0]
    assert (total["prev_rev"], total["prev_profit"], total["prev_cnt"]) == (5317.6, 902.8, 74278)
    assert (total["cur_rev"], total["cur_profit"], total["cur_cnt"]) == (5009.6, 849.9, 67033)
    assert (total["d_rev"], total["d_cnt"], total["prev_gpm"], total["cur_gpm"], total["d_gpm"]) == (-308.0, -7245, 17.0, 17.0, 0.0)
    ordered = sorted(rows(periods.sort_delta_desc(periods.wow_rows(paired, ["division"]))), key=lambda r: r["rank"])
    assert [r["division"] for r in ordered[:2]] == ["MAM", "PARTNERSHIP"]
    assert ordered[-1]["division"] == "TARGET" and ordered[-1]["d_rev_pct"] == -19.7
    assert next(r for r in ordered if r["division"] == "CARZONE")["prev_gpm"] == 0.0
    assert next(r for r in ordered if r["division"] == "CARZONE")["d_rev_pct"] is None


def test_separate_tables_pair_like_one(divisions, rows):
    cur, prev = divisions.filter("week = 15"), divisions.filter("week = 14")
    apart = periods.wow_join(cur, prev, ["division"])
    together = periods.wow_rows(periods.pair_long(divisions, "week", 15, 14, ["division"]), ["division"])
    assert sorted(map(str, rows(apart))) == sorted(map(str, rows(together)))


def test_sort_gpm(divisions, rows):
    ordered = sorted(rows(periods.sort_gpm_asc(divisions.filter("week = 15"))), key=lambda r: r["rank"])
    assert [r["division"] for r in ordered[:2]] == ["CS", "d11"] and ordered[-1]["division"] == "B2B"


def test_first_week(spark, rows):
    lines = [(date(2026, m, 1 + d), c, h) for m, week in ((5, MAY), (6, JUN)) for d, (c, h) in enumerate(week)]
    days = spark.createDataFrame(lines, "day date, c bigint, h bigint")
    calendar = {date(2026, 5, 4): "substitute", date(2026, 5, 5): "children"}
    table = rows(reports.report_first_week(
        days, "day", {"may": date(2026, 5, 1), "jun": date(2026, 6, 1)}, 7,
        {"cnt": F.sum("c"), "hours": F.sum("h")}, calendar))
    by_offset = {r["offset"]: r for r in table}
    total = by_offset.pop(None)
    assert (total["may_cnt"], total["may_hours"], total["jun_cnt"], total["jun_hours"]) == (4558, 190247, 1724, 68137)
    assert (total["d_cnt"], total["d_cnt_pct"]) == (-2834, -62.2)
    assert [by_offset[i]["d_cnt"] for i in range(7)] == [-3, -1044, -1493, -733, -495, 167, 767]
    assert (by_offset[6]["may_running"], by_offset[2]["jun_running"]) == (4558, 316)
    assert [by_offset[i]["may_day_tag"] for i in range(7)] == [
        "weekday", "weekend", "weekend", "holiday", "holiday", "weekday", "weekday"]
    means = spark.range(1).select(quotient(F.lit(190247), 4558.0, 1).alias("m"), quotient(F.lit(68137), 1724.0, 1).alias("j"))
    assert rows(means)[0] == {"m": 41.7, "j": 39.5}
    assert rows(days.filter("month(day) = 5").agg(percent(
        F.sum(F.when(F.col("day").between("2026-05-02", "2026-05-05"), F.col("c"))), F.sum("c")).alias("s")))[0]["s"] == 94.6


def test_shares(spark, rows):
    lead = spark.createDataFrame(list(zip(LEAD_LABELS, LEAD)), "bucket string, cnt bigint")
    share = {r["bucket"]: r["share"] for r in rows(kpi.share_of_total(lead, "cnt"))}
    assert share["<1h"] == 23.0 and sum(LEAD[:2]) == 719276 and sum(LEAD) == 934522
    used = spark.createDataFrame([("~4h", 9379), ("4~8h", 1306), ("8~24h", 455), ("24h+", 113)], "g string, cnt bigint")
    assert [round(r["share"]) for r in rows(kpi.share_of_total(used, "cnt"))] == [83, 12, 4, 1]
    stays = spark.createDataFrame([(b, *v) for b, v in zip(DURATION_LABELS, DURATION)], "bucket string, cnt bigint, gp double")
    gain = rows(behavior.profit_contribution(stays, "bucket", DURATION_LABELS[3:], "cnt", "gp"))[0]
    assert (gain["cnt_share"], gain["gp_share"], gain["members_gp"]) == (13.2, 82.2, 8706.4)


def test_extremes(spark, rows):
    table = spark.createDataFrame(WEEKDAY, "weekday string, cnt bigint, gpm double, rpu bigint")
    ends = {(r["measure"], r["kind"]): (r["group"], r["value"]) for r in rows(
        behavior.extreme_groups(table, "weekday", ["rpu", "gpm"]))}
    assert ends[("rpu", "best")] == ("Sat", 95618.0) and ends[("rpu", "worst")] == ("Thu", 64884.0)
    assert ends[("gpm", "best")] == ("Mon", 17.3)


def test_peak_of_the_heatmap(spark, rows):
    cells = [(w[0], b[0], HEAT[d][i]) for d, w in enumerate(WEEKDAY) for i, b in enumerate(TIME_BLOCKS)]
    ends = {r["kind"]: (r["group"], r["value"]) for r in rows(behavior.extreme_groups(
        spark.createDataFrame(cells, "weekday string, block string, cnt bigint"), ["weekday", "block"], ["cnt"]))}
    assert ends == {"best": ("Sat 10-14", 53075.0), "worst": ("Tue 22-06", 13913.0)}


def test_heatmap_levels(spark, rows):
    cells = [("cnt", d + 1, b[0], float(HEAT[d][i])) for d in range(7) for i, b in enumerate(TIME_BLOCKS)]
    table = spark.createDataFrame(cells, "matrix string, dow int, block string, value double")
    level = {(r["dow"], r["block"]): (r["ratio"], r["level"]) for r in rows(periods.intensity_minmax(table, ["matrix"], "value"))}
    assert level[(7, "10-14")] == (1.0, "highest") and level[(3, "22-06")] == (0.0, "low")
    assert level[(1, "10-14")][1] == "highest" and level[(7, "06-10")][1] == "high" and level[(1, "06-10")] == (0.198, "low")
    assert [sum(r) for r in HEAT] == [c for _, c, _, _ in WEEKDAY]


def test_intensity_of_max(spark, rows):
    revenue = [431.2, 365.2, 387.5, 356.4, 431.8, 669.9, 868.9]
    table = spark.createDataFrame([("n", i, v) for i, v in enumerate(revenue)], "s string, d int, rev double")
    levels = {r["d"]: r["level"] for r in rows(periods.intensity_of_max(table, ["s"], "rev"))}
    assert [levels[i] for i in range(7)] == ["mid", "mid", "mid", "mid", "mid", "high", "high"]


def test_top_shift_is_by_absolute_change(spark, rows):
    cur = [("a", 109.7, 0.0, 6512), ("c", 100.0, 0.0, 153), ("e", 44.6, 0.0, 379), ("f", 42.6, 0.0, 2000)]
    prev = [("b", 101.8, 0.0, 5006), ("c", 154.8, 0.0, 533), ("d", 53.7, 0.0, 2710), ("a", 0.0, 0.0, 1824)]
    schema = "id string, rev double, profit double, cnt bigint"
    paired = periods.pair_periods(spark.createDataFrame(cur, schema), spark.createDataFrame(prev, schema), ["id"])
    top = sorted(rows(periods.top_revenue_shift(paired, "id", 5)), key=lambda r: r["rank"])
    assert [(r["id"], r["d_rev"], r["note"]) for r in top] == [
        ("a", 109.7, "grew"), ("b", -101.8, "ended"), ("c", -54.8, "shrank"), ("d", -53.7, "ended"), ("e", 44.6, "new")]


def test_class_rules(spark, rows):
    names = [
        ("미리예약 2일 109,000원", "NORMAL", "eb"), ("미리예약 4일", "SUPER_DEAL", "eb"), ("땡처리", "SUPER_DEAL_CLOSING_SALE", "sd"),
        ("[4월 당일최저가] 9,900원", "TARGET", "sd"), ("당일시작 특가", None, "sd"), ("8~24시간 50%", "NORMAL", "other"),
        (None, "SUPER_DEAL", "sd"), (None, None, "other"),
    ]
    table = spark.createDataFrame(names, "n string, d string, want string")
    got = table.withColumn("got", classify(F.col("n"), F.col("d"), presets.CLASS_RULES))
    assert all(r["got"] == r["want"] for r in rows(got))


@pytest.mark.parametrize("cell, value, low, high", [
    ("10,082명", 10082.0, 10082.0, 10082.0), ("-52.3%", -52.3, -52.3, -52.3), ("560명/일", 560.0, 560.0, 560.0),
    ("29.6~31.7%", 29.6, 29.6, 31.7), ("-0.9%~7.0% (정액)", -0.9, -0.9, 7.0), ("-", None, None, None),
    ("합산", None, None, None), ("7,578.8", 7578.8, 7578.8, 7578.8), ("", None, None, None), ("+167", 167.0, 167.0, 167.0),
])
def test_report_numbers(spark, rows, cell, value, low, high):
    table = spark.createDataFrame([(cell,)], "c string")
    got = rows(table.select(parse_number(F.col("c")).alias("v"), parse_range(F.col("c")).alias("r")))[0]
    assert (got["v"], got["r"]["low"], got["r"]["high"]) == (value, low, high)


@pytest.mark.parametrize("name, want", [
    ("미리예약 2일 109,000원", {"days": 2, "nights": None, "price": 109000, "discount_pct": None, "day_type": None}),
    ("[첫사용] 2일 49,900원 (주말)", {"days": 2, "nights": None, "price": 49900, "discount_pct": None, "day_type": "weekend"}),
    ("[4월 특별할인] 평일 2박 3일 - 58%", {"days": 3, "nights": 2, "price": None, "discount_pct": 58, "day_type": "weekday"}),
    ("5일 249K", {"days": 5, "nights": None, "price": 249000, "discount_pct": None, "day_type": None}),
])
def test_policy_names(spark, rows, name, want):
    table = spark.createDataFrame([(name,)], "n string")
    assert rows(table.select(*[c.alias(a) for a, c in policy_name_attributes(F.col("n")).items()]))[0] == want


def test_bands(spark, rows):
    g = spark.createDataFrame([(None,), (-0.1,), (0.0,), (9.9,), (10.0,), (24.9,), (25.0,), (35.0,)], "g double")
    got = rows(g.select(gpm_band_target(F.col("g")).alias("a"), gpm_band_abs(F.col("g")).alias("b"), target_verdict(F.col("g")).alias("c")))
    assert [r["a"] for r in got] == ["new", "red", "yellow", "yellow", "yellow", "yellow", "green", "green"]
    assert [r["b"] for r in got] == ["red", "red", "red", "red", "yellow", "yellow", "green", "green"]
    assert [r["c"] for r in got] == [None, *["excessive"] * 5, "adequate", "excellent"]


def test_verdict_of_published_margins(spark, rows):
    g = spark.createDataFrame([(12.9,), (28.0,), (35.0,)], "g double")
    assert [r["v"] for r in rows(g.select(target_verdict(F.col("g")).alias("v")))] == ["excessive", "adequate", "excellent"]


def test_directions_and_tiers(spark, rows):
    d = spark.createDataFrame([(1.5,), (-1.5,), (0.0,), (None,), (float("inf"),), (float("nan"),)], "d double")
    got = rows(d.select(delta_direction(F.col("d")).alias("x"), signed_text(F.col("d"), 1, "%").alias("t")))
    assert [r["x"] for r in got] == ["up", "down", "flat", "-", "-", "-"]
    assert [r["t"] for r in got] == ["+1.5%", "-1.5%", "0.0%", "-", "-", "-"]
    c = spark.createDataFrame([(100, 0, 5), (99, 5, 0), (30, 5, 9), (29, 9, 5), (0, 5, 5)], "n int, p int, c int")
    got = rows(c.select(volume_tier(F.col("n")).alias("t"), change_status(F.col("p"), F.col("c")).alias("s")))
    assert [r["t"] for r in got] == ["high", "mid", "mid", "low", "low"]
    assert [r["s"] for r in got] == ["new", "ended", "grew", "shrank", "same"]


def test_scenario(spark, rows):
    matrix = spark.createDataFrame([
        ("4~8h", 50, 100.0, 12.9), ("4~8h", 45, 50.0, 14.45), ("24h+", 50, 100.0, 35.0)],
        "time_group string, rate int, rev double, profit double")
    got = rows(mix.scenario_weighted_gpm(matrix, "4~8h", 45))[0]
    assert got == {"segment": "4~8h", "rate": 45, "segment_gpm": 18.2, "replacement_gpm": 28.9, "base_gpm": 24.9, "scenario_gpm": 31.3}
    assert rows(mix.scenario_weighted_gpm(matrix, "24h+", 45))[0]["scenario_gpm"] is None


REPORT = """첫 리뷰 (25Q1 vs 26Q1)

1. 구조 전환 요약
항목\t25Q1\t26Q1\t변화
유입 규모\t10,082명\t4,811명\t-52.3%
일평균 유입\t560명/일\t267명/일\t-52.3%

2. 실제 이용시간 분포
실제 이용시간\t건수\t비중
~4h\t9,379\t83%
24h+\t113
→ 83%가 4시간 미만 이용

10. 한 줄 정리
시간그룹 분리는 구조적 진보.
"""


@pytest.mark.parametrize("text", [REPORT, REPORT.replace("\n", "\r\n")])
def test_sectioned_text(spark, rows, text):
    table = spark.createDataFrame([("a.tsv", text)], "f string, t string")
    got = rows(split_sectioned_text(table, "f", "t").orderBy("section_no", "kind", "row", "col"))
    cells = {(r["section_no"], r["row"], r["header"]): r["value"] for r in got if r["kind"] == "data"}
    assert cells[(1, 1, "26Q1")] == "4,811명" and cells[(1, 2, "변화")] == "-52.3%" and cells[(2, 2, "건수")] == "113"
    assert (2, 2, "비중") not in cells and len(cells) == 8 + 5
    assert [(r["section_no"], r["value"]) for r in got if r["kind"] == "note"] == [
        (2, "83%가 4시간 미만 이용"), (10, "시간그룹 분리는 구조적 진보.")]
    assert {r["section"] for r in got if r["section_no"] == 2} == {"실제 이용시간 분포"}
