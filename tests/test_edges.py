"""Nulls, zeros, boundaries and error cases."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from couponlens.functions.rules import ClassRule, bucket, hour_bucket, time_block
from couponlens.operators import behavior, filters, kpi, lookups, mix, periods, shaping
from couponlens.sinks.report_files import explode_series, manifest, snapshot_diff, to_records, to_series

RULES = (ClassRule("eb", contains="ring"), ClassRule("sd", divisions=("PROMO",)))
FACT = """reservation_id bigint, return_at timestamp_ntz, coupon_policy_id bigint, coupon_policy_name string,
coupon_policy_division string, revenue decimal(18,4), contribution_margin decimal(18,4), profit decimal(18,4)"""


def line(reservation, when, name="ring", division="NORMAL", revenue="100", profit="10", policy=1):
    return (reservation, when, policy, name, division, Decimal(revenue), Decimal(revenue) / 2, Decimal(profit))


def test_iso_year_edges(spark, rows):
    days = [datetime(2025, 12, 28, 23, 59, 59), datetime(2025, 12, 29), datetime(2026, 6, 1, 8), datetime(2027, 1, 3, 23, 59, 59),
            datetime(2027, 1, 4)]
    fact = spark.createDataFrame([line(i, d) for i, d in enumerate(days)], FACT)
    kept = rows(filters.filter_iso_year(fact, "return_at", 2026).select("reservation_id"))
    assert [r["reservation_id"] for r in kept] == [1, 2, 3]
    weekly = rows(kpi.weekly_class_kpi(fact, RULES, 2026, date(2028, 1, 1), 1.0))
    assert sorted((r["week"], r["week_start"]) for r in weekly) == [
        (1, date(2025, 12, 29)), (23, date(2026, 6, 1)), (53, date(2027, 1, 3))]


def test_as_of_day_is_excluded(spark):
    fact = spark.createDataFrame([line(1, datetime(2026, 4, 1, 23, 59)), line(2, datetime(2026, 4, 2))], FACT)
    assert [r.reservation_id for r in filters.filter_until_yesterday(fact, "return_at", date(2026, 4, 2)).collect()] == [1]
    assert filters.last_n_days(fact, "return_at", date(2026, 4, 2), 1).count() == 1


def test_sums_take_all_rows_and_counts_reservations(spark, rows):
    fact = spark.createDataFrame([
        line(1, datetime(2026, 4, 1), revenue="10.5"), line(1, datetime(2026, 4, 1), revenue="10.5"),
        line(2, datetime(2026, 4, 1), name="x", division=None), line(3, datetime(2026, 4, 1), policy=None)], FACT)
    got = rows(kpi.weekly_class_kpi(fact, RULES, 2026, date(2026, 5, 1), 1.0))
    assert [(r["ctype"], r["cnt"], r["rev"]) for r in got] == [("eb", 1, 21.0)]


def test_missing_side_of_a_week(spark, rows):
    weekly = spark.createDataFrame([
        (1, date(2026, 1, 2), "eb", 5, 1.0, 0.5, 0.1), (2, date(2026, 1, 6), "sd", 7, 2.0, 1.0, -0.2),
        (3, date(2026, 1, 14), "eb", 1, 1.0, 1.0, 1.0), (3, date(2026, 1, 12), "sd", 1, 1.0, 1.0, 1.0),
        (4, date(2026, 1, 19), "other", 1, 1.0, 1.0, 1.0)],
        "week int, week_start date, ctype string, cnt bigint, rev double, cm double, pft double")
    got = {r["week"]: r for r in rows(periods.align_weeks_outer(weekly))}
    assert set(got) == {1, 2, 3}
    assert (got[1]["sd_cnt"], got[1]["sd_rev"], got[2]["eb_cnt"]) == (0, 0.0, 0)
    assert [got[w]["label"] for w in (1, 2, 3)] == ["W1\n01-02", "W2\n01-06", "W3\n01-14"]


def test_ratio_guards(spark, rows):
    table = spark.createDataFrame([(0.0, 5.0), (-10.0, 5.0), (10.0, 5.0), (None, None)], "rev double, pft double")
    assert [r["gpm"] for r in rows(kpi.ratio_gpm_cm(table.withColumn("cm", F.col("pft"))))] == [0.0, 0.0, 50.0, 0.0]
    assert [r["gpm"] for r in rows(kpi.ratio_gpm_nonzero(table, "rev", "pft"))] == [0.0, -50.0, 50.0, 0.0]


CP = {
    "reservation": ([
        (1, datetime(2026, 3, 25, 15, 0), "round", 0, 1), (2, datetime(2026, 3, 25, 14, 59, 59), "round", 0, 1),
        (3, datetime(2026, 3, 27), "round", 9, 2), (4, datetime(2026, 3, 27), "round", 0, 4),
        (5, datetime(2026, 3, 27), "round", 0, 3), (6, datetime(2026, 3, 27), "walk", 0, 1)],
        "id bigint, created_at timestamp_ntz, way string, member_imaginary int, state int"),
    "coupon": ([(1, 10, 1), (2, 10, 1), (3, 11, 1), (4, 10, 1), (5, 99, 1), (6, 10, 1)],
               "reservation_id bigint, policy_id bigint, state int"),
    "policy": ([(10, "ten"), (11, "eleven"), (99, "other")], "id bigint, name string"),
    "charge": ([(1, Decimal("1100"), "rent"), (1, Decimal("-110"), "refund"), (1, Decimal("55"), "protection_fee"),
                (1, Decimal("999"), "toll"), (5, Decimal("1"), "rent")],
               "reservation_id bigint, amount decimal(18,4), charge_type string"),
    "payment": ([(1, Decimal("220"), "coupon"), (1, Decimal("500"), "card"), (3, Decimal("11"), "bonus")],
                "reservation_id bigint, amount decimal(18,4), paid_type string"),
}
VALID = {"ways": ("round",), "member_flags": (0, 9), "states": (1, 2, 3), "since": date(2026, 3, 26), "tz": "Asia/Seoul"}
LEDGER = {"charge_types": ("rent", "refund"), "fee_types": ("protection_fee",), "discount_types": ("coupon", "bonus")}


@pytest.fixture
def tables(spark):
    return {name: spark.createDataFrame(lines, schema) for name, (lines, schema) in CP.items()}


def test_creation_table_by_hand(tables, rows):
    got = rows(kpi.new_coupon_daily_named(tables, [10, 11], VALID, LEDGER, unit=1.0))
    assert sorted((str(r["create_date"]), r["pid"], r["coupon_name"], r["cnt"], r["net_rev_m"]) for r in got) == [
        ("2026-03-26", 10, "ten", 1, 750.0), ("2026-03-27", 11, "eleven", 1, -10.0)]


def test_net_revenue_is_zero_without_rows(tables, rows):
    got = {r["id"]: r["net_revenue"] for r in rows(lookups.net_revenue(
        tables["reservation"], tables["charge"], tables["payment"], **LEDGER))}
    assert got == {1: 750.0, 2: 0.0, 3: -10.0, 4: 0.0, 5: 0.91, 6: 0.0}


def test_two_coupons_on_a_reservation_fail(spark, tables):
    more = tables["coupon"].unionByName(spark.createDataFrame([(1, 99, 1)], tables["coupon"].schema))
    with pytest.raises(Exception, match="more than one coupon"):
        kpi.new_coupon_daily({**tables, "coupon": more}, [10, 11], VALID, LEDGER).collect()
    with pytest.raises(Exception, match="more than one coupon"):
        lookups.lookup_policy_one(tables["reservation"], more, tables["policy"]).collect()


def test_coupons_of_unknown_policies_drop_out(spark, tables, rows):
    more = tables["coupon"].unionByName(spark.createDataFrame([(1, 12345, 1), (3, 777, 1)], tables["coupon"].schema))
    assert kpi.new_coupon_daily({**tables, "coupon": more}, [10, 11, 777], VALID, LEDGER).count() == 2
    counts = {(r["policy_id"], r["coupon_name"], r["state"]): r["cnt"] for r in rows(kpi.issued_counts(more, tables["policy"]))}
    assert counts == {(10, "ten", 1): 4, (11, "eleven", 1): 1, (99, "other", 1): 1}
    assert rows(kpi.distinct_policies_matched(more, tables["policy"], "e", 1))[0]["policies"] == 3


def test_two_coupons_elsewhere_do_not_matter(spark, tables):
    more = tables["coupon"].unionByName(spark.createDataFrame([(4, 99, 1)], tables["coupon"].schema))
    assert kpi.new_coupon_daily({**tables, "coupon": more}, [10, 11], VALID, LEDGER).count() == 2


def test_lookups(spark, tables, rows):
    extra = tables["reservation"].unionByName(
        spark.createDataFrame([(7, datetime(2026, 3, 27), "round", 0, 1)], tables["reservation"].schema))
    found = {r["id"]: (r["pid"], r["coupon_name"]) for r in rows(
        lookups.lookup_policy_one(extra, tables["coupon"], tables["policy"]))}
    assert found[1] == (10, "ten") and found[7] == (0, None) and len(found) == 7
    hit = lookups.semi_target_policy(tables["reservation"], tables["coupon"].withColumn("state", F.col("policy_id") % 2),
                                     tables["policy"], [10, 11], require_state=1)
    assert [r["id"] for r in rows(hit)] == [3]
    kept = filters.filter_valid_reservation(tables["reservation"], created="created_at", **VALID)
    assert sorted(r["id"] for r in rows(kept)) == [1, 3, 5]


def test_pivot_ignores_other_ids_but_keeps_their_dates(spark, rows):
    daily = spark.createDataFrame([(date(2026, 3, 26), 10, 3, 1.5), (date(2026, 3, 28), 99, 1, 1.0)],
                                  "create_date date, pid bigint, cnt bigint, net_rev_m double")
    got = sorted(rows(to_records(shaping.pivot_daily_policy(daily, [10, 11]))), key=lambda r: r["date"])
    assert got == [
        {"create_date": date(2026, 3, 26), "c10": 3, "c11": 0, "r10": 1.5, "r11": 0.0, "date": "03/26"},
        {"create_date": date(2026, 3, 28), "c10": 0, "c11": 0, "r10": 0.0, "r11": 0.0, "date": "03/28"}]


def test_empty_series_are_dropped(spark, rows):
    long = spark.createDataFrame([(1, "a", 0), (2, "a", 3), (1, "b", 0), (2, "b", 0)], "d int, s string, v int")
    assert sorted((r["d"], r["s"], r["v"]) for r in rows(filters.drop_empty_series(long, "s", "v"))) == [(1, "a", 0), (2, "a", 3)]


def test_ended_groups_leave_rows_but_stay_in_totals(spark, rows):
    schema = "k string, rev double, profit double, cnt bigint"
    cur, prev = spark.createDataFrame([("a", 10.0, 1.0, 1)], schema), spark.createDataFrame([("b", 5.0, 1.0, 2)], schema)
    paired = periods.pair_periods(cur, prev, ["k"])
    assert [r["k"] for r in rows(periods.wow_rows(paired, ["k"]))] == ["a"]
    assert sorted(r["k"] for r in rows(periods.wow_rows(paired, ["k"], include_ended=True))) == ["a", "b"]
    total = rows(periods.wow_total_row(paired))[0]
    assert (total["prev_rev"], total["prev_cnt"], total["d_rev"]) == (5.0, 2, 5.0)
    assert [r["k"] for r in rows(periods.policies_new(paired, ["k"]))] == ["a"]
    assert [(r["k"], r["gpm"]) for r in rows(periods.policies_ended(paired, ["k"]))] == [("b", 20.0)]


def test_constant_matrix_and_zero_series(spark, rows):
    flat = spark.createDataFrame([("m", 5.0), ("m", 5.0)], "m string, v double")
    assert {(r["ratio"], r["level"]) for r in rows(periods.intensity_minmax(flat, ["m"], "v"))} == {(None, "low")}
    zero = spark.createDataFrame([("m", 0.0)], "m string, v double")
    assert rows(periods.intensity_of_max(zero, ["m"], "v"))[0]["level"] == "low"


def test_delta_without_base(spark, rows):
    series = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 4.0)], "s string, w int, v double")
    got = sorted(rows(periods.period_delta(series, ["s"], "w", "v")), key=lambda r: r["w"])
    assert [(r["delta"], r["delta_pct"]) for r in got] == [(None, None), (5.0, None), (-1.0, -20.0)]


def test_buckets_are_half_open(spark, rows):
    hour = 3_600_000_000
    spans = spark.createDataFrame([(0,), (hour - 1,), (hour,), (24 * hour - 1,), (24 * hour,), (None,)], "us bigint")
    got = [r["b"] for r in rows(spans.select(hour_bucket(F.col("us"), (1, 24), ("a", "b", "c")).alias("b")))]
    assert got == ["a", "a", "b", "b", "c", None]
    with pytest.raises(ValueError):
        bucket(F.col("us"), (1, 2), ("a",))


def test_time_blocks_wrap_midnight(spark, rows):
    got = [r["b"] for r in rows(spark.range(24).select(time_block(F.col("id")).alias("b")))]
    assert got == ["22-06"] * 6 + ["06-10"] * 4 + ["10-14"] * 4 + ["14-18"] * 4 + ["18-22"] * 4 + ["22-06"] * 2


def test_overlapping_periods_are_refused(spark):
    days = spark.createDataFrame([(date(2026, 5, 1),)], "d date")
    with pytest.raises(ValueError):
        periods.align_day_offset(days, "d", {"a": date(2026, 5, 1), "b": date(2026, 5, 5)}, 7, {"n": F.count(F.lit(1))})


def test_label_falls_back_to_code(spark, rows):
    codes = spark.createDataFrame([("A",), ("B",)], "c string")
    got = rows(periods.dim_label(codes, "c", periods.label_table(codes, {"A": "Alpha"})))
    assert {r["c"]: r["label"] for r in got} == {"A": "Alpha", "B": "B"}


def test_series_round_trip(spark, rows):
    table = spark.createDataFrame([("a", 2, 20.0), ("a", 1, None), ("b", 1, 5.0)], "k string, w int, v double")
    series = to_series(table, ["k"], "w", ["v"])
    assert {r["k"]: (r["w"], r["v"]) for r in rows(series)} == {"a": ([1, 2], [None, 20.0]), "b": ([1], [5.0])}
    assert sorted(rows(explode_series(series, ["k"], ["w", "v"])), key=str) == sorted([
        {"k": "a", "pos": 0, "w": 1, "v": None}, {"k": "a", "pos": 1, "w": 2, "v": 20.0}, {"k": "b", "pos": 0, "w": 1, "v": 5.0}], key=str)


def test_snapshot_diff_counts_copies(spark, rows):
    schema = "a int, b string"
    new = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], schema)
    old = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], schema)
    assert sorted((r["a"], r["side"], r["copies"]) for r in rows(snapshot_diff(new, old))) == [(1, "new", 1), (3, "old", 1)]
    assert snapshot_diff(new, new).isEmpty()


def test_manifest_of_nothing(spark, rows):
    weekly = spark.createDataFrame([], "week int, ctype string")
    daily = spark.createDataFrame([], "create_date date")
    assert rows(manifest(weekly, daily, date(2026, 4, 1))) == [{"status": "ok", "updated": "2026.04.01", "weeks": 0, "nc_days": 0}]


def test_second_booking_ties_are_decided_by_id(spark, rows):
    t = datetime(2024, 1, 1)
    bookings = spark.createDataFrame(
        [(1, t, 12, "c"), (1, t, 10, "a"), (1, t, 11, "b"), (2, t, 13, "a")], "u bigint, ts timestamp_ntz, id bigint, d string")
    assert rows(mix.repeat_transition(bookings, "u", "ts", "id", "d")) == [
        {"first_division": "a", "second_division": "b", "users": 1, "share": 100.0}]


def test_spans_beyond_bigint_sum(spark, rows):
    """The sum of this many long rentals exceeds a bigint of microseconds."""
    year = 365 * 24 * 3_600_000_000
    many = spark.range(400_000).select(
        F.lit(year).alias("duration_us"), F.lit(0).alias("lead_us"), F.lit(1).cast("decimal(18,4)").alias("revenue"),
        F.lit(0).cast("decimal(18,4)").alias("profit"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("start_at"))
    assert rows(behavior.by_weekday(many))[0]["avg_h"] == 8760.0


def test_half_up_rounding(spark, rows):
    from couponlens.functions.numbers import half_up

    table = spark.createDataFrame([(1.005,), (2.345,), (-1.005,), (0.15,)], "v double")
    assert [r["r"] for r in rows(table.select(half_up("v", 2).alias("r")))] == [1.01, 2.35, -1.01, 0.15]


def test_half_up_rounds_once(spark, rows):
    from couponlens.functions.numbers import in_unit

    table = spark.createDataFrame([(499999.97,), (500000.0,)], "v double")
    assert [r["r"] for r in rows(table.select(in_unit("v", 1e8).alias("r")))] == [0.0, 0.01]


def test_weeks_across_a_year_edge(spark):
    days = [datetime(2026, 12, 27), datetime(2026, 12, 28), datetime(2027, 1, 10, 23), datetime(2027, 1, 11)]
    fact = spark.createDataFrame([line(i, d) for i, d in enumerate(days)], FACT)
    kept = filters.filter_iso_weeks(fact, "return_at", 2026, 53, 1, 2027).collect()
    assert sorted(r.reservation_id for r in kept) == [1, 2]
    with pytest.raises(ValueError, match="before"):
        filters.filter_iso_weeks(fact, "return_at", 2026, 53, 1)


def test_second_booking_without_division_counts(spark, rows):
    bookings = spark.createDataFrame(
        [(1, 1, datetime(2026, 1, 1), "a"), (2, 1, datetime(2026, 1, 2), None), (3, 2, datetime(2026, 1, 1), "a")],
        "id int, u int, ts timestamp_ntz, d string")
    assert rows(mix.repeat_transition(bookings, "u", "ts", "id", "d")) == [
        {"first_division": "a", "second_division": None, "users": 1, "share": 100.0}]


def test_inflow_period_without_users(spark):
    reservations = spark.createDataFrame(
        [(1, 7, datetime(2026, 1, 1, 3), Decimal(10)), (2, 8, datetime(2026, 3, 1, 3), Decimal(20))],
        "id int, u int, at timestamp_ntz, amount decimal(18,4)")
    months = {m: (date(2026, k, 1), date(2026, k, 28)) for k, m in enumerate(("jan", "feb", "mar"), start=1)}
    got = mix.inflow_compare(reservations, "u", "at", "amount", months, "UTC").orderBy("pos").collect()
    assert [(r.period, r.users, r.users_pct) for r in got] == [("jan", 1, None), ("feb", 0, -100.0), ("mar", 1, None)]


def test_week_numbers_run_across_years(spark, rows):
    from couponlens.functions.dates import week_before, week_number, week_numbers, week_of_number

    days = spark.range(0, 30 * 366, 7).select(F.date_add(F.lit(date(1999, 12, 30)), F.col("id").cast("int")).alias("d"))
    keyed = days.select(F.extract(F.lit("YEAROFWEEK"), "d").alias("y"), F.weekofyear("d").alias("w"))
    got = rows(keyed.withColumn("n", week_numbers(F.col("y"), F.col("w"))).select("y", "w", "n", *[c.alias(a) for a, c in zip(("y2", "w2"), week_of_number(F.col("n")))]).orderBy("n"))
    assert [r["n"] for r in got] == list(range(got[0]["n"], got[0]["n"] + len(got)))
    assert all((r["y"], r["w"]) == (r["y2"], r["w2"]) and r["n"] == week_number((r["y"], r["w"])) for r in got)
    assert [week_before((a["y"], a["w"])) == (b["y"], b["w"]) for a, b in zip(got[1:], got)].count(False) == 0


def test_equal_weeks_of_two_years_stay_apart(spark, rows):
    days = [(2024, 12, 31), (2025, 12, 30), (2025, 12, 23), (2026, 1, 6), (2020, 12, 31), (2021, 1, 4)]
    fact = spark.createDataFrame([line(i, datetime(*d)) for i, d in enumerate(days)], FACT)
    weeks = kpi.division_rollup(fact, unit=1.0)
    assert {(r["iso_year"], r["week"]): r["cnt"] for r in rows(weeks)} == {(2025, 1): 1, (2026, 1): 1, (2025, 52): 1, (2026, 2): 1, (2020, 53): 1, (2021, 1): 1}
    (card,) = rows(periods.wow_rows(periods.pair_weeks(weeks, (2026, 1), ["division"]), ["division"]))
    assert (card["prev_cnt"], card["cur_cnt"], card["d_rev"]) == (1, 1, 0.0)
    pairs = {(r["iso_year"], r["week"]): (r["prev_cnt"], r["cur_cnt"]) for r in rows(periods.wow_rows(periods.pair_every_week(weeks, ["division"]), ["iso_year", "week", "division"]))}
    assert pairs == {(2025, 1): (0, 1), (2026, 1): (1, 1), (2025, 52): (0, 1), (2026, 2): (1, 1), (2020, 53): (0, 1), (2021, 1): (1, 1)}
