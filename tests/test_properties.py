"""Sums and margins that must hold on the driver tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from couponlens.operators import behavior, kpi, periods
from couponlens.sources.tables import read_bookings, read_profit_fact


@pytest.fixture(scope="module")
def run(spark, data):
    cache = {}

    def get(key):
        if key not in cache:
            cache[key] = [r.asDict() for r in entry.queries()[key](spark, data).collect()]
        return cache[key]

    return get


@pytest.fixture(scope="module")
def n_bookings(spark, data):
    return read_bookings(spark, data).count()


@pytest.mark.parametrize("key", [
    "bucket_leadtime", "bucket_duration", "by_weekday", "by_hour", "monthly_trend", "timegroup_discount_matrix"])
def test_groups_cover_all_bookings(run, n_bookings, key):
    assert sum(r["cnt"] for r in run(key)) == n_bookings


def test_heatmap_margins(run, spark, data):
    blocks = ["06-10", "10-14", "14-18", "18-22", "22-06"]
    heat = {r["dow"]: r for r in run("heatmap_count")}
    assert {d: sum(r[b] for b in blocks) for d, r in heat.items()} == {r["dow"]: r["cnt"] for r in run("by_weekday")}
    by_hour = {r["hour"]: r["cnt"] for r in run("by_hour")}
    assert sum(r["06-10"] for r in heat.values()) == sum(by_hour[h] for h in range(6, 10))
    assert sum(r["22-06"] for r in heat.values()) == sum(by_hour[h] for h in (22, 23, 0, 1, 2, 3, 4, 5))


def test_shares_add_up(run):
    assert abs(sum(r["share"] for r in run("share_of_total")) - 100) < 0.5
    first = {}
    for r in run("repeat_transition"):
        first[r["first_division"]] = first.get(r["first_division"], 0) + r["share"]
    assert all(abs(v - 100) < 0.5 for v in first.values())


def test_classes_cover_the_fact(run, spark, data):
    assert sum(r["n_rows"] for r in run("coupon_class")) == read_profit_fact(spark, data).count()


def test_total_row_is_the_sum(run):
    rows = run("grand_total_row")
    (total,) = [r for r in rows if r["is_total"]]
    detail = [r for r in rows if not r["is_total"]]
    assert total["cnt"] == sum(r["cnt"] for r in detail)
    assert total["rev"] == pytest.approx(sum(r["rev"] for r in detail))


def test_running_total_ends_at_the_total(run):
    rows = run("running_total")
    for period in {r["period"] for r in rows}:
        mine = sorted((r for r in rows if r["period"] == period), key=lambda r: r["offset"])
        assert mine[-1]["running"] == sum(r["cnt"] for r in mine)


def test_new_and_ended_policies_are_disjoint(run):
    new, ended = {r["policy_id"] for r in run("policies_new")}, {r["policy_id"] for r in run("policies_ended")}
    current = {r["policy_id"] for r in run("wow_join")}
    assert new and ended and not new & ended and new <= current and not ended & current


def test_top_shift_agrees_with_all_policies(run):
    top = sorted(run("top_revenue_shift"), key=lambda r: r["rank"])
    everything = run("delta_direction")
    best = sorted(everything, key=lambda r: (-abs(r["d_rev"]), r["policy_id"]))[:10]
    assert [r["policy_id"] for r in top] == [r["policy_id"] for r in best]


def test_other_never_passes_the_campaign_filter(run):
    assert {r["ctype"] for r in run("weekly_class_kpi")} == {"eb", "sd"}
    assert "other" in {r["ctype"] for r in run("coupon_class")}


def test_partitioning_does_not_change_sums(spark, data):
    fact = read_profit_fact(spark, data)
    from couponlens.catalog import params as P

    a = kpi.weekly_class_kpi(fact, P.RULES, P.YEAR, P.AS_OF, 1.0)
    b = kpi.weekly_class_kpi(fact.repartition(23), P.RULES, P.YEAR, P.AS_OF, 1.0)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_paired_tables_keep_every_key(spark, data):
    weeks = kpi.division_rollup(read_profit_fact(spark, data).limit(20000))
    paired = periods.pair_long(weeks, "week", 15, 14, ["division"])
    assert paired.filter("NOT in_cur AND NOT in_prev").isEmpty()


def test_heatmap_cells_have_both_matrices(spark, data):
    cells = behavior.heatmap_cells(behavior.heatmap_long(read_bookings(spark, data)))
    assert {r["matrix"] for r in cells.select("matrix").distinct().collect()} == {"cnt", "rpu"}
    assert cells.filter(F.col("value").isNull()).isEmpty()
