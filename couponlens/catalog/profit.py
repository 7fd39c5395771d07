"""Queries on the profit fact: classes, weekly KPIs, divisions, policies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.catalog import Catalog
from couponlens.catalog import params as P
from couponlens.catalog.sqlkit import (
    DELTAS, PF, THIS_WEEK, TWO_WEEKS, dec, exact, filled, paired, pct, q, rollup, sql, sub, weekly, wow_select, wow_total,
)
from couponlens.functions.dates import iso_week
from couponlens.functions.numbers import difference, in_unit, percent
from couponlens.functions.rules import (
    change_status, delta_direction, gpm_band_target, target_verdict,
)
from couponlens.operators import filters, kpi, periods
from couponlens.plans import reports
from couponlens.sinks.report_files import explode_series, snapshot_diff, to_series
from couponlens.sources.tables import read_profit_fact

catalog = Catalog()

def fact(spark: SparkSession, folder: str) -> DataFrame:
    return read_profit_fact(spark, folder)


def two_weeks(spark, folder) -> DataFrame:
    return filters.filter_iso_weeks(fact(spark, folder), "return_at", *P.WEEK_BEFORE, P.WEEK[1], last_year=P.WEEK[0])


def this_week(spark, folder) -> DataFrame:
    return filters.filter_iso_weeks(fact(spark, folder), "return_at", *P.WEEK, P.WEEK[1])


def class_weekly(spark, folder, as_of: date = P.AS_OF) -> DataFrame:
    return kpi.weekly_class_kpi(fact(spark, folder), P.RULES, P.YEAR, as_of, P.CLASS_UNIT)


def division_weeks(spark, folder) -> DataFrame:
    return kpi.division_rollup(two_weeks(spark, folder), unit=P.DAY_UNIT)


def policy_weeks(spark, folder) -> DataFrame:
    used = two_weeks(spark, folder).filter(F.col(kpi.POLICY_ID).isNotNull())
    return kpi.division_rollup(used, group=kpi.POLICY_ID, unit=P.DAY_UNIT).withColumnRenamed("division", "policy_id")


def paired_policies(spark, folder) -> DataFrame:
    return periods.pair_weeks(policy_weeks(spark, folder), P.WEEK, ["policy_id"])


def paired_divisions(spark, folder) -> DataFrame:
    return periods.pair_weeks(division_weeks(spark, folder), P.WEEK, ["division"])


DIVISION = "coupon_policy_division AS division"
DIV_WEEKS = rollup(f"CAST(iso_year AS INTEGER) AS iso_year, week, {DIVISION}", "weeks", TWO_WEEKS)
DIV_WEEK = rollup(DIVISION, "grouped", THIS_WEEK)
POLICY_WEEKS = rollup("week, coupon_policy_id AS policy_id", "weeks", f"coupon_policy_id IS NOT NULL AND {TWO_WEEKS}")
DIV_PAIR = [PF, DIV_WEEKS, paired("weeks", "division"), filled("paired", "division")]
POLICY_PAIR = [PF, POLICY_WEEKS, paired("weeks", "policy_id"), filled("paired", "policy_id")]


@catalog.add("src_profit_fact", sql([PF], """
SELECT coupon_policy_division, count(*) AS n_rows, count(coupon_policy_id) AS n_with_policy,
  min(return_date) AS first_date, max(return_date) AS last_date, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(cm) AS DOUBLE) AS cm, CAST(sum(profit) AS DOUBLE) AS profit
FROM pf GROUP BY coupon_policy_division"""))
def src_profit_fact(spark, folder):
    return fact(spark, folder).groupBy("coupon_policy_division").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("coupon_policy_id").alias("n_with_policy"),
        F.min(kpi.return_date()).alias("first_date"), F.max(kpi.return_date()).alias("last_date"),
        *[F.sum(c).cast("double").alias(a) for c, a in
          (("revenue", "revenue"), ("contribution_margin", "cm"), ("profit", "profit"))],
    )


@catalog.add("weekly_class_kpi", sql([PF, weekly()], "SELECT * FROM weekly"))
def weekly_class_kpi(spark, folder):
    return class_weekly(spark, folder)


@catalog.add("coupon_class", sql([PF], """
SELECT ctype, count(*) AS n_rows, count(DISTINCT reservation_id) AS cnt FROM pf GROUP BY ctype"""))
def coupon_class(spark, folder):
    return kpi.count_distinct_reservation(fact(spark, folder).withColumn("ctype", kpi.class_column(P.RULES)), ["ctype"])


@catalog.add("filter_campaign", sql([PF], """
SELECT coupon_policy_division AS division, count(*) AS n_rows, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM camp GROUP BY ALL"""))
def filter_campaign(spark, folder):
    return kpi.campaign_rows(fact(spark, folder), P.RULES).groupBy(F.col(kpi.DIVISION).alias("division")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("revenue").cast("double").alias("revenue"))


@catalog.add("filter_iso_year", sql([PF], """
SELECT week, min(return_date) AS first_date, max(return_date) AS last_date, count(*) AS n_rows
FROM pf WHERE iso_year = 1998 GROUP BY week"""))
def filter_iso_year(spark, folder):
    return filters.filter_iso_year(fact(spark, folder), "return_at", P.YEAR).groupBy(
        iso_week(kpi.return_date()).alias("week")
    ).agg(F.min(kpi.return_date()).alias("first_date"), F.max(kpi.return_date()).alias("last_date"), F.count(F.lit(1)).alias("n_rows"))


@catalog.add("filter_until_yesterday", sql([PF], """
SELECT coupon_policy_division AS division, max(return_date) AS last_date, count(*) AS n_rows
FROM pf WHERE return_date <= DATE '1998-12-01' - INTERVAL 1 DAY GROUP BY ALL"""))
def filter_until_yesterday(spark, folder):
    return filters.filter_until_yesterday(fact(spark, folder), "return_at", P.AS_OF).groupBy(
        F.col(kpi.DIVISION).alias("division")
    ).agg(F.max(kpi.return_date()).alias("last_date"), F.count(F.lit(1)).alias("n_rows"))


@catalog.add("last_n_days", sql([PF], """
SELECT return_date, count(*) AS n_rows, count(DISTINCT reservation_id) AS cnt
FROM pf WHERE return_date BETWEEN DATE '1998-11-24' AND DATE '1998-11-30' GROUP BY ALL"""))
def last_n_days(spark, folder):
    recent = filters.last_n_days(fact(spark, folder), "return_at", P.AS_OF, 7)
    return kpi.count_distinct_reservation(recent.withColumn("return_date", kpi.return_date()), ["return_date"])


@catalog.add("count_distinct_reservation", sql([PF], """
SELECT ctype, week, count(*) AS n_rows, count(DISTINCT reservation_id) AS cnt
FROM camp WHERE iso_year = 1998 GROUP BY ALL"""))
def count_distinct_reservation(spark, folder):
    rows = filters.filter_iso_year(kpi.campaign_rows(fact(spark, folder), P.RULES), "return_at", P.YEAR)
    keyed = rows.withColumns({"ctype": kpi.class_column(P.RULES), "week": iso_week(kpi.return_date())})
    return kpi.count_distinct_reservation(keyed, ["ctype", "week"])


@catalog.add("snk_series_arrays", sql([PF, weekly()], """
SELECT ctype, CAST(row_number() OVER (PARTITION BY ctype ORDER BY week) - 1 AS INTEGER) AS pos, week, cnt, rev, cm, pft
FROM weekly"""))
def snk_series_arrays(spark, folder):
    series = to_series(class_weekly(spark, folder), ["ctype"], "week", ["cnt", "rev", "cm", "pft"])
    return explode_series(series, ["ctype"], ["week", "cnt", "rev", "cm", "pft"])


@catalog.add("snapshot_changed", sql([PF, weekly(), weekly(as_of="1998-11-24", name="before")], """
SELECT *, 'new' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM weekly EXCEPT ALL SELECT * FROM before)
UNION ALL
SELECT *, 'old' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM weekly)"""))
def snapshot_changed(spark, folder):
    return snapshot_diff(class_weekly(spark, folder), class_weekly(spark, folder, P.EARLIER))


ALIGNED = """
aligned AS (
  SELECT coalesce(e.week, s.week) AS week, coalesce(e.week_start, s.week_start) AS week_start,
    coalesce(e.cnt, 0) AS eb_cnt, coalesce(e.rev, 0) AS eb_rev, coalesce(e.cm, 0) AS eb_cm, coalesce(e.pft, 0) AS eb_pft,
    coalesce(s.cnt, 0) AS sd_cnt, coalesce(s.rev, 0) AS sd_rev, coalesce(s.cm, 0) AS sd_cm, coalesce(s.pft, 0) AS sd_pft
  FROM (SELECT * FROM weekly WHERE ctype = 'eb') AS e FULL JOIN (SELECT * FROM weekly WHERE ctype = 'sd') AS s ON e.week = s.week
)"""
LABEL = "'W' || week || chr(10) || strftime(week_start, '%m-%d') AS label"


@catalog.add("align_weeks_outer", sql([PF, weekly(), ALIGNED], f"SELECT *, {LABEL} FROM aligned"))
def align_weeks_outer(spark, folder):
    return periods.align_weeks_outer(class_weekly(spark, folder))


def guarded(part: str, whole: str, guard: str) -> str:
    return f"CASE WHEN {whole} {guard} THEN {pct(part, whole)} ELSE 0 END"


@catalog.add("ratio_gpm_cm", sql([PF, weekly()], f"""
SELECT *, {guarded('pft', 'rev', '> 0')} AS gpm, {guarded('cm', 'rev', '> 0')} AS cm_pct FROM weekly"""))
def ratio_gpm_cm(spark, folder):
    return kpi.ratio_gpm_cm(class_weekly(spark, folder))


@catalog.add("ratio_gpm_nonzero", sql([PF, DIV_WEEKS], f"""
SELECT *, {guarded('profit', 'rev', '<> 0')} AS gpm FROM weeks"""))
def ratio_gpm_nonzero(spark, folder):
    return kpi.ratio_gpm_nonzero(division_weeks(spark, folder))


ALL_WEEKS = rollup(f"CAST(iso_year AS INTEGER) AS iso_year, week, {DIVISION}", "weeks")


@catalog.add("division_rollup", sql([PF, ALL_WEEKS], "SELECT * FROM weeks"))
def division_rollup(spark, folder):
    """All weeks of all years."""
    return kpi.division_rollup(fact(spark, folder), unit=P.DAY_UNIT)


@catalog.add("wow_weeks", sql([PF, ALL_WEEKS, """
dated AS (
  SELECT weeks.*, d.monday FROM weeks
  JOIN (SELECT DISTINCT iso_year, week, CAST(date_trunc('week', return_date) AS DATE) AS monday FROM pf) AS d USING (iso_year, week)
)""", f"""
paired AS (
  SELECT c.iso_year, c.week, c.division, {", ".join(f"c.{m} AS cur_{m}, p.{m} AS prev_{m}" for m in ("rev", "profit", "cnt"))},
    TRUE AS in_cur, p.division IS NOT NULL AS in_prev
  FROM dated AS c LEFT JOIN dated AS p ON p.division = c.division AND p.monday = c.monday - 7
)""", filled("paired", "iso_year, week, division")], wow_select("iso_year, week, division")))
def wow_weeks(spark, folder):
    """Every week against the week before, from one year into the next."""
    weeks = kpi.division_rollup(fact(spark, folder), unit=P.DAY_UNIT)
    return periods.wow_rows(periods.pair_every_week(weeks, ["division"]), ["iso_year", "week", "division"])


DIV_DAILY = rollup(f"return_date, {DIVISION}", "daily", THIS_WEEK)


@catalog.add("division_daily", sql([PF, DIV_DAILY], "SELECT * FROM daily"))
def division_daily(spark, folder):
    return kpi.division_daily(this_week(spark, folder), unit=P.DAY_UNIT)


@catalog.add("class_daily", sql([PF, rollup(
    "return_date, ctype", "daily", "return_date BETWEEN DATE '1998-11-24' AND DATE '1998-11-30'", "camp")],
    "SELECT * FROM daily"))
def class_daily(spark, folder):
    return kpi.class_daily(fact(spark, folder), P.RULES, P.AS_OF, 7, P.DAY_UNIT)


@catalog.add("policy_kpi", sql([PF], f"""
SELECT coupon_policy_id, coupon_policy_name, count(DISTINCT reservation_id) AS cnt, {q('sum(revenue)', '1e3', 1)} AS rev,
  {pct('sum(profit)', 'sum(revenue)')} AS gpm, {q('sum(revenue)', 'count(DISTINCT reservation_id)', 0)} AS rpu
FROM pf WHERE coupon_policy_id IS NOT NULL GROUP BY ALL"""))
def policy_kpi(spark, folder):
    used = fact(spark, folder).filter(F.col(kpi.POLICY_ID).isNotNull())
    return kpi.policy_kpi(used, unit=P.DAY_UNIT)


@catalog.add("weighted_gpm", sql([PF], f"""
SELECT week, {pct('sum(profit)', 'sum(revenue)')} AS weighted_gpm FROM pf WHERE iso_year = 1998 GROUP BY week"""))
def weighted_gpm(spark, folder):
    year = filters.filter_iso_year(fact(spark, folder), "return_at", P.YEAR)
    return kpi.weighted_gpm(year.withColumn("week", iso_week(kpi.return_date())), ["week"])


@catalog.add("target_attainment_count", sql([PF, DIV_WEEKS], """
SELECT count(*) FILTER (rev > 0 AND profit * 100 / NULLIF(rev, 0) >= 10) AS reached, count(*) AS groups
FROM weeks WHERE week = 15"""))
def target_attainment_count(spark, folder):
    grouped = division_weeks(spark, folder).filter(F.col("week") == P.WEEK[1])
    return kpi.target_attainment_count(grouped, target=10.0)


CARD = ", ".join(
    f"max(cnt) FILTER (ctype = '{c}') AS {c}_cnt, max(r) FILTER (ctype = '{c}') AS {c}_r, max(p) FILTER (ctype = '{c}') AS {c}_p"
    for c in ("eb", "sd"))


@catalog.add("cumulative_cards", sql([PF, """
per AS (SELECT ctype, count(DISTINCT reservation_id) AS cnt, sum(revenue) AS r, sum(profit) AS p FROM camp
  WHERE iso_year = 1998 AND return_date < DATE '1998-12-01' GROUP BY ctype)""", f"cards AS (SELECT {CARD} FROM per)"], f"""
SELECT eb_cnt, {q('eb_r', '1e4', 2)} AS eb_rev, {pct('eb_p', 'eb_r')} AS eb_gpm, {q('eb_r', 'eb_cnt', 0)} AS eb_rpu,
  sd_cnt, {q('sd_r', '1e4', 2)} AS sd_rev, {pct('sd_p', 'sd_r')} AS sd_gpm, {q('sd_r', 'sd_cnt', 0)} AS sd_rpu,
  {q('CAST(eb_r AS DOUBLE) * sd_cnt', 'CAST(sd_r AS DOUBLE) * eb_cnt', 1)} AS rpu_ratio
FROM cards"""))
def cumulative_cards(spark, folder):
    year = filters.filter_iso_year(fact(spark, folder), "return_at", P.YEAR)
    return kpi.cumulative_cards(
        filters.filter_until_yesterday(year, "return_at", P.AS_OF), P.RULES, "eb", "sd", P.CLASS_UNIT)


GRAND = f"""SELECT return_date, division, {exact('rev')} AS rev, {exact('profit')} AS profit, CAST(sum(cnt) AS BIGINT) AS cnt,
    CASE WHEN GROUPING(return_date) = 1 THEN 1 ELSE 0 END AS is_total
  FROM daily GROUP BY GROUPING SETS ((return_date, division), ())"""


@catalog.add("grand_total_row", sql([PF, DIV_DAILY, f"g AS ({GRAND})"], f"""
SELECT *, coalesce({pct('profit', 'rev')}, 0) AS gpm FROM g"""))
def grand_total_row(spark, folder):
    daily = kpi.division_daily(this_week(spark, folder), unit=P.DAY_UNIT)
    return kpi.ratio_gpm_nonzero(kpi.grand_total_row(daily, ["return_date", "division"], ["rev", "profit", "cnt"]))


@catalog.add("wow_join", sql(POLICY_PAIR, wow_select("policy_id")))
def wow_join(spark, folder):
    return periods.wow_rows(paired_policies(spark, folder), ["policy_id"])


@catalog.add("wow_total_row", sql(POLICY_PAIR, wow_total()))
def wow_total_row(spark, folder):
    return periods.wow_total_row(paired_policies(spark, folder))


@catalog.add("policies_new", sql([PF, POLICY_WEEKS], f"""
SELECT policy_id, cnt, {pct('profit', 'rev')} AS gpm FROM weeks
WHERE week = 15 AND policy_id NOT IN (SELECT policy_id FROM weeks WHERE week = 14)"""))
def policies_new(spark, folder):
    return periods.policies_new(paired_policies(spark, folder), ["policy_id"])


@catalog.add("policies_ended", sql([PF, POLICY_WEEKS], f"""
SELECT policy_id, cnt, {pct('profit', 'rev')} AS gpm FROM weeks
WHERE week = 14 AND policy_id NOT IN (SELECT policy_id FROM weeks WHERE week = 15)"""))
def policies_ended(spark, folder):
    return periods.policies_ended(paired_policies(spark, folder), ["policy_id"])


STATUS = """CASE WHEN cur_cnt = 0 AND prev_cnt = 0 THEN 'absent' WHEN cur_cnt = 0 THEN 'ended' WHEN prev_cnt = 0 THEN 'new'
  WHEN cur_cnt > prev_cnt THEN 'grew' WHEN cur_cnt < prev_cnt THEN 'shrank' ELSE 'same' END"""


@catalog.add("top_revenue_shift", sql([*POLICY_PAIR, f"""
moved AS (SELECT policy_id, {sub('cur_rev', 'prev_rev')} AS d_rev, prev_cnt, cur_cnt, cur_cnt - prev_cnt AS d_cnt,
  {STATUS} AS note FROM f)"""], """
SELECT *, CAST(row_number() OVER (ORDER BY abs(d_rev) DESC, policy_id) AS INTEGER) AS rank FROM moved
QUALIFY rank <= 10"""))
def top_revenue_shift(spark, folder):
    return periods.top_revenue_shift(paired_policies(spark, folder), "policy_id", 10)


@catalog.add("change_status", sql(POLICY_PAIR, f"SELECT policy_id, prev_cnt, cur_cnt, {STATUS} AS status FROM f"))
def change_status_query(spark, folder):
    rows = periods.zero_filled(paired_policies(spark, folder), ("cnt",))
    return rows.select("policy_id", "prev_cnt", "cur_cnt", change_status(F.col("prev_cnt"), F.col("cur_cnt")).alias("status"))


@catalog.add("dim_label", sql([PF, DIV_WEEK], """
SELECT *, CASE division WHEN 'ECONOMY' THEN 'Economy class' WHEN 'PROMO' THEN 'Promotions' WHEN 'SMALL' THEN 'Small'
  WHEN 'LARGE' THEN 'Large' ELSE division END AS label FROM grouped"""))
def dim_label(spark, folder):
    grouped = kpi.division_rollup(this_week(spark, folder), unit=P.DAY_UNIT).drop("iso_year", "week")
    return periods.dim_label(grouped, "division", periods.label_table(grouped, P.LABELS))


OFFSETS = f"""
days AS (SELECT return_date AS d, count(DISTINCT reservation_id) AS cnt, {q('sum(revenue)', '1e3', 1)} AS rev FROM pf GROUP BY ALL),
aligned AS (
  SELECT o AS "offset", DATE '1998-05-01' + o AS may_date, coalesce(m.cnt, 0) AS may_cnt, coalesce(m.rev, 0) AS may_rev,
    DATE '1998-06-01' + o AS jun_date, coalesce(j.cnt, 0) AS jun_cnt, coalesce(j.rev, 0) AS jun_rev
  FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS o) AS g
  LEFT JOIN days AS m ON m.d = DATE '1998-05-01' + o LEFT JOIN days AS j ON j.d = DATE '1998-06-01' + o
)"""


def offset_table(spark, folder) -> DataFrame:
    measures = {"cnt": F.countDistinct("reservation_id"), "rev": in_unit(F.sum("revenue"), P.DAY_UNIT, 1)}
    return periods.align_day_offset(fact(spark, folder), "return_at", P.OFFSET_STARTS, 7, measures)


@catalog.add("align_day_offset", sql([PF, OFFSETS], "SELECT * FROM aligned"))
def align_day_offset(spark, folder):
    return offset_table(spark, folder)


@catalog.add("running_total", sql([PF, OFFSETS], """
SELECT 'may' AS period, "offset", may_cnt AS cnt, CAST(sum(may_cnt) OVER (ORDER BY "offset") AS BIGINT) AS running FROM aligned
UNION ALL
SELECT 'jun' AS period, "offset", jun_cnt AS cnt, CAST(sum(jun_cnt) OVER (ORDER BY "offset") AS BIGINT) AS running FROM aligned"""))
def running_total(spark, folder):
    pairs = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"{p}_cnt").alias("cnt")) for p in P.OFFSET_STARTS])
    long = offset_table(spark, folder).select("offset", F.inline(pairs))
    return periods.running_total(long, ["period"], "offset", "cnt")


@catalog.add("sum_two_series", sql([PF, DIV_DAILY], f"""
SELECT return_date, coalesce(a.rev, 0) AS a, coalesce(b.rev, 0) AS b, {dec('coalesce(a.rev, 0) + coalesce(b.rev, 0)', 1)} AS total
FROM (SELECT * FROM daily WHERE division = 'PROMO') AS a FULL JOIN (SELECT * FROM daily WHERE division = 'ECONOMY') AS b
USING (return_date)"""))
def sum_two_series(spark, folder):
    keys = [kpi.return_date().alias("return_date"), F.col(kpi.DIVISION).alias("division")]
    daily = this_week(spark, folder).groupBy(*keys).agg(in_unit(F.sum("revenue"), P.DAY_UNIT, 1).alias("rev"))
    return periods.sum_series(daily, "division", "PROMO", "ECONOMY", "return_date", "rev")


INTENSITY = "rev / NULLIF(max(rev) OVER (PARTITION BY division), 0)"


@catalog.add("intensity_of_max", sql([PF, DIV_DAILY, f"r AS (SELECT *, {INTENSITY} AS ratio FROM daily)"], f"""
SELECT return_date, division, rev, profit, cnt, {dec('ratio', 3)} AS intensity,
  CASE WHEN ratio > 0.7 THEN 'high' WHEN ratio > 0.4 THEN 'mid' ELSE 'low' END AS level FROM r"""))
def intensity_of_max(spark, folder):
    daily = kpi.division_daily(this_week(spark, folder), unit=P.DAY_UNIT)
    return periods.intensity_of_max(daily, ["division"], "rev")


@catalog.add("period_delta", sql([PF, weekly(), """
lagged AS (SELECT ctype, week, rev, lag(rev) OVER (PARTITION BY ctype ORDER BY week) AS prev_value FROM weekly)"""], f"""
SELECT *, {sub('rev', 'prev_value', 2)} AS delta, {pct('(rev - prev_value)', 'prev_value')} AS delta_pct FROM lagged"""))
def period_delta(spark, folder):
    series = class_weekly(spark, folder).select("ctype", "week", "rev")
    return periods.period_delta(series, ["ctype"], "week", "rev")


@catalog.add("sort_gpm_asc", sql([PF, DIV_WEEK], """
SELECT *, CAST(row_number() OVER (ORDER BY coalesce(profit / NULLIF(rev, 0), 0), division) AS INTEGER) AS rank FROM grouped"""))
def sort_gpm_asc(spark, folder):
    return periods.sort_gpm_asc(kpi.division_rollup(this_week(spark, folder), unit=P.DAY_UNIT).drop("iso_year", "week"))


@catalog.add("sort_delta_desc", sql([*DIV_PAIR, f"wow AS ({wow_select('division')})"], """
SELECT *, CAST(row_number() OVER (ORDER BY d_rev DESC, division) AS INTEGER) AS rank FROM wow"""))
def sort_delta_desc(spark, folder):
    return periods.sort_delta_desc(periods.wow_rows(paired_divisions(spark, folder), ["division"]))


POLICY_GPM = sql([PF], f"""
SELECT coupon_policy_id, {pct('sum(profit)', 'sum(revenue)')} AS gpm FROM pf WHERE coupon_policy_id IS NOT NULL
GROUP BY coupon_policy_id""")


def policy_margin(spark, folder) -> DataFrame:
    used = fact(spark, folder).filter(F.col(kpi.POLICY_ID).isNotNull())
    return kpi.weighted_gpm(used, [kpi.POLICY_ID]).withColumnRenamed("weighted_gpm", "gpm")


@catalog.add("gpm_band_target", f"""SELECT *, CASE WHEN gpm IS NULL THEN 'new' WHEN gpm < 0 THEN 'red' WHEN gpm < 25 THEN 'yellow'
ELSE 'green' END AS band FROM ({POLICY_GPM})""")
def gpm_band_target_query(spark, folder):
    return policy_margin(spark, folder).withColumn("band", gpm_band_target(F.col("gpm")))


@catalog.add("target_verdict", f"""SELECT *, CASE WHEN gpm IS NULL THEN NULL WHEN gpm < 25 THEN 'excessive' WHEN gpm < 35
THEN 'adequate' ELSE 'excellent' END AS verdict FROM ({POLICY_GPM})""")
def target_verdict_query(spark, folder):
    return policy_margin(spark, folder).withColumn("verdict", target_verdict(F.col("gpm")))


@catalog.add("delta_direction", sql(POLICY_PAIR, f"""
SELECT policy_id, d_rev, d_rev_pct, CASE WHEN d_rev > 0 THEN 'up' WHEN d_rev < 0 THEN 'down' ELSE 'flat' END AS direction,
  CASE WHEN d_rev_pct IS NULL THEN '-' WHEN d_rev_pct > 0 THEN 'up' WHEN d_rev_pct < 0 THEN 'down' ELSE 'flat' END AS pct_direction
FROM (SELECT policy_id, {DELTAS} FROM f)"""))
def delta_direction_query(spark, folder):
    rows = periods.zero_filled(paired_policies(spark, folder), ("rev",)).select(
        "policy_id", difference("cur_rev", "prev_rev").alias("d_rev"),
        percent(F.col("cur_rev") - F.col("prev_rev"), "prev_rev").alias("d_rev_pct"))
    return rows.withColumns({"direction": delta_direction(F.col("d_rev")), "pct_direction": delta_direction(F.col("d_rev_pct"))})


WEEKLY_REPORT = ", ".join(
    f"{c}_cnt, {c}_rev, {guarded(f'{c}_pft', f'{c}_rev', '> 0')} AS {c}_gpm, {guarded(f'{c}_cm', f'{c}_rev', '> 0')} AS {c}_cm_pct"
    for c in ("eb", "sd"))


@catalog.add("report_weekly_detail", sql([PF, weekly(), ALIGNED], f"SELECT week, {LABEL}, {WEEKLY_REPORT} FROM aligned"))
def report_weekly_detail(spark, folder):
    return reports.report_weekly_detail(class_weekly(spark, folder))


@catalog.add("report_overview_cards", sql([PF, DIV_WEEKS], f"""
SELECT total_rev, {pct('(total_rev - prev_rev)', 'prev_rev')} AS rev_pct, {pct('total_profit', 'total_rev')} AS weighted_gpm,
  total_profit, reached, groups
FROM (SELECT {exact('rev')} AS total_rev, {exact('profit')} AS total_profit, count(*) AS groups,
    count(*) FILTER (rev > 0 AND profit * 100 / NULLIF(rev, 0) >= 10) AS reached FROM weeks WHERE week = 15),
  (SELECT {exact('rev')} AS prev_rev FROM weeks WHERE week = 14)"""))
def report_overview_cards(spark, folder):
    return reports.report_overview_cards(division_weeks(spark, folder), P.WEEK, target=10.0)


LABEL_CASE = """CASE division WHEN 'ECONOMY' THEN 'Economy class' WHEN 'PROMO' THEN 'Promotions' WHEN 'SMALL' THEN 'Small'
  WHEN 'LARGE' THEN 'Large' ELSE division END"""


@catalog.add("report_division_table", sql([PF, DIV_WEEK], f"""
SELECT *, {LABEL_CASE} AS label, coalesce({pct('profit', 'rev')}, 0) AS gpm,
  CAST(row_number() OVER (ORDER BY coalesce(profit / NULLIF(rev, 0), 0), division) AS INTEGER) AS rank FROM grouped"""))
def report_division_table(spark, folder):
    grouped = kpi.division_rollup(this_week(spark, folder), unit=P.DAY_UNIT).drop("iso_year", "week")
    return reports.report_division_table(grouped, periods.label_table(grouped, P.LABELS))


@catalog.add("report_wow", sql([*DIV_PAIR, f"wow AS ({wow_select('division')})", f"total AS ({wow_total()})"], f"""
SELECT *, {LABEL_CASE} AS label, CAST(row_number() OVER (ORDER BY d_rev DESC, division) AS INTEGER) AS rank FROM wow
UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS division, 'total' AS label, 0 AS rank FROM total"""))
def report_wow(spark, folder):
    weeks = division_weeks(spark, folder)
    return reports.report_wow(weeks, P.WEEK, periods.label_table(weeks, P.LABELS))


@catalog.add("report_division_daily", sql([
    PF, DIV_DAILY, "chosen AS (SELECT * FROM daily WHERE division IN ('STANDARD', 'PROMO'))",
    f"r AS (SELECT *, {INTENSITY} AS ratio FROM chosen)", f"""
rows AS (
  SELECT return_date, division, rev, profit, cnt, {dec('ratio', 3)} AS intensity,
    CASE WHEN ratio > 0.7 THEN 'high' WHEN ratio > 0.4 THEN 'mid' ELSE 'low' END AS level, 0 AS is_total FROM r
  UNION ALL SELECT NULL, division, {exact('rev')}, {exact('profit')}, CAST(sum(cnt) AS BIGINT), NULL, NULL, 1 FROM chosen GROUP BY division
)"""], f"SELECT *, coalesce({pct('profit', 'rev')}, 0) AS gpm FROM rows"))
def report_division_daily(spark, folder):
    daily = kpi.division_daily(this_week(spark, folder), unit=P.DAY_UNIT)
    return reports.report_division_daily(daily, ["STANDARD", "PROMO"])
