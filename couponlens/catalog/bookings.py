"""Queries on bookings: behaviour, heatmaps, first-week comparison, discount mix, transitions, streaming rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.catalog import Catalog
from couponlens.catalog import params as P
from couponlens.catalog.sqlkit import BK, WEEKDAY, dec, exact, pct, q, sql, sub
from couponlens.functions.dates import MICROS_PER_HOUR
from couponlens.functions.numbers import in_unit
from couponlens.functions.rules import DURATION_LABELS, gpm_band_abs, weekday_name
from couponlens.operators import behavior, filters, kpi, mix, periods
from couponlens.plans import reports
from couponlens.sources.tables import SCHEMAS, booking_columns, read_bookings, read_policies, table_path
from couponlens.streaming.rollup import run_rollup

catalog = Catalog()
UNIT = P.DAY_UNIT

CNT = "count(*) AS cnt"
REV = f"{q('sum(revenue)', '1e3', 1)} AS rev"
GPM = f"{pct('sum(profit)', 'sum(revenue)')} AS gpm"
RPU = f"{q('sum(revenue)', 'count(*)', 0)} AS rpu"
AVG_H = f"{q('sum(duration_us)', 'count(*) * CAST(3600000000 AS DOUBLE)', 1)} AS avg_h"
AVG_LEAD = f"{q('sum(lead_us)', 'count(*) * CAST(3600000000 AS DOUBLE)', 1)} AS avg_lead"
GP = f"{q('sum(profit)', '1e3', 1)} AS gp"
LEAD_POS = "CAST(list_position(['<1h', '1h-1d', '1-3d', '3d-1w', '1-2w', '2-4w', '4w+'], lead_bucket) AS INTEGER) AS pos"
DUR_POS = "CAST(list_position(['<4h', '4-8h', '8-24h', '1 night', '2 nights', '3d+'], dur_bucket) AS INTEGER) AS pos"


@catalog.add("bucket_leadtime", sql([BK], f"""
SELECT lead_bucket AS bucket, {LEAD_POS}, {CNT}, {REV}, {GPM}, {RPU}, {AVG_H} FROM bkb GROUP BY lead_bucket"""))
def bucket_leadtime(spark, folder):
    return behavior.bucket_leadtime(read_bookings(spark, folder), unit=UNIT)


DURATION = f"SELECT dur_bucket AS bucket, {DUR_POS}, {CNT}, {REV}, {GPM}, {RPU}, {GP} FROM bkb GROUP BY dur_bucket"


@catalog.add("bucket_duration", sql([BK], DURATION))
def bucket_duration(spark, folder):
    return behavior.bucket_duration(read_bookings(spark, folder), unit=UNIT)


BY_DOW = f"SELECT dow, {WEEKDAY} AS weekday, {CNT}, {REV}, {GPM}, {RPU}, {AVG_H} FROM bkb GROUP BY dow"


@catalog.add("by_weekday", sql([BK], BY_DOW))
def by_weekday(spark, folder):
    return behavior.by_weekday(read_bookings(spark, folder), unit=UNIT)


@catalog.add("by_hour", sql([BK, f"h AS (SELECT hr, {CNT}, {REV}, {RPU}, {AVG_H} FROM bkb GROUP BY hr)"], """
SELECT CAST(g.i AS INTEGER) AS hour, coalesce(cnt, 0) AS cnt, coalesce(rev, 0) AS rev, rpu, avg_h
FROM (SELECT unnest(range(24)) AS i) AS g LEFT JOIN h ON h.hr = g.i"""))
def by_hour(spark, folder):
    return behavior.by_hour(read_bookings(spark, folder), unit=UNIT)


CELLS = f"cells AS (SELECT dow, block, {CNT}, {RPU} FROM bkb GROUP BY dow, block)"
BLOCKS = ("06-10", "10-14", "14-18", "18-22", "22-06")


def _wide(value: str, fill: bool) -> str:
    cell = "coalesce(max({v}) FILTER (block = '{b}'), 0)" if fill else "max({v}) FILTER (block = '{b}')"
    columns = ", ".join(f"{cell.format(v=value, b=b)} AS \"{b}\"" for b in BLOCKS)
    return sql([BK, CELLS], f"SELECT dow, {WEEKDAY} AS weekday, {columns} FROM cells GROUP BY dow")


@catalog.add("heatmap_count", _wide("cnt", True))
def heatmap_count(spark, folder):
    return behavior.heatmap_count(read_bookings(spark, folder))


@catalog.add("heatmap_rpu", _wide("rpu", False))
def heatmap_rpu(spark, folder):
    return behavior.heatmap_rpu(read_bookings(spark, folder))


@catalog.add("intensity_minmax", sql([BK, CELLS, """
long AS (SELECT 'cnt' AS matrix, dow, block, CAST(cnt AS DOUBLE) AS value FROM cells
  UNION ALL SELECT 'rpu', dow, block, rpu FROM cells)""", """
r AS (SELECT *, (value - min(value) OVER m) / NULLIF(max(value) OVER m - min(value) OVER m, 0) AS raw FROM long
  WINDOW m AS (PARTITION BY matrix))"""], f"""
SELECT dow, block, matrix, value, {dec('raw', 3)} AS ratio,
  CASE WHEN raw > 0.7 THEN 'highest' WHEN raw > 0.4 THEN 'high' WHEN raw > 0.2 THEN 'mid' ELSE 'low' END AS level FROM r"""))
def intensity_minmax(spark, folder):
    cells = behavior.heatmap_cells(behavior.heatmap_long(read_bookings(spark, folder)))
    return periods.intensity_minmax(cells, ["matrix"], "value")


@catalog.add("monthly_trend", sql([BK], f"""
SELECT month, {CNT}, {REV}, {GPM}, {RPU}, {AVG_H}, {AVG_LEAD} FROM bkb GROUP BY month"""))
def monthly_trend(spark, folder):
    return behavior.monthly_trend(read_bookings(spark, folder), unit=UNIT)


@catalog.add("share_of_total", sql([BK], f"""
SELECT lead_bucket AS bucket, count(*) AS cnt, {pct('count(*)', 'sum(count(*)) OVER ()')} AS share FROM bkb GROUP BY lead_bucket"""))
def share_of_total(spark, folder):
    return kpi.share_of_total(behavior.bucket_leadtime(read_bookings(spark, folder)).select("bucket", "cnt"), "cnt")


LONG_STAY = DURATION_LABELS[3:]


@catalog.add("profit_contribution", sql([BK, f"grouped AS ({DURATION})"], f"""
SELECT members_cnt, {pct('members_cnt', 'total_cnt')} AS cnt_share, members_gp, {pct('members_gp', 'total_gp')} AS gp_share
FROM (SELECT CAST(sum(cnt) FILTER (pos > 3) AS BIGINT) AS members_cnt, sum(cnt) AS total_cnt,
  CAST(sum(CAST(gp AS DECIMAL(28,6))) FILTER (pos > 3) AS DOUBLE) AS members_gp, {exact('gp')} AS total_gp FROM grouped)"""))
def profit_contribution(spark, folder):
    grouped = behavior.bucket_duration(read_bookings(spark, folder), unit=UNIT)
    return behavior.profit_contribution(grouped, "bucket", LONG_STAY, "cnt", "gp")


def _ends(measure: str) -> str:
    one = "SELECT * FROM (SELECT '{m}' AS measure, '{k}' AS kind, weekday AS \"group\", CAST({m} AS DOUBLE) AS value FROM grouped ORDER BY {m} {d}, weekday {d} LIMIT 1)"
    return " UNION ALL ".join(one.format(m=measure, k=k, d=d) for k, d in (("best", "DESC"), ("worst", "ASC")))


def _peaks(measure: str) -> str:
    one = (f"SELECT * FROM (SELECT '{{m}}' AS measure, '{{k}}' AS kind, {WEEKDAY} || ' ' || block AS \"group\", CAST({{m}} AS DOUBLE) AS value "
           "FROM cells ORDER BY {m} {d}, \"group\" {d} LIMIT 1)")
    return " UNION ALL ".join(one.format(m=measure, k=k, d=d) for k, d in (("best", "DESC"), ("worst", "ASC")))


@catalog.add("extreme_groups", sql(
    [BK, f"grouped AS ({BY_DOW})", CELLS], " UNION ALL ".join([*[_ends(m) for m in ("rpu", "gpm", "cnt")], *[_peaks(m) for m in ("cnt", "rpu")]])))
def extreme_groups(spark, folder):
    """Best and worst weekday by three measures, and the peak and the lowest cell of both heatmaps."""
    bookings = read_bookings(spark, folder)
    cells = behavior.heatmap_long(bookings).withColumn("weekday", weekday_name(F.col("dow")))
    days = behavior.extreme_groups(behavior.by_weekday(bookings, unit=UNIT), "weekday", ["rpu", "gpm", "cnt"])
    return days.unionByName(behavior.extreme_groups(cells, ["weekday", "block"], ["cnt", "rpu"]))


PROFIT = f"{q('sum(profit)', '1e3', 1)} AS profit"
MATRIX = f"matrix AS (SELECT time_group, discount_rate AS rate, {CNT}, {REV}, {PROFIT}, {GPM}, {RPU} FROM bkb GROUP BY ALL)"


def discount_matrix(spark, folder) -> DataFrame:
    return mix.timegroup_discount_matrix(read_bookings(spark, folder), unit=UNIT)


@catalog.add("timegroup_discount_matrix", sql([BK, MATRIX], "SELECT * FROM matrix"))
def timegroup_discount_matrix(spark, folder):
    return discount_matrix(spark, folder)


@catalog.add("gpm_band_abs", sql([BK, MATRIX], """
SELECT time_group, rate, gpm, CASE WHEN gpm >= 25 THEN 'green' WHEN gpm >= 10 THEN 'yellow' ELSE 'red' END AS band FROM matrix"""))
def gpm_band_abs_query(spark, folder):
    return discount_matrix(spark, folder).select("time_group", "rate", "gpm", gpm_band_abs(F.col("gpm")).alias("band"))


@catalog.add("actual_use_distribution", sql([BK], f"""
SELECT time_group, CAST(list_position(['~4h', '4~8h', '8~24h', '24h+'], time_group) AS INTEGER) AS pos, {CNT},
  {pct('count(*)', 'sum(count(*)) OVER ()')} AS share, {RPU}, {GPM} FROM bkb WHERE policy_id = 3 GROUP BY time_group"""))
def actual_use_distribution(spark, folder):
    return mix.actual_use_distribution(read_bookings(spark, folder), "policy_id", 3)


@catalog.add("discount_migration", sql([BK, f"cells AS (SELECT time_group, month, discount_rate AS rate, {CNT}, {GPM} FROM bkb GROUP BY ALL)"],
    "SELECT time_group, month, " + ", ".join(
        f"max(cnt) FILTER (rate = {r}) AS cnt_{r}, max(gpm) FILTER (rate = {r}) AS gpm_{r}" for r in P.RATES
    ) + " FROM cells GROUP BY time_group, month"))
def discount_migration(spark, folder):
    return mix.discount_migration(read_bookings(spark, folder), P.RATES)


@catalog.add("scenario_weighted_gpm", sql([BK, MATRIX, f"""
swap AS (
  SELECT m.time_group, m.rev, m.profit, CASE WHEN m.time_group = '4~8h' THEN CAST(t.profit AS DOUBLE) / NULLIF(t.rev, 0) END AS ratio
  FROM matrix AS m LEFT JOIN (SELECT time_group, rev, profit FROM matrix WHERE rate = 45) AS t ON t.time_group = m.time_group
)""", f"""
s AS (
  SELECT {exact('rev')} AS r, {exact('profit')} AS p,
    CAST(sum(CAST(rev AS DECIMAL(28,6))) FILTER (time_group = '4~8h') AS DOUBLE) AS rs,
    CAST(sum(CAST(profit AS DECIMAL(28,6))) FILTER (time_group = '4~8h') AS DOUBLE) AS ps, max(ratio) AS ratio FROM swap
)"""], f"""
SELECT '4~8h' AS segment, 45 AS rate, {pct('ps', 'rs')} AS segment_gpm, {dec('ratio * 100', 1)} AS replacement_gpm,
  {pct('p', 'r')} AS base_gpm, {pct('(p - ps + rs * ratio)', 'r')} AS scenario_gpm FROM s"""))
def scenario_weighted_gpm(spark, folder):
    return mix.scenario_weighted_gpm(discount_matrix(spark, folder), "4~8h", 45)


@catalog.add("repeat_transition", sql([BK, """
numbered AS (SELECT user_id, division, row_number() OVER (PARTITION BY user_id ORDER BY created_at, booking_id) AS n FROM bk)""", """
pairs AS (SELECT a.division AS first_division, b.division AS second_division, count(*) AS users
  FROM numbered AS a JOIN numbered AS b ON a.user_id = b.user_id AND a.n = 1 AND b.n = 2 GROUP BY ALL)"""], f"""
SELECT *, {pct('users', 'sum(users) OVER (PARTITION BY first_division)')} AS share FROM pairs"""))
def repeat_transition(spark, folder):
    return mix.repeat_transition(read_bookings(spark, folder), "user_id", "created_at", "booking_id", "division")


@catalog.add("return_date_distribution", sql([BK], """
SELECT end_date AS return_date, count(*) AS cnt FROM bk WHERE end_date BETWEEN DATE '2024-02-01' AND DATE '2024-02-29' GROUP BY ALL"""))
def return_date_distribution(spark, folder):
    return kpi.return_date_distribution(read_bookings(spark, folder), "end_at", P.FEBRUARY)


NAMED_BK = "named AS (SELECT bk.*, p_name AS policy_name FROM bk JOIN part ON p_partkey = policy_id)"


PAGE_BK = "page AS (SELECT * FROM named WHERE policy_name LIKE '%bolt%' AND state = 1)"


def named_bookings(spark, folder) -> DataFrame:
    policies = read_policies(spark, folder).select(F.col("id").alias("policy_id"), F.col("name").alias("policy_name"))
    return read_bookings(spark, folder).join(policies, "policy_id")


def page_bookings(spark, folder) -> DataFrame:
    """The rows of the first-week page: bookings under coupons whose name matches and that are in use."""
    return filters.filter_policy_state(named_bookings(spark, folder), "policy_name", "bolt", "state", 1)


@catalog.add("filter_return_window", sql([BK, NAMED_BK], f"""
SELECT end_date AS return_date, count(*) AS cnt, {q('sum(duration_us)', 'CAST(3600000000 AS DOUBLE)', 1)} AS hours
FROM named WHERE policy_name LIKE '%bolt%' AND state = 1 AND end_date BETWEEN DATE '2024-02-01' AND DATE '2024-02-07' GROUP BY ALL"""))
def filter_return_window(spark, folder):
    kept = filters.filter_return_window(named_bookings(spark, folder), "policy_name", "bolt", "state", 1, "end_at", P.FEB_WEEK)
    return kept.groupBy(F.to_date("end_at").alias("return_date")).agg(
        F.count(F.lit(1)).alias("cnt"),
        in_unit(behavior.span_sum("duration_us"), float(MICROS_PER_HOUR), 1).alias("hours"))


HOURS = "CAST(3600000000 AS DOUBLE)"


@catalog.add("first_week_compare", sql([BK, NAMED_BK, PAGE_BK, f"""
s AS (SELECT count(*) FILTER (cur) AS cur_cnt, count(*) FILTER (prev) AS prev_cnt,
    coalesce({q('sum(duration_us) FILTER (cur)', HOURS, 1)}, 0) AS cur_hours,
    coalesce({q('sum(duration_us) FILTER (prev)', HOURS, 1)}, 0) AS prev_hours
  FROM (SELECT *, end_date BETWEEN DATE '2024-02-01' AND DATE '2024-02-07' AS cur,
    end_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AS prev FROM page))"""], f"""
SELECT prev_cnt, cur_cnt, cur_cnt - prev_cnt AS d_cnt, {pct('(cur_cnt - prev_cnt)', 'prev_cnt')} AS d_cnt_pct,
  prev_hours, cur_hours, {sub('cur_hours', 'prev_hours')} AS d_hours, {pct('(cur_hours - prev_hours)', 'prev_hours')} AS d_hours_pct,
  {q('prev_hours', 'prev_cnt', 1)} AS prev_mean_h, {q('cur_hours', 'cur_cnt', 1)} AS cur_mean_h FROM s"""))
def first_week_compare(spark, folder):
    return behavior.first_week_compare(page_bookings(spark, folder), "end_at", P.FEB_WEEK, P.JAN_WEEK)


@catalog.add("subset_share", sql([BK], f"""
SELECT *, {pct('in_set', 'total')} AS share FROM (
  SELECT count(*) FILTER (end_date IN (DATE '2024-02-09', DATE '2024-02-12')) AS in_set,
    count(*) FILTER (end_date NOT IN (DATE '2024-02-09', DATE '2024-02-12')) AS out_of_set, count(*) AS total
  FROM bk WHERE end_date BETWEEN DATE '2024-02-08' AND DATE '2024-02-14')"""))
def subset_share(spark, folder):
    inside = [d for d in P.HOLIDAYS if P.HOLIDAY_WEEK[0] <= d <= P.HOLIDAY_WEEK[1]]
    return behavior.subset_share(read_bookings(spark, folder), "end_at", P.HOLIDAY_WEEK, inside)


HOLIDAYS = ("holidays AS (SELECT * FROM (VALUES (DATE '2024-01-01', 'New Year'), (DATE '2024-02-09', 'Lunar New Year'), "
            "(DATE '2024-02-12', 'substitute'), (DATE '2024-03-01', 'March First')) AS t(day, holiday))")


def day_tag(day: str, holiday: str) -> str:
    return (f"CASE WHEN {holiday} IS NOT NULL THEN 'holiday' WHEN dayofweek({day}) IN (0, 6) THEN 'weekend' "
            f"WHEN {day} IS NOT NULL THEN 'weekday' END")


@catalog.add("tag_calendar", sql([BK, HOLIDAYS, "days AS (SELECT end_date, count(*) AS cnt FROM bk GROUP BY ALL)"], f"""
SELECT end_date, cnt, holiday, dayofweek(end_date) IN (0, 6) AS is_weekend, {day_tag('end_date', 'holiday')} AS day_tag
FROM days LEFT JOIN holidays ON day = end_date"""))
def tag_calendar(spark, folder):
    days = read_bookings(spark, folder).groupBy(F.to_date("end_at").alias("end_date")).agg(F.count(F.lit(1)).alias("cnt"))
    return periods.tag_calendar(days, "end_date", periods.holiday_table(days, P.HOLIDAYS))


FIRST_WEEK = f"""
days AS (SELECT end_date AS d, count(*) AS cnt, {q('sum(duration_us)', HOURS, 1)} AS hours FROM page GROUP BY ALL),
wide AS (
  SELECT o AS "offset", DATE '2024-01-08' + o AS jan_date, coalesce(j.cnt, 0) AS jan_cnt, coalesce(j.hours, 0) AS jan_hours,
    DATE '2024-02-01' + o AS feb_date, coalesce(f.cnt, 0) AS feb_cnt, coalesce(f.hours, 0) AS feb_hours
  FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS o) AS g
  LEFT JOIN days AS j ON j.d = DATE '2024-01-08' + o LEFT JOIN days AS f ON f.d = DATE '2024-02-01' + o
),
rows AS (
  SELECT wide.*, {day_tag('jan_date', 'a.holiday')} AS jan_day_tag, {day_tag('feb_date', 'b.holiday')} AS feb_day_tag,
    CAST(sum(jan_cnt) OVER (ORDER BY "offset") AS BIGINT) AS jan_running, CAST(sum(feb_cnt) OVER (ORDER BY "offset") AS BIGINT) AS feb_running
  FROM wide LEFT JOIN holidays AS a ON a.day = jan_date LEFT JOIN holidays AS b ON b.day = feb_date
  UNION ALL BY NAME
  SELECT CAST(sum(jan_cnt) AS BIGINT) AS jan_cnt, {exact('jan_hours')} AS jan_hours, CAST(sum(feb_cnt) AS BIGINT) AS feb_cnt,
    {exact('feb_hours')} AS feb_hours, CAST(sum(jan_cnt) AS BIGINT) AS jan_running, CAST(sum(feb_cnt) AS BIGINT) AS feb_running FROM wide
)"""


@catalog.add("report_first_week", sql([BK, NAMED_BK, PAGE_BK, HOLIDAYS, FIRST_WEEK], f"""
SELECT *, feb_cnt - jan_cnt AS d_cnt, {pct('(feb_cnt - jan_cnt)', 'jan_cnt')} AS d_cnt_pct FROM rows"""))
def report_first_week(spark, folder):
    measures = {
        "cnt": F.count(F.lit(1)),
        "hours": in_unit(behavior.span_sum("duration_us"), float(MICROS_PER_HOUR), 1),
    }
    return reports.report_first_week(page_bookings(spark, folder), "end_at", P.END_STARTS, 7, measures, P.HOLIDAYS)


@catalog.add("incremental_daily_rollup", sql([BK], f"""
SELECT CAST(created_at AS DATE) AS event_date, division, count(*) AS cnt, {dec('sum(revenue)', 2)} AS rev FROM bk
GROUP BY CAST(created_at AS DATE), division
HAVING CAST(CAST(created_at AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(created_at) FROM bk) - INTERVAL 1 DAY"""))
def incremental_daily_rollup(spark, folder):
    # The stream source takes a folder or a pattern; the pattern also covers a table that is a single file.
    source = table_path(folder, "[e]vents")
    return run_rollup(
        spark, source, SCHEMAS["events"], booking_columns,
        ts="created_at", id="booking_id", group="division", delay="1 day")
