"""Queries on the normalised coupon tables: lookups, net revenue, creation tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.catalog import Catalog
from couponlens.catalog import params as P
from couponlens.catalog.profit import class_weekly
from couponlens.catalog.sqlkit import CP, PF, dec, exact, ledger_daily, pct, q, sql, weekly
from couponlens.functions.cells import parse_number, parse_range, policy_name_attributes
from couponlens.functions.dates import local_date
from couponlens.functions.numbers import percent
from couponlens.functions.rules import volume_tier
from couponlens.operators import filters, kpi, lookups, mix, shaping
from couponlens.plans import reports
from couponlens.session import shared_folder
from couponlens.sinks.report_files import manifest, to_records, with_json
from couponlens.sources.sectioned_text import read_sections, render_sections
from couponlens.sources.tables import read_coupon_tables, read_table

catalog = Catalog()


def valid(tables) -> DataFrame:
    return filters.filter_valid_reservation(tables["reservation"], created="created_at", **P.VALID)


def daily(spark, folder, named: bool = False, ids=P.POLICY_IDS) -> DataFrame:
    build = kpi.new_coupon_daily_named if named else kpi.new_coupon_daily
    return build(read_coupon_tables(spark, folder), ids, P.VALID, P.LEDGER, unit=P.DAY_UNIT)


DAILY = [CP, ledger_daily(False)]
NAMED = [CP, ledger_daily(True)]
EVERY = [CP, ledger_daily(False, target="")]  # reservations of all policies


@catalog.add("src_coupon_tables", sql([CP], """
SELECT 'reservation' AS view, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount FROM reservation
UNION ALL SELECT 'coupon', count(*), CAST(sum(policy_id) AS DOUBLE) FROM coupon
UNION ALL SELECT 'policy', count(*), CAST(sum(id) AS DOUBLE) FROM policy
UNION ALL SELECT 'charge', count(*), CAST(sum(amount) AS DOUBLE) FROM charge
UNION ALL SELECT 'payment', count(*), CAST(sum(amount) AS DOUBLE) FROM payment"""))
def src_coupon_tables(spark, folder):
    tables = read_coupon_tables(spark, folder)
    summed = {"reservation": "amount", "coupon": "policy_id", "policy": "id", "charge": "amount", "payment": "amount"}
    counts = [
        tables[v].agg(F.lit(v).alias("view"), F.count(F.lit(1)).alias("n_rows"), F.sum(c).cast("double").alias("amount"))
        for v, c in summed.items()
    ]
    first, *rest = counts
    for part in rest:
        first = first.unionByName(part)
    return first


@catalog.add("filter_valid_reservation", sql([CP], """
SELECT way, member_imaginary, state, count(*) AS cnt, min(create_date) AS first_date FROM valid GROUP BY ALL"""))
def filter_valid_reservation(spark, folder):
    kept = valid(read_coupon_tables(spark, folder))
    return kept.groupBy("way", "member_imaginary", "state").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(local_date(F.col("created_at"), P.ZONE)).alias("first_date"))


@catalog.add("join_coupon_policy", sql([CP], """
SELECT policy_id, coupon_name, state, count(*) AS cnt FROM issued GROUP BY ALL"""))
def join_coupon_policy(spark, folder):
    t = read_coupon_tables(spark, folder)
    return kpi.issued_counts(t["coupon"], t["policy"])


@catalog.add("semi_target_policy", sql([CP], """
SELECT id, create_date FROM valid WHERE id IN (SELECT reservation_id FROM issued WHERE policy_id BETWEEN 4 AND 403)"""))
def semi_target_policy(spark, folder):
    t = read_coupon_tables(spark, folder)
    hits = lookups.semi_target_policy(valid(t), t["coupon"], t["policy"], P.POLICY_IDS)
    return hits.select("id", local_date(F.col("created_at"), P.ZONE).alias("create_date"))


@catalog.add("lookup_policy_one", sql([CP], """
SELECT id, coalesce((SELECT i.policy_id FROM issued AS i WHERE i.reservation_id = valid.id), 0) AS pid,
  (SELECT i.coupon_name FROM issued AS i WHERE i.reservation_id = valid.id) AS coupon_name FROM valid"""))
def lookup_policy_one(spark, folder):
    t = read_coupon_tables(spark, folder)
    return lookups.lookup_policy_one(valid(t), t["coupon"], t["policy"]).select("id", "pid", "coupon_name")


@catalog.add("lookup_amount_sum", sql([CP], """
SELECT valid.id, CAST(coalesce(rents.total, 0) AS DOUBLE) AS rent FROM valid
LEFT JOIN (SELECT reservation_id AS id, sum(amount) AS total FROM charge WHERE charge_type IN ('rent', 'refund') GROUP BY 1) AS rents
  ON rents.id = valid.id"""))
def lookup_amount_sum(spark, folder):
    t = read_coupon_tables(spark, folder)
    found = lookups.lookup_amount_sum(
        valid(t), t["charge"], "id", "reservation_id", "amount", "charge_type", ("rent", "refund"), "rent")
    return found.select("id", F.col("rent").cast("double").alias("rent"))


SIGNED = """
signed AS (
  SELECT reservation_id, amount FROM charge WHERE charge_type IN ('rent', 'refund', 'protection_fee')
  UNION ALL SELECT reservation_id, -amount FROM payment WHERE paid_type = 'coupon'
),
gross AS (SELECT reservation_id, sum(amount) AS total FROM signed GROUP BY 1)"""


@catalog.add("net_revenue", sql([CP, SIGNED], f"""
SELECT id, {q('coalesce(total, 0)', '1.1', 2)} AS net_revenue FROM valid LEFT JOIN gross ON reservation_id = id"""))
def net_revenue(spark, folder):
    t = read_coupon_tables(spark, folder)
    return lookups.net_revenue(valid(t), t["charge"], t["payment"], **P.LEDGER).select("id", "net_revenue")


@catalog.add("new_coupon_daily", sql(DAILY, "SELECT * FROM daily"))
def new_coupon_daily(spark, folder):
    return daily(spark, folder)


@catalog.add("new_coupon_daily_named", sql(NAMED, "SELECT * FROM daily"))
def new_coupon_daily_named(spark, folder):
    return daily(spark, folder, named=True)


PIVOT = "SELECT create_date, " + ", ".join(
    f"coalesce(max(cnt) FILTER (pid = {p}), 0) AS c{p}, coalesce(max(net_rev_m) FILTER (pid = {p}), 0) AS r{p}"
    for p in P.PIVOT_IDS) + " FROM daily GROUP BY create_date"


@catalog.add("pivot_daily_policy", sql(DAILY, PIVOT))
def pivot_daily_policy(spark, folder):
    return shaping.pivot_daily_policy(daily(spark, folder), P.PIVOT_IDS)


@catalog.add("snk_daily_records", sql([*DAILY, f"wide AS ({PIVOT})"],
                                      "SELECT *, strftime(create_date, '%m/%d') AS date FROM wide"))
def snk_daily_records(spark, folder):
    return to_records(shaping.pivot_daily_policy(daily(spark, folder), P.PIVOT_IDS))


KINDS = "kinds AS (SELECT create_date, split_part(coupon_name, ' ', 2) AS kind, sum(cnt) AS cnt FROM daily GROUP BY ALL)"
STACK = "SELECT create_date, " + ", ".join(
    f"CAST(coalesce(sum(cnt) FILTER (kind = '{k}'), 0) AS BIGINT) AS {k}" for k in P.COUPON_KINDS
) + " FROM kinds GROUP BY create_date"


def stacked(spark, folder) -> DataFrame:
    kinds = daily(spark, folder, named=True).withColumn("kind", F.substring_index("coupon_name", " ", -1))
    return shaping.pivot_daily_stack(kinds, P.COUPON_KINDS, "kind")


@catalog.add("pivot_daily_stack", sql([*NAMED, KINDS], STACK))
def pivot_daily_stack(spark, folder):
    return stacked(spark, folder)


@catalog.add("drop_empty_series", sql([*NAMED, KINDS], """
SELECT d.create_date, n.kind AS series, CAST(coalesce(sum(x.cnt), 0) AS BIGINT) AS value
FROM (SELECT DISTINCT create_date FROM kinds) AS d CROSS JOIN (SELECT DISTINCT kind FROM kinds) AS n
LEFT JOIN kinds AS x ON x.create_date = d.create_date AND x.kind = n.kind
GROUP BY ALL"""))
def drop_empty_series(spark, folder):
    return filters.drop_empty_series(shaping.stack_long(stacked(spark, folder), P.COUPON_KINDS), "series", "value")


@catalog.add("revenue_per_booking", sql(NAMED, f"""
SELECT *, {q('net_rev_m * 1000', 'cnt', 0)} AS per FROM daily"""))
def revenue_per_booking(spark, folder):
    return kpi.revenue_per_booking(daily(spark, folder, named=True), "net_rev_m", "cnt", P.DAY_UNIT)


@catalog.add("policy_period_summary", sql(NAMED, f"""
SELECT pid, coupon_name, total, {q('total', '364', 1)} AS per_day, net, {q('net * 1000', 'total', 0)} AS net_per_booking
FROM (SELECT pid, coupon_name, CAST(sum(cnt) AS BIGINT) AS total, {exact('net_rev_m')} AS net FROM daily
  WHERE create_date BETWEEN DATE '1996-01-02' AND DATE '1996-12-30' GROUP BY ALL)"""))
def policy_period_summary(spark, folder):
    return kpi.policy_period_summary(daily(spark, folder, named=True), ["pid", "coupon_name"], P.SUMMARY_WINDOW, P.DAY_UNIT)


@catalog.add("creation_day_counts", sql(EVERY, """
SELECT CAST(create_date - DATE '1997-03-01' + 1 AS INTEGER) AS day_index, CAST(sum(cnt) AS BIGINT) AS cnt FROM daily
WHERE create_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-01' + 89 GROUP BY ALL"""))
def creation_day_counts(spark, folder):
    return kpi.creation_day_counts(daily(spark, folder, ids=None), P.CREATION_START, P.CREATION_DAYS)


@catalog.add("distinct_policies_matched", sql([CP], """
SELECT count(DISTINCT policy_id) AS policies FROM issued WHERE coupon_name LIKE '%bolt%' AND state = 1"""))
def distinct_policies_matched(spark, folder):
    t = read_coupon_tables(spark, folder)
    return kpi.distinct_policies_matched(t["coupon"], t["policy"], "bolt", 1)


@catalog.add("volume_tier", sql(NAMED, """
SELECT pid, total, CASE WHEN total >= 100 THEN 'high' WHEN total >= 30 THEN 'mid' ELSE 'low' END AS tier
FROM (SELECT pid, CAST(sum(cnt) AS BIGINT) AS total FROM daily GROUP BY pid)"""))
def volume_tier_query(spark, folder):
    totals = daily(spark, folder).groupBy("pid").agg(F.sum("cnt").alias("total"))
    return totals.withColumn("tier", volume_tier(F.col("total")))


@catalog.add("inflow_compare", sql([CP, """
firsts AS (SELECT member_id, create_date, amount FROM reservation
  QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY created_at, id) = 1)""", """
per AS (
  SELECT CASE WHEN create_date BETWEEN DATE '1995-01-01' AND DATE '1995-03-31' THEN '95Q1'
    WHEN create_date BETWEEN DATE '1995-04-01' AND DATE '1995-06-30' THEN '95Q2' END AS period, count(*) AS users, sum(amount) AS a
  FROM firsts GROUP BY ALL)""", f"""
shown AS (
  SELECT period, CASE period WHEN '95Q1' THEN 1 ELSE 2 END AS pos, users, CASE period WHEN '95Q1' THEN 90 ELSE 91 END AS days,
    {q('users', "CASE period WHEN '95Q1' THEN 90 ELSE 91 END", 1)} AS per_day, {q('a', 'users', 0)} AS rev_per_booking
  FROM per WHERE period IS NOT NULL)"""], f"""
SELECT *, {pct('(users - lag(users) OVER (ORDER BY pos))', 'lag(users) OVER (ORDER BY pos)')} AS users_pct,
  {pct('(per_day - lag(per_day) OVER (ORDER BY pos))', 'lag(per_day) OVER (ORDER BY pos)')} AS per_day_pct,
  {pct('(rev_per_booking - lag(rev_per_booking) OVER (ORDER BY pos))', 'lag(rev_per_booking) OVER (ORDER BY pos)')} AS rev_pct
FROM shown"""))
def inflow_compare(spark, folder):
    reservations = read_coupon_tables(spark, folder)["reservation"]
    return mix.inflow_compare(reservations, "member_id", "created_at", "amount", P.INFLOW, P.ZONE)


@catalog.add("report_creation_detail", sql([*NAMED, f"""
g AS (SELECT create_date, pid, coupon_name, CAST(sum(cnt) AS BIGINT) AS cnt, {exact('net_rev_m')} AS net_rev_m,
  CASE WHEN GROUPING(pid) = 1 THEN 1 ELSE 0 END AS is_total FROM daily
  GROUP BY GROUPING SETS ((create_date, pid, coupon_name), ()))"""], f"""
SELECT *, {q('net_rev_m * 1000', 'cnt', 0)} AS per FROM g"""))
def report_creation_detail(spark, folder):
    return reports.report_creation_detail(daily(spark, folder, named=True), P.DAY_UNIT)


@catalog.add("snk_refresh_manifest", sql([PF, weekly(), *DAILY, """
m AS (SELECT 'ok' AS status, '1998.12.01' AS updated, (SELECT count(DISTINCT week) FROM weekly WHERE ctype IN ('eb', 'sd')) AS weeks,
  (SELECT count(DISTINCT create_date) FROM daily) AS nc_days)"""], """
SELECT *, '{"status":"' || status || '","updated":"' || updated || '","weeks":' || weeks || ',"nc_days":' || nc_days || '}' AS json FROM m"""))
def snk_refresh_manifest(spark, folder):
    return with_json(manifest(class_weekly(spark, folder), daily(spark, folder), P.AS_OF))


REPORT_TITLE = "Weekly review"

def report_sections() -> dict:
    week = F.col("week").cast("string")
    money = {m: F.col(m).cast("decimal(18,2)").cast("string") for m in ("rev", "cm", "pft")}
    return {"Volume": {"week": week, "bookings": F.col("cnt").cast("string")}, "Money": {"week": week, **money}}


def _cells(section_no: int, section: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT ctype AS file, {section_no} AS section_no, '{section}' AS section, 'data' AS kind, "
        f"CAST(row_number() OVER (PARTITION BY ctype ORDER BY week) AS INTEGER) AS row, {i} AS col, '{h}' AS header, "
        f"CAST({e} AS VARCHAR) AS value FROM weekly"
        for i, (h, e) in enumerate(columns, start=1))


@catalog.add("src_report_tsv", sql([PF, weekly()], " UNION ALL ".join([
    f"SELECT DISTINCT ctype AS file, 0 AS section_no, NULL AS section, 'title' AS kind, 1 AS row, 1 AS col, NULL AS header, '{REPORT_TITLE}' AS value FROM weekly",
    _cells(1, "Volume", [("week", "week"), ("bookings", "cnt")]),
    _cells(2, "Money", [("week", "week"), *[(m, f"CAST({m} AS DECIMAL(18,2))") for m in ("rev", "cm", "pft")]]),
])))
def src_report_tsv(spark, folder):
    """Writes the report files, since the driver tables hold none, and reads them."""
    documents = render_sections(class_weekly(spark, folder), "ctype", "week", REPORT_TITLE, report_sections())
    path = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}"
    documents.write.partitionBy("file").text(path)
    return read_sections(spark, path).drop("line_no").withColumn("file", F.regexp_extract("file", "file=([^/]+)", 1))


@catalog.add("parse_report_number", sql([PF, weekly()], f"""
SELECT ctype, week, CAST(cnt AS DOUBLE) AS bookings, {pct('pft', 'rev')} AS gpm, least(rev, pft) AS low, greatest(rev, pft) AS high,
  CASE WHEN week % 5 <> 0 THEN CAST(cnt AS DOUBLE) END AS gaps, {dec('rev', 1)} AS per_day FROM weekly"""))
def parse_report_number(spark, folder):
    table = class_weekly(spark, folder)
    gpm, ends = percent("pft", "rev"), [F.format_number(f("rev", "pft"), 2) for f in (F.least, F.greatest)]
    text = table.select(
        "ctype", "week",
        F.concat(F.format_number("cnt", 0), F.lit("명")).alias("bookings"),
        F.coalesce(F.concat(F.when(gpm > 0, "+").otherwise(""), F.format_number(gpm, 1), F.lit("%")), F.lit("-")).alias("gpm"),
        F.concat(ends[0], F.lit("~"), ends[1], F.lit("%")).alias("span"),
        F.when(F.col("week") % 5 == 0, "-").otherwise(F.col("cnt").cast("string")).alias("gaps"),
        F.concat(F.format_number(F.round(F.col("rev").cast("decimal(28,6)"), 1), 1), F.lit("명/일")).alias("per_day"),
    )
    span = parse_range(F.col("span"))
    return text.select(
        "ctype", "week", parse_number(F.col("bookings")).alias("bookings"), parse_number(F.col("gpm")).alias("gpm"),
        span["low"].alias("low"), span["high"].alias("high"), parse_number(F.col("gaps")).alias("gaps"),
        parse_number(F.col("per_day")).alias("per_day"))


@catalog.add("policy_name_attributes", """
SELECT p_partkey AS policy_id, CASE WHEN p_size % 3 <> 0 THEN p_size END AS days, CASE WHEN p_size % 3 = 1 THEN p_size - 1 END AS nights,
  CAST(1000 * (9 + p_partkey % 400) AS BIGINT) AS price, CASE WHEN p_size % 4 = 0 THEN CAST(p_partkey % 100 AS INTEGER) END AS discount_pct,
  CASE p_partkey % 4 WHEN 0 THEN 'weekday' WHEN 1 THEN 'weekend' WHEN 2 THEN 'weekday' END AS day_type
FROM part""")
def policy_name_attributes_query(spark, folder):
    size, key = F.col("p_size"), F.col("p_partkey")
    price = 9 + key % 400
    name = F.concat(
        F.lit("["), F.col("p_name"), F.lit("] "),
        F.when(size % 3 == 1, F.concat((size - 1).cast("string"), F.lit("박"))).otherwise(""),
        F.when(size % 3 != 0, F.concat(size.cast("string"), F.lit("일 "))).otherwise(""),
        F.when(key % 2 == 0, F.concat(F.format_number(price * 1000, 0), F.lit("원")))
        .otherwise(F.concat(price.cast("string"), F.lit("K"))),
        F.when(size % 4 == 0, F.concat(F.lit(" "), (key % 100).cast("string"), F.lit("%"))).otherwise(""),
        F.when(key % 4 == 0, " (주중)").when(key % 4 == 1, " (주말)").when(key % 4 == 2, " 평일 전용").otherwise(""),
    )
    policies = read_table(spark, folder, "part").select(key.alias("policy_id"), name.alias("name"))
    return policies.select("policy_id", *[c.alias(a) for a, c in policy_name_attributes(F.col("name")).items()])
