"""Pieces of DuckDB SQL: the canonical views and the rounding rules, written independently of the Spark side."""

from __future__ import annotations

PF = """
pf_base AS (
  SELECT lineitem.*, part.*,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS price,
    CAST(l_quantity AS DECIMAL(8,2)) AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
pf AS (
  SELECT l_orderkey AS reservation_id, l_shipdate AS return_at, CAST(l_shipdate AS DATE) AS return_date,
    CASE WHEN p_size % 10 = 0 THEN NULL ELSE l_partkey END AS coupon_policy_id, p_name AS coupon_policy_name,
    p_type AS coupon_policy_division, price AS revenue, price - qty * 500 AS cm, price - qty * 1300 AS profit,
    CASE WHEN p_name LIKE '%ring%' THEN 'eb' WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'sd'
         WHEN p_name LIKE '%bolt%' THEN 'sd' WHEN p_name LIKE '%rod%' THEN 'sd' ELSE 'other' END AS ctype,
    CAST(date_part('week', l_shipdate) AS INTEGER) AS week, date_part('isoyear', l_shipdate) AS iso_year
  FROM pf_base
),
camp AS (
  SELECT * FROM pf WHERE coupon_policy_id IS NOT NULL AND (coupon_policy_name LIKE '%ring%'
    OR coupon_policy_name LIKE '%bolt%' OR coupon_policy_name LIKE '%rod%'
    OR coupon_policy_division IN ('PROMO', 'ECONOMY'))
)"""

CP = """
reservation AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, o_orderdate + INTERVAL 15 HOUR AS created_at,
    CAST(o_orderdate + INTERVAL 15 HOUR + INTERVAL 9 HOUR AS DATE) AS create_date, o_orderpriority AS way,
    CAST(o_custkey % 10 AS INTEGER) AS member_imaginary,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 4 END AS state,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount
  FROM orders
),
valid AS (
  SELECT * FROM reservation WHERE way IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND member_imaginary IN (0, 9)
    AND state IN (1, 2, 3) AND create_date >= DATE '1996-01-01'
),
coupon AS (
  SELECT o_orderkey AS reservation_id, 2 * o_custkey AS policy_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS state
  FROM orders
),
policy AS (SELECT p_partkey AS id, p_name AS name FROM part),
charge AS (
  SELECT l_orderkey AS reservation_id,
    CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
    CASE l_returnflag WHEN 'R' THEN 'rent' WHEN 'A' THEN 'refund' WHEN 'N' THEN 'protection_fee' ELSE 'other' END AS charge_type
  FROM lineitem
),
payment AS (
  SELECT l_orderkey AS reservation_id,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS amount,
    CASE WHEN l_linestatus = 'F' THEN 'coupon' ELSE 'card' END AS paid_type
  FROM lineitem
),
issued AS (SELECT c.*, p.name AS coupon_name FROM coupon AS c JOIN policy AS p ON c.policy_id = p.id)"""

BK = """
bk_base AS (
  SELECT event_id AS booking_id, user_id, event_type AS division, ts AS created_at,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(value AS DECIMAL(10,2)) AS amount
  FROM events
),
bk_times AS (
  SELECT *, created_at + to_seconds(CAST(amount * 7200 AS BIGINT)) AS start_at,
    created_at + to_seconds(CAST(amount * 7200 AS BIGINT)) + to_hours(k) AS end_at,
    CAST(CAST(amount * (k + 1) AS DECIMAL(18,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS revenue
  FROM bk_base
),
bk AS (
  SELECT *, CASE WHEN division = 'error' THEN 0 ELSE 1 END AS state, 40 + 5 * (k % 3) AS discount_rate,
    user_id AS policy_id,
    CAST(round(revenue * (k - 40) * CAST(0.01 AS DECIMAL(3,2)), 4) AS DECIMAL(18,4)) AS profit,
    epoch_us(start_at) - epoch_us(created_at) AS lead_us, epoch_us(end_at) - epoch_us(start_at) AS duration_us,
    CAST(end_at AS DATE) AS end_date, dayofweek(start_at) + 1 AS dow, hour(start_at) AS hr,
    strftime(start_at, '%Y-%m') AS month
  FROM bk_times
),
bkb AS (
  SELECT *,
    CASE WHEN lead_us < 3600000000 THEN '<1h' WHEN lead_us < 86400000000 THEN '1h-1d'
         WHEN lead_us < 259200000000 THEN '1-3d' WHEN lead_us < 604800000000 THEN '3d-1w'
         WHEN lead_us < 1209600000000 THEN '1-2w' WHEN lead_us < 2419200000000 THEN '2-4w' ELSE '4w+' END AS lead_bucket,
    CASE WHEN k < 4 THEN '<4h' WHEN k < 8 THEN '4-8h' WHEN k < 24 THEN '8-24h' WHEN k < 48 THEN '1 night'
         WHEN k < 72 THEN '2 nights' ELSE '3d+' END AS dur_bucket,
    CASE WHEN k < 4 THEN '~4h' WHEN k < 8 THEN '4~8h' WHEN k < 24 THEN '8~24h' ELSE '24h+' END AS time_group,
    CASE WHEN hr >= 6 AND hr < 10 THEN '06-10' WHEN hr >= 10 AND hr < 14 THEN '10-14'
         WHEN hr >= 14 AND hr < 18 THEN '14-18' WHEN hr >= 18 AND hr < 22 THEN '18-22' ELSE '22-06' END AS block
  FROM bk
)"""

WEEKDAY = "CASE dow WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue' WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' ELSE 'Sat' END"


def dec(value: str, scale: int) -> str:
    """Half-up rounding of a double or decimal by way of twelve decimals, as double."""
    return f"CAST(CAST(CAST({value} AS DECIMAL(38,12)) AS DECIMAL(38,{scale})) AS DOUBLE)"


def q(num: str, den: str, scale: int, factor: int = 1) -> str:
    top = f"CAST({num} AS DOUBLE)" + (f" * {factor}" if factor != 1 else "")
    return dec(f"{top} / NULLIF(CAST({den} AS DOUBLE), 0)", scale)


def pct(num: str, den: str, scale: int = 1) -> str:
    return q(num, den, scale, 100)


def sub(a: str, b: str, scale: int = 1) -> str:
    return dec(f"({a}) - ({b})", scale)


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


def weekly(unit: str = "1e4", as_of: str = "1998-12-01", name: str = "weekly") -> str:
    """The weekly class table as a CTE."""
    return f"""
{name} AS (
  SELECT week, min(return_date) AS week_start, ctype, count(DISTINCT reservation_id) AS cnt,
    {q('sum(revenue)', unit, 2)} AS rev, {q('sum(cm)', unit, 2)} AS cm, {q('sum(profit)', unit, 2)} AS pft
  FROM camp WHERE iso_year = 1998 AND return_date <= DATE '{as_of}' - INTERVAL 1 DAY
  GROUP BY week, ctype
)"""


def rollup(keys: str, name: str, where: str = "TRUE", source: str = "pf", unit: str = "1e3") -> str:
    """Revenue, profit and reservations by keys as a CTE."""
    return f"""
{name} AS (
  SELECT {keys}, {q('sum(revenue)', unit, 1)} AS rev, {q('sum(profit)', unit, 1)} AS profit,
    count(DISTINCT reservation_id) AS cnt
  FROM {source} WHERE {where} GROUP BY ALL
)"""


TWO_WEEKS = "return_date BETWEEN DATE '1998-03-30' AND DATE '1998-04-12'"
THIS_WEEK = "return_date BETWEEN DATE '1998-04-06' AND DATE '1998-04-12'"


def paired(source: str, key: str, measures: tuple[str, ...] = ("rev", "profit", "cnt"), name: str = "paired") -> str:
    """Weeks 15 and 14 side by side, by a full join, as a CTE."""
    values = ", ".join(f"c.{m} AS cur_{m}, p.{m} AS prev_{m}" for m in measures)
    return f"""
{name} AS (
  SELECT coalesce(c.{key}, p.{key}) AS {key}, {values}, c.{key} IS NOT NULL AS in_cur, p.{key} IS NOT NULL AS in_prev
  FROM (SELECT * FROM {source} WHERE week = 15) AS c
  FULL JOIN (SELECT * FROM {source} WHERE week = 14) AS p ON c.{key} = p.{key}
)"""


def filled(source: str, key: str, name: str = "f") -> str:
    values = ", ".join(f"coalesce({s}_{m}, 0) AS {s}_{m}" for s in ("cur", "prev") for m in ("rev", "profit", "cnt"))
    return f"{name} AS (SELECT {key}, in_cur, in_prev, {values} FROM {source})"


def gpm_raw(side: str, guard: bool = True) -> str:
    ratio = f"CAST({side}_profit AS DOUBLE) * 100 / NULLIF({side}_rev, 0)"
    return f"coalesce({ratio}, 0)" if guard else ratio


DELTAS = f"""{sub('cur_rev', 'prev_rev')} AS d_rev, {pct('(cur_rev - prev_rev)', 'prev_rev')} AS d_rev_pct,
  {sub('cur_profit', 'prev_profit')} AS d_profit, cur_cnt - prev_cnt AS d_cnt"""


def wow_select(key: str) -> str:
    return f"""SELECT {key}, prev_rev, cur_rev, prev_profit, cur_profit, prev_cnt, cur_cnt, {DELTAS},
  {dec(gpm_raw('prev'), 1)} AS prev_gpm, {dec(gpm_raw('cur'), 1)} AS cur_gpm,
  {dec(gpm_raw('cur') + ' - ' + gpm_raw('prev'), 1)} AS d_gpm
FROM f WHERE in_cur"""


def exact(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


def wow_total(source: str = "f") -> str:
    sums = ", ".join(f"{exact(f'{s}_{m}')} AS {s}_{m}" for s in ("prev", "cur") for m in ("rev", "profit"))
    return f"""SELECT prev_rev, cur_rev, prev_profit, cur_profit, prev_cnt, cur_cnt, {DELTAS},
  {dec(gpm_raw('prev', False), 1)} AS prev_gpm, {dec(gpm_raw('cur', False), 1)} AS cur_gpm,
  {dec(gpm_raw('cur', False) + ' - ' + gpm_raw('prev', False), 1)} AS d_gpm
FROM (SELECT {sums}, CAST(sum(prev_cnt) AS BIGINT) AS prev_cnt, CAST(sum(cur_cnt) AS BIGINT) AS cur_cnt FROM {source})"""


def ledger_daily(named: bool, unit: str = "1e3", name: str = "daily", target: str = " WHERE policy_id BETWEEN 4 AND 403") -> str:
    """Net revenue by creation date and policy as CTEs, with one correlated lookup per value."""
    keys = "create_date, pid, coupon_name" if named else "create_date, pid"
    return f"""
keyed AS (
  SELECT v.id, v.create_date, i.policy_id AS pid, i.coupon_name FROM valid AS v JOIN issued AS i ON i.reservation_id = v.id
  WHERE v.id IN (SELECT reservation_id FROM issued{target})
),
rent AS (SELECT reservation_id, sum(amount) AS a FROM charge WHERE charge_type IN ('rent', 'refund') GROUP BY ALL),
fee AS (SELECT reservation_id, sum(amount) AS a FROM charge WHERE charge_type IN ('protection_fee') GROUP BY ALL),
disc AS (SELECT reservation_id, sum(amount) AS a FROM payment WHERE paid_type IN ('coupon') GROUP BY ALL),
priced AS (
  SELECT keyed.*, coalesce(rent.a, 0) + coalesce(fee.a, 0) - coalesce(disc.a, 0) AS gross FROM keyed
  LEFT JOIN rent ON rent.reservation_id = keyed.id LEFT JOIN fee ON fee.reservation_id = keyed.id
  LEFT JOIN disc ON disc.reservation_id = keyed.id
),
{name} AS (
  SELECT {keys}, count(DISTINCT id) AS cnt, {q('sum(gross)', f'(CAST(1.1 AS DOUBLE) * {unit})', 2)} AS net_rev_m
  FROM priced GROUP BY {keys}
)"""
