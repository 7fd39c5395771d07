"""The streaming rollup, the batch refresh, the text source, and SQL over the views."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from couponlens.catalog import params as P
from couponlens.operators import kpi
from couponlens.operators.lookups import lookup_policy_one
from couponlens.plans.refresh import driver_settings, last_published, main, run_refresh
from couponlens.session import shared_folder
from couponlens.sinks.report_files import MONTH, changed_months, diff_months, read_digests, read_monthly, snapshot_diff, write_monthly
from couponlens.sources.sectioned_text import read_lines, section_cells, split_sectioned_text
from couponlens.sources.tables import SCHEMAS, booking_columns, read_bookings, read_coupon_tables, read_profit_fact
from couponlens.sources.views import register_views
from couponlens.streaming.rollup import batch_daily_rollup, read_rollup, run_rollup, store_batch

ARGS = {"ts": "created_at", "id": "booking_id", "group": "division"}


def write_events(spark, data, path, first, last):
    day = F.to_date("ts")
    spark.read.parquet(f"{data}/events.parquet").filter(day.between(first, last)).coalesce(1).write.mode("append").parquet(path)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@contextmanager
def changed(spark, settings):
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stream_equals_batch_on_emitted_days(spark, data, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def advance():
        return run_rollup(spark, source, SCHEMAS["events"], booking_columns, delay="1 day", out=out, checkpoint=mark, **ARGS)

    batch = batch_daily_rollup(read_bookings(spark, data), **ARGS)
    write_events(spark, data, source, date(2024, 1, 1), date(2024, 1, 10))
    first = as_set(advance())
    assert max(r[0] for r in first) == date(2024, 1, 8)
    assert first == as_set(batch.filter("event_date <= DATE '2024-01-08'"))

    # A second delivery repeats the last day, and a third repeats a day that was complete.
    write_events(spark, data, source, date(2024, 1, 10), date(2024, 1, 20))
    assert as_set(advance()) == as_set(batch.filter("event_date <= DATE '2024-01-18'"))
    write_events(spark, data, source, date(2024, 1, 2), date(2024, 1, 2))
    write_events(spark, data, source, date(2024, 1, 20), date(2024, 1, 30))
    assert as_set(advance()) == as_set(batch.filter("event_date <= DATE '2024-01-28'"))


@pytest.mark.parametrize("newest_first", [False, True])
def test_backlog_in_batches_equals_the_batch(spark, data, tmp_path, newest_first):
    """Four files, one to a batch, the newest first as well: the table is whole."""
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    days = [(date(2024, 1, 1), date(2024, 1, 10)), (date(2024, 1, 8), date(2024, 1, 15)), (date(2024, 1, 11), date(2024, 1, 20)), (date(2024, 1, 21), date(2024, 1, 30))]
    for n, (first, last) in enumerate(reversed(days) if newest_first else days):
        write_events(spark, data, source, first, last)
        for path in (tmp_path / "in").glob("*.parquet"):
            if path.stat().st_mtime > 1e8:  # not yet dated; the source takes files by their dates
                os.utime(path, (1e6 * (n + 1),) * 2)

    def run():
        return run_rollup(spark, source, SCHEMAS["events"], booking_columns, delay="1 day", out=out, checkpoint=mark, files_per_trigger=1, **ARGS)

    want = as_set(batch_daily_rollup(read_bookings(spark, data), **ARGS).filter("event_date <= DATE '2024-01-28'"))
    assert as_set(run()) == want and as_set(run()) == want
    assert len(list((tmp_path / "out" / "arrivals").glob("batch=*"))) == 4


def test_late_rows_correct_their_day_and_no_other(spark, tmp_path):
    """A booking for a day that was complete changes it; other days are not written again; a batch that is run again, and a row
    that comes again, change nothing; rows without a time are left out."""
    out = str(tmp_path / "out")

    def arrivals(*rows):
        return spark.createDataFrame([(datetime(2024, 1, *r[:2]) if r[0] else None, r[2], "g", Decimal(r[3]), date(2024, 1, r[0]) if r[0] else None) for r in rows],
                                     "event_time timestamp_ntz, booking_id long, division string, revenue decimal(18,4), event_date date")

    def files():
        return {p.name for p in (tmp_path / "out" / "days").glob("event_date=2024-01-02/*.parquet")}

    def table():
        return {(r.event_date.day, r.cnt, r.rev) for r in read_rollup(spark, out, "division", "string", "1 day").collect()}

    store_batch(arrivals((1, 5, 1, 10), (1, 6, 2, 20), (2, 1, 3, 5), (4, 3, 4, 1)), 0, out, "booking_id", "division")
    assert table() == {(1, 2, 30.0), (2, 1, 5.0)}
    before = files()
    late = arrivals((1, 7, 9, 7), (1, 5, 1, 10), (None, 0, 8, 3))
    for _ in range(2):
        store_batch(late, 1, out, "booking_id", "division")
        assert table() == {(1, 3, 37.0), (2, 1, 5.0)} and files() == before
    store_batch(late.limit(0), 2, out, "booking_id", "division")
    assert table() == {(1, 3, 37.0), (2, 1, 5.0)}


def test_stream_folders_come_in_pairs(spark, tmp_path):
    with pytest.raises(ValueError):
        run_rollup(spark, "x", SCHEMAS["events"], booking_columns, delay="1 day", out=str(tmp_path), **ARGS)


def test_shared_folder_follows_the_session():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/place/"})
    assert shared_folder(session) == "/shared/place"


def refresh(spark, data, out, as_of, minute):
    return run_refresh(spark, read_profit_fact(spark, data), read_coupon_tables(spark, data), out, as_of,
                       driver_settings(), datetime(2026, 4, 1, 9, minute))


def test_refresh_publishes_only_changes(spark, data, tmp_path):
    out = str(tmp_path)
    assert last_published(spark, out) is None
    first = refresh(spark, data, out, date(1998, 12, 1), 0)
    assert first["published"] and first["status"] == "ok" and first["weeks"] == 49 and first["updated"] == "1998.12.01"
    again = refresh(spark, data, out, date(1998, 12, 1), 1)
    assert not again["published"] and last_published(spark, out) == first["run"]
    later = refresh(spark, data, out, date(1998, 12, 8), 2)
    assert later["published"] and last_published(spark, out) == later["run"]

    series = spark.read.json(f"{later['run']}/weekly_series").first()
    assert len(series["week"]) == later["weeks"] and series["week"] == sorted(series["week"])
    assert series["label"][0].startswith("W1\n") and len(series["eb_rev"]) == later["weeks"]
    records = spark.read.json(f"{later['run']}/daily_records")
    assert records.count() == later["nc_days"] and {"c18", "r80", "date"} <= set(records.columns)


def test_unchanged_months_are_not_read(spark, tmp_path, rows):
    """Digests tell which months differ, in whatever order rows stand; only their files are compared."""
    lines = [("a", date(2024, 1, d), d, None) for d in range(1, 20)] + [("b", date(2024, 2, d), None, float(d)) for d in range(1, 9)] + [("c", None, 1, 1.0)]
    schema = "k string, day date, n int, x double"
    moved = [r for r in lines if r[2] != 5] + [("a", date(2024, 1, 5), None, 5.0), ("d", date(2024, 3, 1), 1, 1.0)]
    places = [str(tmp_path / n) for n in ("old", "same", "new")]
    for path, some in zip(places, (lines, lines[::-1], moved)):
        write_monthly(spark.createDataFrame(some, schema).repartition(3), "day", path)
    old, same, new = (read_monthly(spark, p) for p in places)
    assert changed_months(read_digests(spark, places[1]), read_digests(spark, places[0])) == []
    months = changed_months(read_digests(spark, places[2]), read_digests(spark, places[0]))
    assert months == ["2024-01", "2024-03"]
    diff = diff_months(new, old, months)
    assert sorted(map(str, rows(diff))) == sorted(map(str, rows(snapshot_diff(new.drop(MONTH), old.drop(MONTH))))) and diff.count() == 3
    text = diff._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(re.findall(r"PartitionFilters: \[.*2024-01.*2024-03", text)) == 2 and "2024-02" not in text
    assert set(diff.select("day").distinct().toPandas()["day"]) == {date(2024, 1, 5), date(2024, 3, 1)} and diff_months(new, old, []).isEmpty()


def test_refresh_command_on_canonical_tables(spark, tmp_path, capsys, rows):
    """The job with its default settings, from stored tables to the published files."""
    from couponlens.sources.tables import COUPON_TABLES, PROFIT_FACT

    def won(value):
        return Decimal(value)

    fact = [
        (1, datetime(2026, 1, 1, 9), 7, "미리예약 2일 109,000원", "NORMAL", won(240_000_000), won(159_000_000), won(73_000_000)),
        (2, datetime(2025, 12, 29, 9), 8, "땡처리", "SUPER_DEAL_CLOSING_SALE", won(115_000_000), won(59_000_000), won(-32_000_000)),
        (3, datetime(2026, 1, 6, 9), 9, "[4월 당일최저가] 9,900원", "TARGET", won(1_000_000), won(1), won(1)),
        (4, datetime(2026, 1, 1, 9), 10, "8~24시간 50%", "NORMAL", won(9), won(9), won(9)),
        (5, datetime(2026, 3, 31, 0), 7, "미리예약 2일 109,000원", "NORMAL", won(9), won(9), won(9)),
    ]
    tables = {
        "reservation": [(1, datetime(2026, 3, 25, 15), "round", 0, 1), (2, datetime(2026, 3, 26, 20), "d2d_rev", 9, 3),
                        (3, datetime(2026, 3, 26, 20), "round", 5, 3)],
        "coupon": [(1, 16264, 1), (2, 16271, 1), (3, 16264, 1)],
        "policy": [(16264, "2일 109K"), (16271, "5일 249K")],
        "charge": [(1, won(220_000), "rent"), (1, won(11_000), "protection_fee"), (2, won(1_100_000), "rent"), (3, won(5), "rent")],
        "payment": [(1, won(110_000), "promotion"), (2, won(5_000), "oil_discount_refund"), (2, won(9), "card")],
    }
    data, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame(fact, PROFIT_FACT).write.parquet(f"{data}/profit_fact.parquet")
    for name, lines in tables.items():
        spark.createDataFrame(lines, COUPON_TABLES[name]).write.parquet(f"{data}/{name}.parquet")
    main(["--data", data, "--out", out, "--as-of", "2026-03-31"])
    assert '"published": true' in capsys.readouterr().out
    run = last_published(spark, out)
    series = spark.read.json(f"{run}/weekly_series").first().asDict()
    assert series["week"] == [1, 2] and series["label"] == ["W1\n01-01", "W2\n01-06"]
    assert (series["eb_rev"], series["eb_cm"], series["eb_pft"], series["eb_cnt"]) == ([2.4, 0.0], [1.59, 0.0], [0.73, 0.0], [1, 0])
    assert (series["sd_rev"], series["sd_pft"], series["sd_cnt"]) == ([1.15, 0.01], [-0.32, 0.0], [1, 1])
    records = sorted(rows(spark.read.json(f"{run}/daily_records")), key=lambda r: r["date"])
    assert [(r["date"], r["c16264"], r["r16264"], r["c16271"], r["r16271"]) for r in records] == [
        ("03/26", 1, 0.11, 0, 0.0), ("03/27", 0, 0.0, 1, 1.0)]
    assert len(records[0]) == 18


def plain_sections(text: str) -> list[tuple]:
    """Rows of a report, line by line: line_no, section_no, section, kind, row, col, header, value."""
    out, number, name, header, rows, notes, before = [], 0, None, None, 0, 0, ""
    for at, line in enumerate(re.split("\r\n|\r|\n", text), start=1):
        title = re.match(r"^(\d+)\.\s*(.*)$", line)
        if title and not before.strip(" ") and "\t" not in line:
            number, name, header, rows, notes = int(title[1]), title[2], None, 0, 0
        elif "\t" in line and not line.startswith("→"):
            cells = line.split("\t")
            if header is None:
                header = cells
            else:
                rows += 1
                out += [(at, number, name, "data", rows, i + 1, header[i] if i < len(header) else None, x) for i, x in enumerate(cells)]
        elif line.strip(" "):
            notes += 1
            out.append((at, number, name, "title" if name is None else "note", notes, 1, None, line.removeprefix("→").strip(" ")))
        before = line
    return out


# The shape of the two published reviews: a title, tables of several widths, cells of free text, notes, a section of one
# sentence. Then what may also come: tables that go on behind blank lines, loose lines, numbers that are no titles.
REVIEW = "\n\n".join([
    "첫 리뷰 (25Q1 vs 26Q1)", "1. 구조 전환 요약\n항목\t25Q1\t26Q1\t변화\n유입 규모\t10,082명\t4,811명\t-52.3%\n건당매출\t86,136원\t73,553원\t-14.6%",
    "2. 실제 이용시간 분포\n실제 이용시간\t건수\t비중\n~4h\t9,379\t83%\n24h+\t113\n8~24h\t합산\t4%\t-\n→ 83%가 4시간 미만 이용",
    "5. 진단\n구분\t내용\n변화\t\"50% 아니면 안 쓴다\" 유저 → 해소\n향후 과제\t34,900~39,900원 밴드", "10. 한 줄 정리\n시간그룹 분리는 구조적 진보."])
LOOSE = "Title\nsecond line\na\tb\nc\td\n\n1. First\nname\tvalue\nx\t1\n2. not a title\n\n \ny\t2\n\nloose\n→ arrow\twith a tab\n\n3.\n\n2.x\ty\nz\tw\n\n\n12. End"


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("block", ["16b", "300b", "128m"])
def test_sections_from_files(spark, tmp_path, ends, block):
    """Every line keeps its section, number and header wherever the file is split."""
    table = "\n".join(f"item {i}\t{i}" + "\n" * (i % 7 == 0) for i in range(120))
    texts = {
        "review": REVIEW + "\n", "loose": LOOSE, "long": f"Long\n\n1. First\nname\tvalue\n{table}\n→ a note\n\n2. Second\nname\tvalue\nx\t1",
        "empty": "", "blank": "\n\n", "bare": "k\tv\n1\t2"}
    for name, text in texts.items():
        (tmp_path / f"{name}.tsv").write_bytes(text.replace("\n", ends).encode())
    with changed(spark, {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "0"}):
        lines = read_lines(spark, str(tmp_path))
        got = [tuple(r) for r in section_cells(lines).collect()]
        if block == "16b":
            assert lines.filter("file LIKE '%long%'").select("block").distinct().count() > 20
    for name, text in texts.items():
        mine = sorted((r[1:] for r in got if r[0].endswith(f"/{name}.tsv")), key=lambda r: (r[0], r[5]))
        assert mine == plain_sections(text)
    back = {}
    for row in sorted((r for r in got if "review" in r[0]), key=lambda r: (r[1], r[6])):
        back.setdefault(row[1], []).append(("→ " if "83%가" in row[-1] else "") + row[-1])
    source = {i: x for i, x in enumerate(REVIEW.split("\n"), start=1)}
    assert {i: "\t".join(x) for i, x in back.items()} == {i: source[i] for i in back} and len(back) == 10


def test_sections_of_no_file(spark):
    table = spark.createDataFrame([("a", None), ("b", "")], "f string, t string")
    assert split_sectioned_text(table, "f", "t").count() == 0 and split_sectioned_text(table.limit(0), "f", "t").count() == 0


WEEKLY_SQL = """
WITH labelled AS (
  SELECT *, to_date(return_at) AS day,
    CASE WHEN contains(coupon_policy_name, 'ring') THEN 'eb'
         WHEN coupon_policy_division IN ('PROMO', 'ECONOMY') OR coupon_policy_name RLIKE 'bolt|rod' THEN 'sd' END AS ctype
  FROM profit_fact WHERE coupon_policy_id IS NOT NULL
)
SELECT weekofyear(day) AS week, min(day) AS week_start, ctype, count(DISTINCT reservation_id) AS cnt,
  CAST(round(sum(revenue) / 1e4, 2) AS DOUBLE) AS rev, CAST(round(sum(contribution_margin) / 1e4, 2) AS DOUBLE) AS cm,
  CAST(round(sum(profit) / 1e4, 2) AS DOUBLE) AS pft
FROM labelled WHERE ctype IS NOT NULL AND day BETWEEN DATE '1997-12-29' AND DATE '1998-11-30'
GROUP BY weekofyear(day), ctype"""

CREATION_SQL = """
WITH gross AS (
  SELECT reservation_id, sum(amount) AS gross FROM (
    SELECT reservation_id, amount FROM charge WHERE charge_type IN ('rent', 'refund', 'protection_fee')
    UNION ALL SELECT reservation_id, -amount FROM payment WHERE paid_type = 'coupon')
  GROUP BY reservation_id
),
used AS (
  SELECT r.id, to_date(convert_timezone('UTC', 'Asia/Seoul', r.created_at)) AS create_date, i.policy_id AS pid
  FROM reservation AS r JOIN coupon_issue AS i ON i.reservation_id = r.id
  WHERE r.way < '4' AND r.member_imaginary IN (0, 9) AND r.state < 4 AND i.policy_id BETWEEN 4 AND 403
    AND EXISTS (SELECT 1 FROM coupon_policy AS p WHERE p.id = i.policy_id)
)
SELECT create_date, pid, count(DISTINCT used.id) AS cnt,
  CAST(round(CAST(sum(coalesce(gross, 0)) / 1100D AS DECIMAL(28,6)), 2) AS DOUBLE) AS net_rev_m
FROM used LEFT JOIN gross ON gross.reservation_id = used.id
WHERE create_date >= DATE '1996-01-01' GROUP BY create_date, pid"""

LOOKUP_SQL = """
SELECT id, coalesce((SELECT i.policy_id FROM coupon_issue AS i JOIN coupon_policy AS p ON p.id = i.policy_id WHERE i.reservation_id = reservation.id), 0) AS pid
FROM reservation"""


def test_sql_over_the_views_gives_the_same_rows(spark, data):
    register_views(spark, data)
    weekly = kpi.weekly_class_kpi(read_profit_fact(spark, data), P.RULES, P.YEAR, P.AS_OF, P.CLASS_UNIT)
    assert as_set(spark.sql(WEEKLY_SQL)) == as_set(weekly)
    tables = read_coupon_tables(spark, data)
    daily = kpi.new_coupon_daily(tables, P.POLICY_IDS, P.VALID, P.LEDGER, unit=P.DAY_UNIT)
    assert as_set(spark.sql(CREATION_SQL)) == as_set(daily)


def test_creation_days_count_reservations_of_all_policies(spark, tmp_path):
    """Policies far from the campaign's ids count too; one that does not exist, and an invalid reservation, do not."""
    import duckdb

    import __spark_entry__ as entry

    customers = [10, 199, 210, 5000, 7009, 7010, 7019, 9999, 5001]
    given = {
        "part": [(2 * c, f"policy {c}", "b", "t", 1, 1.0) for c in customers if c != 9999],
        "orders": [(k, c, "F", 1.0, datetime(1997, 3, 1 + k % 4, 3), "1-URGENT") for k, c in enumerate(customers)],
        "lineitem": [(1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "F", datetime(1997, 4, 1))],
    }
    con = duckdb.connect()
    for name, lines in given.items():
        spark.createDataFrame(lines, SCHEMAS[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    # coupons that repeat, by repeated orders, count once
    spark.createDataFrame(given["orders"][:3], SCHEMAS["orders"]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    got = sorted(map(tuple, entry.queries()["creation_day_counts"](spark, str(tmp_path)).collect()))
    assert got == [(2, 2), (3, 2), (4, 2), (5, 1)]  # local days are a day later
    assert got == sorted(con.execute(entry.oracle_sql()["creation_day_counts"]).fetchall())


def test_scalar_subquery_gives_the_same_lookup(spark):
    """Spark plans the subquery as a nested loop, so this runs on the smallest tables only."""
    data = "/root/testdata/sf0.001"
    register_views(spark, data)
    tables = read_coupon_tables(spark, data)
    found = lookup_policy_one(tables["reservation"], tables["coupon"], tables["policy"]).select("id", "pid")
    assert as_set(spark.sql(LOOKUP_SQL)) == as_set(found)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul"])
def test_results_do_not_depend_on_the_session_zone(spark, data, zone):
    import oracle

    import __spark_entry__ as entry

    con, sql = oracle.connect(data), entry.oracle_sql()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for key in ("weekly_class_kpi", "new_coupon_daily", "inflow_compare", "bucket_leadtime", "by_hour", "monthly_trend",
                    "report_first_week", "incremental_daily_rollup"):
            assert oracle.difference(entry.queries()[key](spark, data), con, sql[key]) is None, key
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_spans_across_a_clock_change(spark):
    from couponlens.functions.dates import micros_between

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        span = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 00:00:00' AS a, TIMESTAMP_NTZ '2024-03-11 00:00:00.000001' AS b")
        assert span.select(micros_between(F.col("a"), F.col("b"))).first()[0] == 86_400_000_001
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_behavior_page_from_one_pass(spark, data):
    """Every table of the page equals the query on the bookings themselves, and none of them reads the bookings again."""
    import __spark_entry__ as entry
    from couponlens.plans.reports import behavior_page

    page = behavior_page(read_bookings(spark, data), P.RATES, P.DAY_UNIT)
    same = {
        "leadtime": "bucket_leadtime", "duration": "bucket_duration", "weekday": "by_weekday", "hour": "by_hour",
        "heatmap_count": "heatmap_count", "heatmap_rpu": "heatmap_rpu", "heatmap_levels": "intensity_minmax",
        "month": "monthly_trend", "discount_matrix": "timegroup_discount_matrix", "discount_migration": "discount_migration",
    }
    assert set(same) == set(page)
    for table, key in same.items():
        direct = entry.queries()[key](spark, data)
        assert page[table].columns == direct.columns and as_set(page[table]) == as_set(direct), table
        text = page[table]._jdf.queryExecution().executedPlan().toString()
        assert "staged-" in text and "events.parquet" not in text, table


def test_division_page(spark, data):
    import __spark_entry__ as entry
    from couponlens.operators.periods import label_table
    from couponlens.plans.reports import division_page

    fact = read_profit_fact(spark, data)
    page = division_page(fact, P.WEEK, label_table(fact, P.LABELS), ["PROMO", "ECONOMY"], 10.0, P.DAY_UNIT)
    same = {
        "cards": "report_overview_cards", "divisions": "report_division_table", "week_over_week": "report_wow",
        "new_policies": "policies_new", "ended_policies": "policies_ended", "top_shift": "top_revenue_shift",
        "daily_sum": "sum_two_series",
    }
    for table, key in same.items():
        direct = entry.queries()[key](spark, data)
        assert as_set(page[table].select(*direct.columns)) == as_set(direct), table
    assert page["daily"].filter("is_total = 1").count() == 2


def test_division_page_across_a_year(spark, data):
    """Week 1 against week 53, from one stored table and one read of the fact."""
    import duckdb

    from couponlens.catalog.sqlkit import PF, q
    from couponlens.operators.periods import label_table
    from couponlens.plans.reports import division_page
    from couponlens.session import stage

    fact, staged = read_profit_fact(spark, data), []
    page = division_page(fact, (1993, 1), label_table(fact, P.LABELS), ["PROMO", "ECONOMY"], 10.0, P.DAY_UNIT, stage=lambda df: staged.append(stage(df)) or staged[-1])
    assert len(staged) == 1
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    of = f"SELECT {{}} AS k, {q('sum(revenue)', '1e3', 1)} AS rev, count(DISTINCT reservation_id) AS cnt FROM pf WHERE return_date BETWEEN DATE '{{}}' AND DATE '{{}}' {{}} GROUP BY 1"
    weeks = ("1993-01-04", "1993-01-10"), ("1992-12-28", "1993-01-03")
    by = {(k, d): con.execute(f"WITH {PF} " + of.format(k, *d, "AND coupon_policy_id IS NOT NULL")).fetchall() for k in ("coupon_policy_id", "coupon_policy_division") for d in weeks}
    divisions = [{k: (r, c) for k, r, c in con.execute(f"WITH {PF} " + of.format("coupon_policy_division", *d, "")).fetchall()} for d in weeks]
    got = {r.division: r for r in page["week_over_week"].collect() if r.label != "total"}
    assert {d: ((r.cur_rev, r.cur_cnt), (r.prev_rev, r.prev_cnt)) for d, r in got.items()} == {d: (divisions[0][d], divisions[1].get(d, (0, 0))) for d in divisions[0]}
    policies = [{k for k, _, _ in by["coupon_policy_id", d]} for d in weeks]
    assert {r.policy_id for r in page["new_policies"].collect()} == policies[0] - policies[1]
    assert {r.policy_id for r in page["ended_policies"].collect()} == policies[1] - policies[0]
    assert {r.return_date for r in page["daily"].filter("is_total = 0").collect()} <= {date(1993, 1, d) for d in range(4, 11)}
