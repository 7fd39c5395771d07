"""Physical plans: pushdown, pruning, no nested loops or Python, and behaviour under hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from couponlens.operators import mix
from couponlens.sources.tables import read_bookings

BATCH = [k for k in entry.queries() if k != "incremental_daily_rollup"]
ANALYTICS = [k for k in BATCH if k in {k for family in entry._FAMILIES for k in family.queries}]


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_nested_loop_without_broadcast(spark, data, key):
    """With every table too large to broadcast, joins stay hash partitioned and nothing runs in Python."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(entry.queries()[key](spark, data))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", text)
    assert key not in ANALYTICS or "BroadcastHashJoin" not in text


# These two make files of their own: report files to be read, and a stream's table.
WRITES = {"src_report_tsv", "incremental_daily_rollup"}


def test_building_a_query_starts_no_job(spark, data):
    """Queries are plans: nothing is counted, collected or stored while one is put together."""
    spark.sparkContext.setJobGroup("building", "")
    try:
        for key in ANALYTICS:
            if key not in WRITES:
                entry.queries()[key](spark, data)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


CREATION = [
    "new_coupon_daily", "new_coupon_daily_named", "pivot_daily_policy", "snk_daily_records", "revenue_per_booking", "report_creation_detail"]


@pytest.mark.parametrize("key", CREATION)
def test_child_rows_of_other_campaigns_are_dropped_at_the_scan(spark, data, key):
    """Once tables are large, bloom filters of the campaign's reservations stand at the scans of all its child tables."""
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    with settings(spark, **large):
        df = entry.queries()[key](spark, data)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        big = as_rows(df)
    filters = [line for line in text.splitlines() if "might_contain" in line]
    assert sum("l_orderkey" in line for line in filters) >= 2 and any("o_orderkey" in line for line in filters)
    assert "o_custkey#" in text[text.index("bloom_filter_agg"):] and big == as_rows(entry.queries()[key](spark, data))


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_hot_policy_is_split_or_combined(spark, data):
    """Six in ten coupons name one policy, in shuffled joins: counts are combined before the join, and the join by policy
    in front of the lookup is split by Spark."""
    from couponlens.catalog import params as P
    from couponlens.operators import kpi, lookups
    from couponlens.sources.tables import read_coupon_tables

    tables = read_coupon_tables(spark, data)
    coupons = tables["coupon"].unionByName(spark.range(300_000).select((F.col("id") + 1_000_000).alias("reservation_id"), F.lit(18).cast("bigint").alias("policy_id"), F.lit(1).alias("state")))
    plain = {k: as_rows(f(coupons, tables["policy"])) for k, f in (("counts", kpi.issued_counts), ("ids", lambda c, p: lookups.coupon_summary(c, p, P.POLICY_IDS)))}
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    with settings(spark, **small):
        counts = kpi.issued_counts(coupons, tables["policy"])
        assert as_rows(counts) == plain["counts"]
        text = plan(counts).split("== Initial Plan ==")[0]
        assert text.index("SortMergeJoin") < text.index("partial_count")
        summary = lookups.coupon_summary(coupons, tables["policy"], P.POLICY_IDS)
        assert as_rows(summary) == plain["ids"] and "skew=true" in plan(summary)


def test_policies_grow_with_the_data(spark, data):
    from couponlens.sources.tables import read_policies

    folder = data.rsplit("/", 1)[0]
    n = [read_policies(spark, f"{folder}/{sf}").count() for sf in ("sf0.001", "sf0.01")]
    assert n == [spark.read.parquet(f"{folder}/{sf}/part.parquet").count() for sf in ("sf0.001", "sf0.01")] and n[1] == 10 * n[0]


def test_weekly_kpi_pushes_and_prunes(spark, data):
    text = plan(entry.queries()["weekly_class_kpi"](spark, data))
    scan = next(s for s in text.splitlines() if "lineitem.parquet" in s)
    assert "l_tax" not in scan and "l_suppkey" not in scan
    details = entry.queries()["weekly_class_kpi"](spark, data)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(l_shipdate,1997-12-29" in details and "LessThan(l_shipdate,1998-12-01" in details
    assert "StringContains(p_name,ring)" in details


def test_weekly_kpi_combines_before_the_shuffle(spark, data):
    """The shuffle over reservations spreads each class over many tasks, behind a combine by class and reservation."""
    lines = plan(entry.queries()["weekly_class_kpi"](spark, data)).splitlines()
    (at,) = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "reservation_id" in line]
    assert "HashAggregate" in lines[at + 1] and "partial_sum" in lines[at + 1]
    assert "SortAggregate" not in "".join(lines)


def test_second_booking_is_limited_before_the_shuffle(spark, data):
    text = plan(entry.queries()["repeat_transition"](spark, data))
    assert text.index("row_number(), 2, Final") < text.index("Exchange hashpartitioning(user_id") < text.index("row_number(), 2, Partial")


@pytest.mark.parametrize("key", [
    "weekly_class_kpi", "policy_kpi", "division_rollup", "division_daily", "class_daily", "cumulative_cards", "wow_weeks", "report_wow",
    "report_division_daily", "report_overview_cards", "top_revenue_shift", "sum_two_series", "weighted_gpm",
])
def test_the_fact_is_read_and_joined_once(spark, data, key):
    """However many parts a page has, with every join shuffled."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        df = entry.queries()[key](spark, data)
        df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1 and len(re.findall(r"SortMergeJoin|ShuffledHashJoin", final)) <= 1 + (key == "report_wow")


def hot_folder(spark, data, tmp_path):
    """A copy of the tables in which a third of all lines belongs to one policy and one reservation."""
    for name in ("part", "orders"):
        spark.read.parquet(f"{data}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{data}/lineitem.parquet").withColumn("_hot", F.pmod(F.xxhash64(*["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]), F.lit(3)) == 0)
    for column in ("l_orderkey", "l_partkey"):
        lines = lines.withColumn(column, F.when(F.col("_hot"), F.lit(1).cast("bigint")).otherwise(F.col(column)))
    lines.drop("_hot").repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_hot_policy_and_reservation(spark, data, tmp_path):
    import oracle
    import duckdb

    folder = hot_folder(spark, data, tmp_path)
    con = duckdb.connect()
    for name in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    sql = entry.oracle_sql()
    keys = ["weekly_class_kpi", "policy_kpi", "net_revenue", "new_coupon_daily_named", "wow_join", "top_revenue_shift"]
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "512k",
    }
    with settings(spark, **small):
        for key in keys:
            assert oracle.difference(entry.queries()[key](spark, folder), con, sql[key]) is None, key
        for key in ("policy_kpi", "src_profit_fact"):
            df = entry.queries()[key](spark, folder)
            df.collect()
            assert "skew" in plan(df), key


def test_hot_user(spark, data):
    """One user with most bookings: every task still sends at most two rows of that user."""
    bookings = read_bookings(spark, data).withColumn("user_id", F.when(F.col("booking_id") % 3 > 0, 0).otherwise(F.col("user_id")))
    got = mix.repeat_transition(bookings, "user_id", "created_at", "booking_id", "division").agg(F.sum("users")).first()[0]
    users = bookings.groupBy("user_id").count().filter("count > 1").count()
    assert got == users


def test_stored_fact_prunes_months_and_needs_no_join(spark, data, tmp_path):
    from couponlens.catalog import params as P
    from couponlens.operators import kpi
    from couponlens.sources.store import read_fact, write_fact
    from couponlens.sources.tables import read_profit_fact

    fact, path = read_profit_fact(spark, data), f"{tmp_path}/fact"
    write_fact(fact, path)
    stored = read_fact(spark, path)
    assert [f.name for f in stored.schema] == [*fact.columns, "return_month"]
    assert stored.count() == fact.count()
    weekly = kpi.weekly_class_kpi(stored, P.RULES, P.YEAR, P.AS_OF, P.CLASS_UNIT)
    direct = kpi.weekly_class_kpi(fact, P.RULES, P.YEAR, P.AS_OF, P.CLASS_UNIT)
    assert {tuple(r) for r in weekly.collect()} == {tuple(r) for r in direct.collect()}
    text = plan(weekly)
    assert "Join" not in text and "PartitionFilters: [isnotnull(return_month" in text
    files = weekly._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "(return_month#" in files and ">= 1997-12)" in files and "<= 1998-11)" in files


def test_a_month_with_most_rows_is_split(spark, data, tmp_path):
    from couponlens.sources.store import write_fact
    from couponlens.sources.tables import read_profit_fact

    fact = read_profit_fact(spark, data)
    hot = F.when(F.pmod(F.xxhash64("reservation_id"), F.lit(3)) < 2, F.lit("1998-05-05").cast("timestamp_ntz"))
    path = f"{tmp_path}/fact"
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        write_fact(fact.withColumn("return_at", F.coalesce(hot, F.col("return_at"))).repartition(8), path)
    months = spark.read.parquet(path).groupBy("return_month").agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"))
    files = {str(r["return_month"])[:7]: r["files"] for r in months.collect()}
    assert files["1998-05"] == max(files.values()) > 3


def test_hot_customer(spark, data):
    """A third of all reservations belongs to one member; every other member is still counted once."""
    from couponlens.catalog import params as P
    from couponlens.sources.tables import read_coupon_tables

    reservations = read_coupon_tables(spark, data)["reservation"].withColumn(
        "member_id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("member_id")))
    got = mix.inflow_compare(reservations, "member_id", "created_at", "amount", P.INFLOW, P.ZONE)
    first = reservations.groupBy("member_id").agg(F.min(F.to_date(F.col("created_at") + F.expr("INTERVAL 9 HOURS"))).alias("d"))
    want = {p: first.filter(F.col("d").between(F.lit(a), F.lit(b))).count() for p, (a, b) in P.INFLOW.items()}
    assert {r["period"]: r["users"] for r in got.collect()} == want


def test_first_bookings_need_no_sort(spark, data):
    """The first reservation of each user comes from hashing, and ties in time are decided by the id."""
    text = plan(entry.queries()["inflow_compare"](spark, data))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    key = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '1960-01-01 00:00:00', 5L), (TIMESTAMP_NTZ '1960-01-01 00:00:00', -5L), (TIMESTAMP_NTZ '2999-01-01 00:00:00.000001', null), "
                    "(TIMESTAMP_NTZ '2999-01-01 00:00:00.000001', 9223372036854775807L), (TIMESTAMP_NTZ '9999-12-31 23:59:59.999999', -9223372036854775808L), (null, 1L) AS t(ts, id)")
    got = key.select("ts", "id", mix.time_and_id(F.col("ts"), F.col("id")).alias("k"))
    ordered = [(r.ts, r.id) for r in got.filter("k is not null").orderBy("k").collect()]
    assert ordered == [(r.ts, r.id) for r in key.filter("ts is not null").orderBy("ts", "id").collect()] and got.filter("k is null").count() == 1


def test_offset_periods_prune_the_stored_fact(spark, data, tmp_path):
    """Two weeks of two months read these two months, by ranges that reach the scan; the page takes five shuffles at most."""
    from datetime import date

    from couponlens.catalog import params as P
    from couponlens.operators import periods
    from couponlens.sources.store import read_fact, write_fact
    from couponlens.sources.tables import read_profit_fact

    write_fact(read_profit_fact(spark, data), str(tmp_path / "fact"))
    aligned = periods.align_day_offset(read_fact(spark, str(tmp_path / "fact")), "return_at", P.OFFSET_STARTS, 7, {"cnt": F.countDistinct("reservation_id")})
    direct = entry.queries()["align_day_offset"](spark, data).select(*aligned.columns)
    assert as_rows(aligned) == as_rows(direct)
    details = aligned._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(return_at,1998-05-01" in details
    metric = re.search(r"PartitionFilters: .*", details).group(0)
    assert "1998-05" in metric and "1998-06" in metric
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        page = plan(entry.queries()["report_first_week"](spark, data))
    assert len(re.findall(r"Exchange (?:hash|Single|range)", page)) <= 7 and date(1998, 5, 1) in P.OFFSET_STARTS.values()
