"""The batch refresh: both campaign tables, the report files, and publication when something changed.

    python -m couponlens.plans.refresh --data <folder> --out <folder> --as-of 2026-04-01
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.functions.rules import ClassRule
from couponlens.operators.kpi import new_coupon_daily_named, weekly_class_kpi
from couponlens.operators.periods import align_weeks_outer
from couponlens.operators.shaping import pivot_daily_policy
from couponlens.plans import presets
from couponlens.sinks.report_files import (
    MONTH, changed_months, diff_months, manifest, read_digests, read_monthly, to_records, to_series, write_monthly, write_records,
)
from couponlens.sources.tables import read_canonical, read_coupon_tables, read_profit_fact

_PUBLISHED = "status string, updated string, weeks bigint, nc_days bigint, run string, published_at string"


@dataclass(frozen=True)
class RefreshSettings:
    """What the refresh computes; the defaults are the presets of the published pages."""

    rules: Sequence[ClassRule] = presets.CLASS_RULES
    year: int = presets.REPORT_YEAR
    weekly_unit: float = presets.WEEKLY_UNIT
    policy_ids: Sequence[int] = presets.CAMPAIGN_POLICIES
    record_ids: Sequence[int] | None = None  # policies with columns in the daily records; all of ``policy_ids`` by default
    valid: dict = field(default_factory=lambda: dict(presets.VALID_RESERVATION))
    ledger_types: dict = field(default_factory=lambda: dict(presets.LEDGER_TYPES))
    vat: float = presets.VAT
    daily_unit: float = presets.DAILY_UNIT


def last_published(spark: SparkSession, out: str) -> str | None:
    """Folder of the run that was published last, or None before the first one."""
    try:
        runs = spark.read.schema(_PUBLISHED).json(f"{out}/published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    latest = runs.agg(F.max(F.struct("published_at", "run")).alias("r")).select("r.run").first()
    return latest["run"]


def _changed(spark: SparkSession, new: str, old: str | None, tables: Sequence[str]) -> bool:
    """Whether a run differs from an earlier one. Digests of months are compared first, then the rows of months that differ."""
    if old is None:
        return True
    for t in tables:
        here, there = f"{new}/{t}", f"{old}/{t}"
        months = changed_months(read_digests(spark, here), read_digests(spark, there))
        if months and not diff_months(read_monthly(spark, here), read_monthly(spark, there), months).isEmpty():
            return True
    return False


def run_refresh(
    spark: SparkSession, fact: DataFrame, tables: dict[str, DataFrame], out: str, as_of: date,
    settings: RefreshSettings = RefreshSettings(), now: datetime | None = None,
) -> dict:
    """Computes both tables into a new run folder under ``out``; publishes the run if it differs from the last one.

    Each table is written once and read back for the comparison and the report files, so nothing is computed twice
    and a lost executor costs no more than its tasks. Readers find the current run in ``<out>/published``, which gets
    its row after all files of the run are complete.
    """
    s, now = settings, now or datetime.now()
    run = f"{out.rstrip('/')}/runs/{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    write_monthly(weekly_class_kpi(fact, s.rules, s.year, as_of, s.weekly_unit), "week_start", f"{run}/weekly")
    creation = new_coupon_daily_named(tables, s.policy_ids, s.valid, s.ledger_types, s.vat, s.daily_unit)
    write_monthly(creation, "create_date", f"{run}/daily")
    weekly, daily = (read_monthly(spark, f"{run}/{t}").drop(MONTH) for t in ("weekly", "daily"))

    done = manifest(weekly, daily, as_of)
    if not _changed(spark, run, last_published(spark, out), ("weekly", "daily")):
        return {**done.first().asDict(), "run": run, "published": False}

    values = [f"{c}_{m}" for c in ("eb", "sd") for m in ("cnt", "rev", "cm", "pft")]
    aligned = align_weeks_outer(weekly).withColumn("report", F.lit("weekly"))
    write_records(to_series(aligned, ["report"], "week", ["label", *values]), f"{run}/weekly_series")
    records = to_records(pivot_daily_policy(daily, s.record_ids or s.policy_ids)).orderBy("create_date")
    write_records(records, f"{run}/daily_records")
    stamped = done.withColumns({"run": F.lit(run), "published_at": F.lit(now.isoformat(timespec="seconds"))})
    stamped.write.mode("append").json(f"{out}/published")
    return {**done.first().asDict(), "run": run, "published": True}


def driver_settings() -> RefreshSettings:
    """Settings for the driver tables."""
    from couponlens.catalog import params

    return RefreshSettings(
        rules=params.RULES, year=params.YEAR, weekly_unit=params.CLASS_UNIT, policy_ids=params.POLICY_IDS,
        record_ids=params.PIVOT_IDS, valid=params.VALID, ledger_types=params.LEDGER, daily_unit=params.DAY_UNIT,
    )


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Refresh the campaign reports from the tables of a folder.")
    parser.add_argument("--data", required=True, help="folder of the input tables")
    parser.add_argument("--out", required=True, help="folder of the runs and the published manifest")
    parser.add_argument("--as-of", type=date.fromisoformat, required=True, help="first day that is not complete")
    parser.add_argument("--layout", choices=("canonical", "driver"), default="canonical")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.layout == "canonical":
        (fact, tables), settings = read_canonical(spark, args.data), RefreshSettings()
    else:
        fact, tables = read_profit_fact(spark, args.data), read_coupon_tables(spark, args.data)
        settings = driver_settings()
    print(json.dumps(run_refresh(spark, fact, tables, args.out, args.as_of, settings)))


if __name__ == "__main__":
    main()
