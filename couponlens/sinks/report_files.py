"""Report outputs. They stay DataFrames; the only thing that reaches the driver is the one-row manifest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couponlens.functions.dates import short_date


def to_series(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Ordered parallel arrays per key: one array per value column, all in the order of ``order``.

    For series of reporting periods (weeks, days), whose length is bounded by the calendar.
    """
    rows = F.array_sort(F.collect_list(F.struct(order, *values)))
    sorted_rows = df.groupBy(*keys).agg(rows.alias("_rows"))
    return sorted_rows.select(*keys, F.col(f"_rows.{order}").alias(order), *[F.col(f"_rows.{v}").alias(v) for v in values])


def explode_series(series: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Series back to rows with their position."""
    return series.select(*keys, F.posexplode(F.arrays_zip(*columns)).alias("pos", "_row")).select(*keys, "pos", "_row.*")


def to_records(daily_wide: DataFrame) -> DataFrame:
    """Daily records: the date as ``MM/DD`` next to the zero-filled columns."""
    return daily_wide.withColumn("date", short_date(F.col("create_date")))


def manifest(weekly: DataFrame, daily: DataFrame, as_of: date, classes: Sequence[str] = ("eb", "sd")) -> DataFrame:
    """One row: status, refresh date, number of weeks and of creation days."""
    weeks = weekly.filter(F.col("ctype").isin(*classes)).agg(F.countDistinct("week").alias("weeks"))
    days = daily.agg(F.countDistinct("create_date").alias("nc_days"))
    both = weeks.withColumn("nc_days", F.lit(0).cast("bigint")).unionByName(
        days.withColumn("weeks", F.lit(0).cast("bigint"))
    )
    return both.agg(F.max("weeks").alias("weeks"), F.max("nc_days").alias("nc_days")).select(
        F.lit("ok").alias("status"), F.lit(as_of.strftime("%Y.%m.%d")).alias("updated"), "weeks", "nc_days"
    )


def with_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Adds the whole row as a JSON text."""
    return df.withColumn(name, F.to_json(F.struct("*")))


def snapshot_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows that only one of two snapshots has, with the side and the number of surplus copies.

    One grouped pass over both instead of two set differences. Empty means nothing to publish.
    """
    columns = new.columns
    signed = new.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1)))
    return (
        signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
        .select(*columns, F.when(F.col("_n") > 0, "new").otherwise("old").alias("side"), F.abs("_n").alias("copies"))
    )


MONTH = "month"  # partition column of a stored snapshot, as yyyy-MM; "none" without a date
_DIGESTS = "month string, n_rows bigint, digest_0 decimal(38,0), digest_1 decimal(38,0)"


def _month(day: str) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def month_digests(df: DataFrame, day: str) -> DataFrame:
    """One row per month of ``day``: number of rows, and two sums of 64-bit row hashes, which do not depend on the order of rows.
    Hashing passes over nulls, so it also takes in which columns are null."""
    cells = [c for name in df.columns if name != MONTH for c in (F.col(name), F.col(name).isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).alias(f"digest_{seed}") for seed in (0, 1)]
    return df.groupBy(_month(day).alias(MONTH)).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def write_monthly(df: DataFrame, day: str, path: str) -> None:
    """Stores a snapshot by month with the digests of its months beside it."""
    df.withColumn(MONTH, _month(day)).write.partitionBy(MONTH).parquet(f"{path}/rows")
    month_digests(df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows"), day).write.parquet(f"{path}/digests")


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """A stored snapshot with its ``month``."""
    rows = spark.read.parquet(f"{path}/rows")
    kept = T.StructType([f for f in rows.schema if f.name != MONTH]).add(MONTH, "string")
    return spark.read.schema(kept).parquet(f"{path}/rows")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DIGESTS).parquet(f"{path}/digests")


def changed_months(new: DataFrame, old: DataFrame) -> list[str]:
    """Months whose digests differ, or that one snapshot lacks; the calendar bounds them."""
    return sorted({r[MONTH] for r in snapshot_diff(new, old).select(MONTH).distinct().collect()})


def diff_months(new: DataFrame, old: DataFrame, months: Sequence[str]) -> DataFrame:
    """``snapshot_diff`` of the given months of two stored snapshots; the files of other months are not read."""
    return snapshot_diff(*[df.filter(F.col(MONTH).isin(*months) if months else F.lit(False)).drop(MONTH) for df in (new, old)])


def write_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Writes a report table, replacing what is there. Text fields are escaped by the writer."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unknown report format: {fmt}")
    df.write.mode("overwrite").format(fmt).save(path)
