"""Incremental daily rollup of arriving bookings, whole however late or often they arrive.

Every micro-batch stores its arrivals by day, then rewrites the days that it touched from all their arrivals, and no
others. Both writes replace what the same batch wrote before, so a batch that is run again changes nothing: the table
is at any time what ``batch_daily_rollup`` makes of all files so far. A day counts as complete once bookings have been
seen that are later than its end by ``delay``; a booking for a complete day corrects it.

There is no state between batches but the arrivals, so nothing grows in the executors or the driver. The driver sees
the dates of a batch. Settings that cut a backlog into batches change the work, not the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couponlens.functions.numbers import half_up
from couponlens.session import shared_folder

_DAY = "event_date"


def _measures(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt"), F.sum("revenue").alias("rev_sum"), F.max("event_time").alias("latest"))


def _arrived(bookings: DataFrame, ts: str, id: str, group: str) -> DataFrame:
    return bookings.select(F.col(ts).alias("event_time"), id, group, "revenue", F.to_date(ts).alias(_DAY))


def _daily(arrivals: DataFrame, id: str, group: str) -> DataFrame:
    """A booking that arrives again is counted once on its day."""
    return _measures(arrivals.dropDuplicates([_DAY, id]).groupBy(_DAY, group))


def _shown(days: DataFrame, group: str) -> DataFrame:
    return days.select(_DAY, group, "cnt", half_up("rev_sum", 2).alias("rev"))


def batch_daily_rollup(df: DataFrame, ts: str, id: str, group: str) -> DataFrame:
    """The rollup of all rows at once, including days that are still open: event_date, group, cnt, rev."""
    return _shown(_daily(_arrived(df, ts, id, group), id, group), group)


def _replace(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(_DAY).parquet(path)


def store_batch(arrivals: DataFrame, number: int, out: str, id: str, group: str) -> None:
    """Stores the arrivals of a micro-batch and rewrites the days that they fall on. Rows without a time belong to no day."""
    spark = arrivals.sparkSession
    mine = f"{out}/arrivals/batch={number}"
    _replace(arrivals.filter(F.col(_DAY).isNotNull()), mine, "static")
    # the days of a batch; the calendar bounds them
    touched = [r[0] for r in spark.read.schema(arrivals.schema).parquet(mine).select(_DAY).distinct().collect()]
    if touched:
        stored = spark.read.schema(arrivals.schema).option("basePath", f"{out}/arrivals").parquet(f"{out}/arrivals")
        _replace(_daily(stored.filter(F.col(_DAY).isin(*touched)), id, group), f"{out}/days", "dynamic")


def read_rollup(spark: SparkSession, out: str, group: str, kind: str, delay: str) -> DataFrame:
    """The complete days of a stored rollup; ``kind`` is the type of the group column."""
    stored = spark.read.schema(f"{group} {kind}, cnt long, rev_sum decimal(38,4), latest timestamp_ntz, {_DAY} date").parquet(f"{out}/days")
    seen = stored.agg(F.to_date(F.max("latest") - F.expr(f"INTERVAL {delay}"))).first()[0]
    return _shown(stored.filter(F.col(_DAY) < F.lit(seen) if seen else F.lit(False)), group)


def run_rollup(
    spark: SparkSession, source: str, schema: T.StructType, prepare, ts: str, id: str, group: str, delay: str,
    out: str | None = None, checkpoint: str | None = None, files_per_trigger: int | None = None,
) -> DataFrame:
    """Processes all files that have arrived since the last run, then returns the complete days.

    ``prepare`` turns source rows into bookings. Output and checkpoint default to a new place in the shared folder;
    give both to continue an earlier run. ``files_per_trigger`` cuts a large backlog into batches, in any order of days;
    each batch reads the arrivals of its days again, so files in the order of their days are the least work.
    """
    if (out is None) != (checkpoint is None):
        raise ValueError("give both the output and the checkpoint folder, or neither")
    if out is None:
        base = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
        out, checkpoint = f"{base}/table", f"{base}/checkpoint"
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arrivals = _arrived(prepare(reader.parquet(source)), ts, id, group)
    query = (
        arrivals.writeStream.foreachBatch(lambda rows, number: store_batch(rows, number, out, id, group))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_rollup(spark, out, group, arrivals.schema[group].dataType.simpleString(), delay)
