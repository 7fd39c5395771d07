"""The profit fact as a stored table, partitioned by return month.

The denormalised fact is written once; queries on it need no join, and the date filters of ``operators.filters`` read
only the months they cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couponlens.functions.dates import MONTH_COLUMN
from couponlens.sources.tables import PROFIT_FACT


def write_fact(fact: DataFrame, path: str, ts: str = "return_at") -> None:
    """Writes the fact, replacing what is there. The rebalance step gathers small months into few files and splits a
    month that holds much of the data over several tasks."""
    keyed = fact.withColumn(MONTH_COLUMN, F.date_format(ts, "yyyy-MM"))
    keyed.hint("rebalance", MONTH_COLUMN).write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path)


def read_fact(spark: SparkSession, path: str, schema: T.StructType = PROFIT_FACT) -> DataFrame:
    """The stored fact; ``schema`` is that of its rows without the month."""
    stored = T.StructType([*schema.fields, T.StructField(MONTH_COLUMN, T.StringType())])
    return spark.read.schema(stored).parquet(path)
