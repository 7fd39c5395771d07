"""Readers with declared schemas, and the canonical views that the operators expect.

Canonical profit fact: one row per reservation charge record, several per reservation.
Canonical coupon tables: reservation, coupon, policy, charge, payment.
Canonical bookings: one row per booking with creation, start and end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couponlens.functions.dates import micros_between
from couponlens.functions.numbers import MONEY

_L, _I, _D, _S, _N = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS = {
    "part": _schema(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _schema(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_N, o_orderpriority=_S
    ),
    "lineitem": _schema(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D, l_extendedprice=_D,
        l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_N,
    ),
    "events": _schema(event_id=_L, ts=_N, user_id=_L, event_type=_S, value=_D, props=_S),
}

_MONEY = T.DecimalType(18, 4)

# Schemas of the canonical inputs, for tables that already have this shape.
PROFIT_FACT = _schema(
    reservation_id=_L, return_at=_N, coupon_policy_id=_L, coupon_policy_name=_S, coupon_policy_division=_S,
    revenue=_MONEY, contribution_margin=_MONEY, profit=_MONEY,
)
COUPON_TABLES = {
    "reservation": _schema(id=_L, created_at=_N, way=_S, member_imaginary=_I, state=_I),
    "coupon": _schema(reservation_id=_L, policy_id=_L, state=_I),
    "policy": _schema(id=_L, name=_S),
    "charge": _schema(reservation_id=_L, amount=_MONEY, charge_type=_S),
    "payment": _schema(reservation_id=_L, amount=_MONEY, paid_type=_S),
}


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table with its declared schema; nothing is inferred."""
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(folder, name))


def _hundredths(column: str) -> Column:
    """A double of at most two decimals as an exact integer. The amounts of a row are computed on integers and become
    decimal once, which costs a fraction of decimal arithmetic on every step."""
    return F.rint(F.col(column) * 100).cast("bigint")


def _money(units: Column, scale: int) -> Column:
    """Integer units of ``10**-scale`` as money."""
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(MONEY)


def read_profit_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Denormalised profit fact. Scan filters and column choice pass through the projection to both inputs.

    The policy side grows with the data, so the join carries no broadcast hint: Spark broadcasts it while its size is
    under the threshold, and otherwise runs a shuffled join whose hot policies the adaptive skew join splits.
    """
    lines, policies = read_table(spark, folder, "lineitem"), read_table(spark, folder, "part")
    revenue = _hundredths("l_extendedprice") * (F.lit(100) - _hundredths("l_discount"))
    quantity = _hundredths("l_quantity") * 100
    return lines.join(policies, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("reservation_id"),
        F.col("l_shipdate").alias("return_at"),
        F.when(F.col("p_size") % 10 != 0, F.col("l_partkey")).alias("coupon_policy_id"),
        F.col("p_name").alias("coupon_policy_name"),
        F.col("p_type").alias("coupon_policy_division"),
        _money(revenue, 4).alias("revenue"),
        _money(revenue - quantity * 500, 4).alias("contribution_margin"),
        _money(revenue - quantity * 1300, 4).alias("profit"),
    )


def read_coupon_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five normalised coupon views."""
    orders, lines = read_table(spark, folder, "orders"), read_table(spark, folder, "lineitem")
    status = F.col("o_orderstatus")
    reservation = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("member_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 15 HOURS")).alias("created_at"),
        F.col("o_orderpriority").alias("way"),
        (F.col("o_custkey") % 10).cast("int").alias("member_imaginary"),
        F.when(status == "F", 1).when(status == "O", 2).when(status == "P", 4).alias("state"),
        _money(_hundredths("o_totalprice"), 2).alias("amount"),
    )
    coupon = orders.select(
        F.col("o_orderkey").alias("reservation_id"),
        (F.col("o_custkey") * 2).alias("policy_id"),  # a third of them name a policy that does not exist
        F.when(F.col("o_orderkey") % 5 != 0, 1).otherwise(0).alias("state"),
    )
    policy = read_policies(spark, folder)
    flag, line_status, price = F.col("l_returnflag"), F.col("l_linestatus"), _hundredths("l_extendedprice")
    charge = lines.select(
        F.col("l_orderkey").alias("reservation_id"),
        _money(F.when(flag == "A", -price).otherwise(price), 2).alias("amount"),
        F.when(flag == "R", "rent").when(flag == "A", "refund").when(flag == "N", "protection_fee")
        .otherwise("other").alias("charge_type"),
    )
    payment = lines.select(
        F.col("l_orderkey").alias("reservation_id"),
        _money(price * _hundredths("l_discount"), 4).alias("amount"),
        F.when(line_status == "F", "coupon").otherwise("card").alias("paid_type"),
    )
    return {"reservation": reservation, "coupon": coupon, "policy": policy, "charge": charge, "payment": payment}


def read_canonical(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact and coupon tables that are stored in canonical shape: ``profit_fact.parquet``, ``reservation.parquet`` ..."""
    fact = spark.read.schema(PROFIT_FACT).parquet(table_path(folder, "profit_fact"))
    return fact, {n: spark.read.schema(s).parquet(table_path(folder, n)) for n, s in COUPON_TABLES.items()}


def read_policies(spark: SparkSession, folder: str) -> DataFrame:
    """Coupon policies: id and display name."""
    return read_table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def booking_columns(events: DataFrame) -> DataFrame:
    """Events as bookings; works on a batch and on a streaming table."""
    k = F.get_json_object("props", "$.k").cast("int")
    amount = _hundredths("value")
    start = F.timestamp_add("SECOND", amount * 72, F.col("ts"))
    revenue = amount * (k + 1)
    return events.select(
        F.col("event_id").alias("booking_id"),
        "user_id",
        F.col("event_type").alias("division"),
        F.col("ts").alias("created_at"),
        start.alias("start_at"),
        F.timestamp_add("HOUR", k, start).alias("end_at"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("state"),
        (40 + 5 * (k % 3)).cast("int").alias("discount_rate"),
        F.col("user_id").alias("policy_id"),
        _money(revenue, 3).alias("revenue"),
        _money(revenue * (k - 40), 5).alias("profit"),
    )


def with_spans(bookings: DataFrame) -> DataFrame:
    """Adds lead time and duration in microseconds."""
    return bookings.withColumns({
        "lead_us": micros_between(F.col("created_at"), F.col("start_at")),
        "duration_us": micros_between(F.col("start_at"), F.col("end_at")),
    })


def read_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return with_spans(booking_columns(read_table(spark, folder, "events")))
