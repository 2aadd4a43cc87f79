"""Trip-shaped frames derived from the order tables used for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRIP_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _columns() -> dict[str, Column]:
    """Trip columns that need nothing but the line item, in order of dependence."""
    col, lit = F.col, F.lit
    outlier = F.when(col("l_partkey") % 103 == 0, 10).otherwise(1)
    refund = F.when((col("l_returnflag") == "R") & (col("l_linenumber") == 7), -1).otherwise(1)
    distance = (col("l_quantity") - 1) * lit(0.37) * outlier
    meter = lit(2.0) + lit(2.5) * distance + col("l_tax") * 40
    fare = refund * meter
    return {
        "trip_id": F.concat_ws("-", *TRIP_KEY),
        "vendorid": (col("l_suppkey") % 2 + 1).cast("string"),
        "passenger_count": F.when(col("l_partkey") % 97 != 0, col("l_linenumber") - 1),
        "trip_distance": distance,
        "fare_amount": fare,
        "tip_amount": fare * col("l_discount"),
        "total_amount": refund * (meter * (lit(1) + col("l_discount")) + lit(1.3)),
    }


def fares_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without their times: one line item each, read without any shuffle."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select(*[column.alias(name) for name, column in _columns().items()])


def trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with pickup and drop-off times, which hang on the order's date.

    Times are seconds until the last step; the calendar is consulted once per order.

    The join is left to Spark: it broadcasts the orders while their size is under
    its threshold, and beyond that sorts and merges with AQE splitting a hot order.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("midnight")
    )
    into_day = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 3571) % 86400
    start = F.col("midnight") + into_day
    length = (F.col("l_quantity") * 75 - 150).cast("bigint")
    columns = {
        **_columns(),
        "tpep_pickup_datetime": F.when(F.col("l_partkey") % 101 != 0, F.timestamp_seconds(start)),
        "tpep_dropoff_datetime": F.timestamp_seconds(start + length),
    }
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        *[column.alias(name) for name, column in columns.items()]
    )
