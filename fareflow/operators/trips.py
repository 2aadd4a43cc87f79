"""Row-level operators on trips: names, partition keys, duration, validity."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions import duration_minutes, moment
from fareflow.schema import DROPOFF, PICKUP


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names must not fold into one."""
    lowered = [name.lower() for name in df.columns]
    clashes = sorted(name for name, times in Counter(lowered).items() if times > 1)
    if clashes:
        raise ValueError(f"column names differ only in case: {clashes}")
    return df.toDF(*lowered)


def enrich_trips(
    trips: DataFrame,
    loaded_at: Column | datetime | None = None,
    pickup: str = PICKUP,
) -> DataFrame:
    """Keep trips with a pickup time and add the lake's year, month and load time."""
    return trips.where(F.col(pickup).isNotNull()).withColumns(
        {
            "year": F.year(pickup),
            "month": F.month(pickup),
            "processed_at": moment(loaded_at),
        }
    )


def with_duration(trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF) -> DataFrame:
    """Add ``duration_min``, the trip's length in minutes."""
    return trips.withColumn("duration_min", duration_minutes(pickup, dropoff))


def valid_trips(
    timed: DataFrame, distance: str = "trip_distance", total: str = "total_amount"
) -> DataFrame:
    """Trips that moved, took time and cost something; a null fails the test.

    Distance and total are plain column tests, so they reach the Parquet scan.
    """
    return timed.where((F.col(distance) > 0) & (F.col(total) > 0) & (F.col("duration_min") > 0))
