"""Aggregates over trips. Every group-by combines on the map side first, so a day
or month holding a third of all rows still reaches the shuffle as one row per task."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions import moment, percent_of, round_stable
from fareflow.operators.trips import valid_trips, with_duration
from fareflow.schema import DAILY_REPORT, PICKUP


def _sums() -> dict[str, Column]:
    """What the measures need of any set of valid trips; two sets' sums add up."""
    return {
        "trips": F.count(F.lit(1)),
        "revenue": F.sum("total_amount"),
        "miles": F.sum("trip_distance"),
        "minutes": F.sum("duration_min"),
        "tips": F.sum("tip_amount"),
        "tipped": F.count("tip_amount"),
        "fares": F.sum("fare_amount"),
    }


def daily_measures(sums: dict[str, Column]) -> dict[str, Column]:
    """The daily aggregates over valid trips, by output name.

    Tip share and speed are ratios of sums. Distance, duration and cost are positive
    in every valid trip, so their means share the sums and the row count.
    """
    trips, miles, minutes = sums["trips"], sums["miles"], sums["minutes"]
    return {
        "total_trips": trips,
        "total_revenue": round_stable(sums["revenue"], 2),
        "total_distance_miles": round_stable(miles, 2),
        "avg_cost_per_trip": round_stable(sums["revenue"] / trips, 2),
        "avg_distance_miles": round_stable(miles / trips, 2),
        "avg_duration_min": round_stable(minutes / trips, 1),
        "avg_tip_amount": round_stable(F.try_divide(sums["tips"], sums["tipped"]), 2),
        "avg_tip_percent": round_stable(percent_of(sums["tips"], sums["fares"]), 2),
        "avg_speed_mph": round_stable(F.try_divide(miles, minutes / 60), 2),
    }


def _by_day(trips: DataFrame, pickup: str, local_days: bool = False) -> DataFrame:
    """Valid trips with their day; a plain timestamp is a cheaper key to hash than a window."""
    usable = valid_trips(with_duration(trips, pickup=pickup)).where(F.col(pickup).isNotNull())
    day = F.date_trunc("day", pickup) if local_days else F.window(pickup, "1 day")["start"]
    return usable.withColumn("bucket", day)


def _measured(days: DataFrame, calculated_at: Column | datetime | None, date: Column) -> DataFrame:
    measures = daily_measures({name: F.col(name) for name in _sums()})
    return days.select(
        date.alias("date"),
        *[column.alias(name) for name, column in measures.items()],
        moment(calculated_at).alias("calculated_at"),
    )


def daily_stats_full(
    trips: DataFrame,
    calculated_at: Column | datetime | None = None,
    pickup: str = PICKUP,
    local_days: bool = False,
) -> DataFrame:
    """One row per day with trips, every measure, in no particular order.

    Days are one-day windows cut at UTC midnight. ``local_days`` cuts at midnight of
    the session's time zone instead.
    """
    days = _by_day(trips, pickup, local_days).groupBy("bucket")
    return _measured(days.agg(*[c.alias(n) for n, c in _sums().items()]), calculated_at, F.col("bucket"))


def daily_sums(trips: DataFrame, *keys: str, pickup: str = PICKUP) -> DataFrame:
    """The sums of each day, as ``bucket``, and of any further keys."""
    days = _by_day(trips, pickup).groupBy("bucket", *keys)
    return days.agg(*[c.alias(n) for n, c in _sums().items()])


def added_sums(sums: DataFrame, *keys: str) -> DataFrame:
    """Any number of ``daily_sums`` as one, by day and any further keys."""
    return sums.groupBy("bucket", *keys).agg(*[F.sum(n).alias(n) for n in _sums()])


def merged_days(sums: DataFrame, calculated_at: Column | datetime | None = None) -> DataFrame:
    """Every measure by day from any number of ``daily_sums``."""
    return _measured(added_sums(sums), calculated_at, F.col("bucket"))


def closing_days(trips: DataFrame, late_by: str, pickup: str = PICKUP) -> DataFrame:
    """The measures of a stream's days, each once the watermark has passed it.

    The watermark follows the newest valid trip: it is set behind the filters.
    """
    usable = valid_trips(with_duration(trips, pickup=pickup)).where(F.col(pickup).isNotNull())
    days = usable.withWatermark(pickup, late_by).groupBy(F.window(pickup, "1 day").alias("bucket"))
    return _measured(days.agg(*[c.alias(n) for n, c in _sums().items()]), None, F.col("bucket.start"))


def daily_stats(
    trips: DataFrame,
    calculated_at: Column | datetime | None = None,
    pickup: str = PICKUP,
    local_days: bool = False,
) -> DataFrame:
    """The daily report, oldest day first."""
    full = daily_stats_full(trips, calculated_at, pickup, local_days)
    return full.select(*DAILY_REPORT).orderBy("date")


def first_days(stats: DataFrame, days: int = 5) -> DataFrame:
    """The ``days`` oldest rows of the report (a top-k, not a full sort)."""
    return stats.orderBy("date").limit(days)


def monthly_counts(enriched: DataFrame) -> DataFrame:
    """Trips per month. On the lake both keys are partition columns: no data is read."""
    return enriched.groupBy("year", "month").count().orderBy("year", "month")


def fare_correlation(
    trips: DataFrame, x: str = "trip_distance", y: str = "fare_amount", digits: int = 6
) -> DataFrame:
    """Pearson correlation over all rows where both values are present."""
    return trips.agg(round_stable(F.corr(x, y), digits).alias("correlation"))
