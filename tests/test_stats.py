from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareflow.operators.stats import (
    daily_stats,
    daily_stats_full,
    fare_correlation,
    first_days,
    monthly_counts,
)
from fareflow.operators.trips import enrich_trips
from fareflow.schema import DAILY_REPORT
from tests.helpers import NOON, collected, make_trips

DAY = timedelta(days=1)
MEASURES = [c for c in DAILY_REPORT if c != "calculated_at"]


def trip_at(pickup, minutes=10, **more):
    return {
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup + timedelta(minutes=minutes),
        **more,
    }


def test_report_columns_and_values(spark):
    trips = make_trips(
        spark,
        trip_at(NOON, 10, trip_distance=2.0, fare_amount=8.0, tip_amount=1.0, total_amount=10.0),
        trip_at(NOON, 20, trip_distance=4.0, fare_amount=12.0, tip_amount=4.0, total_amount=18.0),
    )
    report = daily_stats(trips)
    assert report.columns == list(DAILY_REPORT)
    row = report.first()
    assert row.date == datetime(2015, 1, 15)
    assert row.total_trips == 2
    assert row.total_revenue == 28.0
    assert row.avg_cost_per_trip == 14.0
    assert row.avg_distance_miles == 3.0
    assert row.avg_duration_min == 15.0
    assert row.avg_speed_mph == 12.0
    assert row.avg_tip_percent == 25.0
    full = daily_stats_full(trips).first()
    assert (full.total_distance_miles, full.avg_tip_amount) == (6.0, 2.5)


def test_tip_share_weighs_trips_by_fare_and_skips_nulls_apart(spark):
    trips = make_trips(
        spark,
        trip_at(NOON, fare_amount=10.0, tip_amount=5.0),
        trip_at(NOON, fare_amount=90.0, tip_amount=None),
        trip_at(NOON, fare_amount=None, tip_amount=5.0),
    )
    row = daily_stats_full(trips).first()
    assert row.avg_tip_percent == 10.0
    assert row.avg_tip_amount == 5.0


def test_zero_fares_give_null_not_an_error(spark):
    assert daily_stats(make_trips(spark, trip_at(NOON, fare_amount=0.0))).first().avg_tip_percent is None


def test_nan_distance_survives_and_shows(spark):
    row = daily_stats(make_trips(spark, trip_at(NOON, trip_distance=float("nan")))).first()
    assert row.total_trips == 1 and row.avg_distance_miles != row.avg_distance_miles


def test_midnight_starts_a_new_day(spark):
    midnight = datetime(2015, 1, 16)
    trips = make_trips(spark, trip_at(midnight - timedelta(seconds=1)), trip_at(midnight))
    assert collected(daily_stats(trips), "date", "total_trips") == [
        (datetime(2015, 1, 15), 1),
        (midnight, 1),
    ]


def test_missing_pickup_has_no_day(spark):
    assert daily_stats(make_trips(spark, {"tpep_pickup_datetime": None})).isEmpty()


def test_days_come_in_order_and_first_days_are_the_oldest(spark):
    trips = make_trips(spark, *[trip_at(NOON + DAY * n) for n in (5, 1, 9, 3, 0, 7, 2)])
    days = [r.date for r in daily_stats(trips).collect()]
    assert days == sorted(days) and len(days) == 7
    assert [r.date for r in first_days(daily_stats(trips), 3).collect()] == days[:3]


def test_local_days_follow_the_session_zone(spark):
    late = datetime(2015, 1, 16, 2, 0)
    trips = make_trips(spark, trip_at(late))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = daily_stats(trips, local_days=True).selectExpr("cast(date AS string)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert local == "2015-01-15 00:00:00"


def test_monthly_counts(spark):
    trips = make_trips(spark, trip_at(NOON), trip_at(NOON), trip_at(NOON - DAY * 20))
    rows = [tuple(r) for r in monthly_counts(enrich_trips(trips)).collect()]
    assert rows == [(2014, 12, 1), (2015, 1, 2)]


def test_correlation_ignores_rows_with_a_null(spark):
    trips = make_trips(
        spark,
        {"trip_distance": 1.0, "fare_amount": 3.0},
        {"trip_distance": 2.0, "fare_amount": 5.0},
        {"trip_distance": 3.0, "fare_amount": 7.0},
        {"trip_distance": 9.0, "fare_amount": None},
    )
    assert fare_correlation(trips).first().correlation == 1.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 90)), min_size=1, max_size=12))
def test_days_are_independent(spark, shifts):
    """Statistics of a union of disjoint days are the union of their statistics."""
    trips = [trip_at(NOON + DAY * day, minutes) for day, minutes in shifts]
    early = [t for t in trips if t["tpep_pickup_datetime"] < NOON + DAY * 3]
    late = [t for t in trips if t not in early]
    parts = []
    for part in filter(None, (early, late)):
        parts += collected(daily_stats(make_trips(spark, *part)), *MEASURES)
    assert collected(daily_stats(make_trips(spark, *trips)), *MEASURES) == sorted(parts)
