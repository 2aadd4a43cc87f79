from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow.operators.trips import enrich_trips, normalize_columns, valid_trips, with_duration
from tests.helpers import NOON, collected, make_trips


def test_normalize_lowers_every_name(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID int, Fare_Amount int")
    assert normalize_columns(df).columns == ["vendorid", "fare_amount"]


def test_normalize_rejects_clashing_names(spark):
    with pytest.raises(ValueError, match="case"):
        normalize_columns(spark.range(1).selectExpr("id AS `A`", "id AS `a`"))


def test_enrich_drops_missing_pickup_and_adds_keys(spark):
    at = datetime(2020, 1, 1)
    trips = make_trips(spark, {}, {"tpep_pickup_datetime": None})
    rows = enrich_trips(trips, at).select("year", "month", "processed_at").collect()
    assert [tuple(r) for r in rows] == [(2015, 1, at)]
    assert dict(enrich_trips(trips).dtypes)["year"] == "int"


def test_load_time_is_one_instant_per_query(spark):
    trips = enrich_trips(make_trips(spark, *[{}] * 50).repartition(8))
    assert trips.select("processed_at").distinct().count() == 1


def test_duration_cuts_fractions_of_each_end(spark):
    trips = make_trips(
        spark,
        {
            "tpep_pickup_datetime": NOON + timedelta(milliseconds=900),
            "tpep_dropoff_datetime": NOON + timedelta(seconds=90, milliseconds=100),
        },
    )
    assert with_duration(trips).first().duration_min == 1.5


@pytest.mark.parametrize("column", ["trip_distance", "total_amount"])
@pytest.mark.parametrize("value, kept", [(0.0, 0), (-1.0, 0), (None, 0), (0.01, 1), (float("nan"), 1)])
def test_validity_of_amounts(spark, column, value, kept):
    timed = with_duration(make_trips(spark, {column: value}))
    assert valid_trips(timed).count() == kept


@pytest.mark.parametrize("seconds, kept", [(-60, 0), (0, 0), (1, 1)])
def test_validity_of_duration(spark, seconds, kept):
    dropoff = NOON + timedelta(seconds=seconds)
    assert valid_trips(with_duration(make_trips(spark, {"tpep_dropoff_datetime": dropoff}))).count() == kept


@pytest.mark.parametrize("column", ["tpep_pickup_datetime", "tpep_dropoff_datetime"])
def test_missing_time_is_invalid(spark, column):
    assert valid_trips(with_duration(make_trips(spark, {column: None}))).isEmpty()


def test_other_column_names(spark):
    trips = make_trips(spark, {}).select(
        F.col("tpep_pickup_datetime").alias("a"),
        F.col("tpep_dropoff_datetime").alias("b"),
        F.col("trip_distance").alias("km"),
        F.col("total_amount").alias("cost"),
    )
    timed = with_duration(trips, pickup="a", dropoff="b")
    assert collected(valid_trips(timed, distance="km", total="cost"), "duration_min") == [(10.0,)]
