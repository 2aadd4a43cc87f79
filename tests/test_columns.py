import math

import pytest
from pyspark.sql import functions as F

from fareflow.functions import in_hash_split, in_split, percent_of, round_stable


@pytest.mark.parametrize(
    "value, digits, want",
    [
        (2.675, 2, 2.68),
        (1.005, 2, 1.01),
        (-0.125, 2, -0.13),
        (8.325, 2, 8.33),
        (8.324999999999998, 2, 8.33),
        (0.05, 1, 0.1),
        (3e17, 2, 3e17),
        (-1e27, 2, -1e27),
        (1e29, 2, None),
        (math.inf, 2, math.inf),
        (None, 2, None),
    ],
)
def test_round_stable(spark, value, digits, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round_stable(F.col("x"), digits)).first()[0] == want


def test_round_stable_keeps_nan(spark):
    df = spark.createDataFrame([(math.nan,)], "x double")
    assert math.isnan(df.select(round_stable(F.col("x"), 2)).first()[0])


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(percent_of(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


@pytest.mark.parametrize("chooser", [in_split, in_hash_split])
def test_split_takes_the_asked_share(spark, chooser):
    keys = spark.range(20000)
    for percent in (1, 50, 80, 99):
        share = keys.where(chooser(["id"], percent)).count() / 20000
        assert abs(share - percent / 100) < 0.02
    with pytest.raises(ValueError):
        chooser(["id"], 100)


@pytest.mark.parametrize("chooser", [in_split, in_hash_split])
def test_split_puts_a_key_with_nulls_somewhere(spark, chooser):
    df = spark.createDataFrame([(None, 1.5), (None, None)], "a string, b double")
    chosen = chooser(["a", "b"], 50)
    assert df.where(chosen).count() + df.where(~chosen).count() == 2


def test_hash_split_ignores_the_time_zone(spark):
    df = spark.range(500).selectExpr("id", "timestamp_seconds(id * 7919) AS t")
    chosen = lambda: {r.id for r in df.where(in_hash_split(["t"], 50)).collect()}
    here = chosen()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert chosen() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
