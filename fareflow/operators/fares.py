"""The fare model: training rows, split, fit, score, evaluate, describe.

One pass over the data to fit and one to evaluate; nothing is cached by default.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions import in_share, in_split

FEATURES = ("trip_distance", "passenger_count")

# Which column is the label, in order of preference; the ranges a
# training row must lie in; the shape of the model; the trips shown as examples; and,
# in describe_model, the wording of the formula.
LABELS = ("fare_amount", "total_amount")
MAX_DISTANCE = 100
MIN_FARE = 2.5
MAX_FARE = 200
MAX_PASSENGERS = 6
TRAIN_PERCENT = 80
SEED = 42
MODEL = {
    "maxIter": 100,
    "regParam": 0.1,
    "elasticNetParam": 0.5,
    "solver": "normal",
    "aggregationDepth": 2,
}
EXAMPLE_TRIPS = [(1.0, 1.0), (3.0, 1.0), (5.0, 1.0), (10.0, 1.0), (20.0, 1.0)]
NAMED_TRIPS = [
    (0.5, 1, "Very short trip"),
    (1.0, 1, "Short trip"),
    (2.0, 1, "Average trip"),
    (5.0, 1, "Medium trip"),
    (10.0, 1, "Long trip"),
    (20.0, 1, "Very long trip"),
    (5.0, 2, "5 miles, 2 passengers"),
    (5.0, 4, "5 miles, 4 passengers"),
]
CURVE_POINTS = 100
CURVE_MILES = 50
SAMPLE_FRACTION = 0.001

# At the solver's own stopping rule of 1e-6 the fifth digit depends on its path.
TOLERANCE = 1e-12


def label_column(df: DataFrame) -> str:
    """The column to predict: the first of ``LABELS`` the frame has."""
    for name in LABELS:
        if name in df.columns:
            return name
    raise ValueError(f"none of the label columns {LABELS} is present")


def in_training_range(label: str) -> Column:
    """Whether a trip may be trained on; a null value fails the test."""
    fare, miles, riders = F.col(label), *map(F.col, FEATURES)
    return (
        (miles > 0)
        & (miles <= MAX_DISTANCE)
        & (fare > MIN_FARE)
        & (fare < MAX_FARE)
        & (riders > 0)
        & (riders <= MAX_PASSENGERS)
    )


def training_set(trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features and ``label`` as doubles, for trips inside the training ranges.

    ``keep`` carries further columns along, such as the key of the split.
    """
    label = label_column(trips)
    numbers = [F.col(name).cast("double").alias(name) for name in FEATURES]
    chosen = trips.where(in_training_range(label)).select(
        *keep, *numbers, F.col(label).cast("double").alias("label")
    )
    return chosen.dropna(how="any", subset=[*FEATURES, "label"])


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add the vector column ``features``; a null feature is an error."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def stable_split(
    df: DataFrame,
    keys: Sequence[str],
    percent: int = TRAIN_PERCENT,
    chooser: Callable[[Sequence[str], int], Column] = in_split,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of their key: the same rows on every run.

    ``chooser`` may be ``in_hash_split``, the cheaper hash.
    """
    chosen = chooser(keys, percent)
    return df.where(chosen), df.where(~chosen)


def random_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split. Membership changes when the input is partitioned anew."""
    train, test = df.randomSplit([percent / 100, 1 - percent / 100], seed=seed)
    return train, test


def fit_fares(train: DataFrame, **overrides) -> LinearRegressionModel:
    """Fit the fare model; overrides go to ``LinearRegression``.

    The normal solver passes the rows once, through one tree aggregation of a state
    whose size does not depend on them.
    """
    settings = {"tol": TOLERANCE, **MODEL, "featuresCol": "features", "labelCol": "label", **overrides}
    return LinearRegression(**settings).fit(assemble(train))


def fit_errors(model: LinearRegressionModel) -> dict[str, float]:
    """Row count and standard errors of an unpenalised fit, by name."""
    miles, riders, intercept = model.summary.coefficientStandardErrors
    return {
        "n_rows": model.summary.numInstances,
        "se_intercept": intercept,
        "se_per_mile": miles,
        "se_per_passenger": riders,
    }


def predicted_fare(model: LinearRegressionModel, features: Sequence[str] = FEATURES) -> Column:
    """The model as a column expression, which Spark compiles into the scan's stage.

    Scoring through feature vectors gives the same numbers but builds a vector per row.
    """
    terms = [F.lit(float(c)) * F.col(f) for c, f in zip(model.coefficients, features)]
    return sum(terms[1:], terms[0]) + F.lit(float(model.intercept))


def score(df: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """Add ``prediction``. A row lacking a feature gets none."""
    return df.withColumn("prediction", predicted_fare(model))


def score_vectors(df: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """Add ``features`` and ``prediction`` the MLlib way; a null feature is an error."""
    return model.transform(assemble(df))


def fit_quality(scored: DataFrame) -> DataFrame:
    """Row count, RMSE and R² of a scored test set, in one pass."""
    error = F.col("label") - F.col("prediction")
    squares = F.sum(error * error)
    spread = F.var_pop("label") * F.count("label")
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1) - F.try_divide(squares, spread)).alias("r2"),
    )


def describe_model(
    spark: SparkSession, model: LinearRegressionModel, min_effect: float = 0.001
) -> DataFrame:
    """One row: intercept, coefficients, and the fare formula in words.

    The passenger term is left out of the formula unless it exceeds ``min_effect``.
    """
    miles, riders = model.coefficients
    fitted = spark.range(0, 1, 1, numPartitions=1).select(
        F.lit(float(model.intercept)).alias("intercept"),
        F.lit(float(miles)).alias("per_mile"),
        F.lit(float(riders)).alias("per_passenger"),
    )
    short = F.format_string("Fare = $%.2f + $%.2f*distance", "intercept", "per_mile")
    rider_term = F.format_string(" + $%.2f*passengers", "per_passenger")
    matters = F.abs("per_passenger") > min_effect
    return fitted.withColumn("formula", F.concat(short, F.when(matters, rider_term).otherwise("")))


def example_trips(spark: SparkSession) -> DataFrame:
    """Five trips of one passenger, for a quick look at a fresh model."""
    return _local_rows(spark, EXAMPLE_TRIPS, FEATURES)


def named_trips(spark: SparkSession) -> DataFrame:
    """Eight described trips to try a model on."""
    return _local_rows(spark, NAMED_TRIPS, [*FEATURES, "description"])


def _local_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few fixed rows, handed over as Arrow, which needs no Python worker."""
    return spark.createDataFrame(pa.table([list(column) for column in zip(*rows)], list(names)))


def distance_grid(
    spark: SparkSession, points: int = CURVE_POINTS, miles: float = CURVE_MILES
) -> DataFrame:
    """Evenly spaced distances from 0 to ``miles`` inclusive, one passenger each."""
    step = F.col("id") * float(miles) / (points - 1)
    return spark.range(points).select(
        step.alias("trip_distance"), F.lit(1.0).alias("passenger_count")
    )


def fare_curve(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """The model's fare over the distance grid."""
    return score(distance_grid(spark), model).select("trip_distance", "prediction")


def split_counts(
    trips: DataFrame, keys: Sequence[str], percent: int = TRAIN_PERCENT
) -> DataFrame:
    """All, usable, train and test rows, counted in one pass over the trips."""
    usable = in_training_range(label_column(trips))
    train = in_split(keys, percent)
    return trips.agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count_if(usable).alias("n_clean"),
        F.count_if(usable & train).alias("n_train"),
        F.count_if(usable & ~train).alias("n_test"),
    )


def trip_sample(
    trips: DataFrame, keys: Sequence[str | Column], fraction: float = SAMPLE_FRACTION
) -> DataFrame:
    """The trips whose key falls into the lowest ``fraction`` of the hash range.

    Every trip has the same chance wherever it lies in the table; nothing is counted or
    cut off, and any SQL engine can draw the same sample.
    """
    return trips.where(in_share(keys, fraction))
