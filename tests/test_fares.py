import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from fareflow.operators import fares
from fareflow.sources.tables import fares_from_tables
from tests.helpers import collected, make_trips


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return fares.training_set(fares_from_tables(spark, sf_dir), keep=["trip_id"]).persist()


@pytest.fixture(scope="module")
def model(rows):
    return fares.fit_fares(rows)


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"trip_distance": 0.0}, 0),
        ({"trip_distance": 0.1}, 1),
        ({"trip_distance": 100.0}, 1),
        ({"trip_distance": 100.1}, 0),
        ({"trip_distance": None}, 0),
        ({"trip_distance": float("nan")}, 0),
        ({"fare_amount": 2.5}, 0),
        ({"fare_amount": 2.51}, 1),
        ({"fare_amount": 199.9}, 1),
        ({"fare_amount": 200.0}, 0),
        ({"fare_amount": None}, 0),
        ({"passenger_count": 0}, 0),
        ({"passenger_count": 6}, 1),
        ({"passenger_count": 7}, 0),
        ({"passenger_count": None}, 0),
        ({"tpep_dropoff_datetime": None}, 1),
    ],
)
def test_training_ranges(spark, change, kept):
    assert fares.training_set(make_trips(spark, change)).count() == kept


def test_training_columns_are_doubles(spark):
    want = [("trip_distance", "double"), ("passenger_count", "double"), ("label", "double")]
    assert fares.training_set(make_trips(spark, {})).dtypes == want


def test_label_choice(spark):
    trips = make_trips(spark, {})
    assert fares.label_column(trips) == "fare_amount"
    assert fares.label_column(trips.drop("fare_amount")) == "total_amount"
    with pytest.raises(ValueError, match="label"):
        fares.label_column(trips.drop("fare_amount", "total_amount"))


def test_stable_split_covers_input_and_ignores_partitioning(rows):
    train, test = fares.stable_split(rows, ["trip_id"])
    ids = lambda df: {r.trip_id for r in df.select("trip_id").collect()}
    assert not ids(train) & ids(test)
    assert train.count() + test.count() == rows.count()
    again, _ = fares.stable_split(rows.repartition(7), ["trip_id"])
    assert ids(again) == ids(train)


def test_random_split_covers_input(rows):
    train, test = fares.random_split(rows)
    total = rows.count()
    assert train.count() + test.count() == total
    assert abs(train.count() / total - 0.8) < 0.05


def test_null_feature_is_an_error_for_vectors(spark, model):
    trips = spark.createDataFrame([(None, 1.0)], "trip_distance double, passenger_count double")
    with pytest.raises(Exception, match="null"):
        fares.assemble(trips).collect()
    assert fares.score(trips, model).first().prediction is None


def test_fit_with_constant_feature(spark):
    rows = [(float(d), 1.0, 3.0 + 2.5 * d) for d in range(1, 40)]
    train = spark.createDataFrame(rows, "trip_distance double, passenger_count double, label double")
    model = fares.fit_fares(train, regParam=0.0)
    assert model.intercept == pytest.approx(3.0, abs=1e-6)
    assert list(model.coefficients) == pytest.approx([2.5, 0.0], abs=1e-6)


def test_fit_needs_rows(rows):
    with pytest.raises(Exception, match="(?i)empty|no training rows|instances|requirement"):
        fares.fit_fares(rows.limit(0))


def test_fit_takes_any_setting(rows):
    """What only a fit of the rows themselves gets right."""
    robust = fares.fit_fares(rows, loss="huber", elasticNetParam=0.0, solver="l-bfgs", tol=1e-6)
    assert robust.intercept != pytest.approx(fares.fit_fares(rows).intercept, abs=1e-3)
    weighted = fares.fit_fares(rows.withColumn("w", F.lit(2.0)), weightCol="w", regParam=0.0)
    assert weighted.intercept == pytest.approx(fares.fit_fares(rows, regParam=0.0).intercept, abs=1e-6)
    assert fares.fit_errors(fares.fit_fares(rows, regParam=0.0))["n_rows"] == rows.count()


def test_fit_against_coordinate_descent(rows, model):
    """The same objective minimised independently, one coefficient at a time."""
    data = np.array(rows.select(*fares.FEATURES, "label").collect(), dtype=float)
    x, y = data[:, :2], data[:, 2]
    sx, sy = x.std(axis=0), y.std()
    xs, ys = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    lam = fares.MODEL["regParam"] / sy
    l1, l2 = lam * fares.MODEL["elasticNetParam"], lam * (1 - fares.MODEL["elasticNetParam"])
    beta = np.zeros(2)
    for _ in range(200):
        for j in range(2):
            rest = ys - xs @ beta + xs[:, j] * beta[j]
            pull = (xs[:, j] * rest).mean()
            beta[j] = np.sign(pull) * max(abs(pull) - l1, 0) / (1 + l2)
    want = beta * sy / sx
    assert list(model.coefficients) == pytest.approx(list(want), abs=1e-3)
    assert model.intercept == pytest.approx(y.mean() - want @ x.mean(axis=0), abs=1e-3)


def test_score_equals_transform(rows, model):
    both = fares.score_vectors(rows, model).withColumn("expected", F.col("prediction"))
    both = fares.score(both.drop("prediction"), model)
    assert both.where(F.abs(F.col("prediction") - F.col("expected")) > 1e-9).isEmpty()


def test_quality_equals_evaluator(rows, model):
    scored = fares.score(rows, model).persist()
    mine = fares.fit_quality(scored).first()
    for name in ("rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="label", metricName=name).evaluate(scored)
        assert mine[name] == pytest.approx(theirs, abs=1e-9)
    assert mine.n == rows.count()


def test_saved_model_scores_alike(rows, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = LinearRegressionModel.load(str(tmp_path / "m"))
    assert loaded.intercept == model.intercept
    assert list(loaded.coefficients) == list(model.coefficients)
    assert loaded.evaluate(fares.assemble(rows)).rootMeanSquaredError > 0


def test_formula_mentions_passengers_only_if_they_matter(spark):
    train = spark.createDataFrame(
        [(float(d), float(p), 3.0 + 2.5 * d + 0.5 * p) for d in range(1, 20) for p in range(1, 7)],
        "trip_distance double, passenger_count double, label double",
    )
    model = fares.fit_fares(train, regParam=0.0)
    full = fares.describe_model(spark, model).first()
    assert full.formula == "Fare = $3.00 + $2.50*distance + $0.50*passengers"
    short = fares.describe_model(spark, model, min_effect=0.6).first()
    assert short.formula == "Fare = $3.00 + $2.50*distance"


def test_curve_spans_the_grid(spark, model):
    curve = fares.fare_curve(spark, model).orderBy("trip_distance").collect()
    distances = [r.trip_distance for r in curve]
    assert distances == pytest.approx(list(np.linspace(0, 50, 100)))
    slope = (curve[-1].prediction - curve[0].prediction) / 50
    assert slope == pytest.approx(float(model.coefficients[0]))


def test_inline_trips(spark, model):
    assert collected(fares.example_trips(spark), "trip_distance")[-1] == (20.0,)
    scored = fares.score(fares.named_trips(spark), model)
    assert scored.count() == 8 and scored.where("prediction IS NULL").isEmpty()


def test_sample_reaches_every_part_of_the_table(spark):
    trips = spark.range(0, 200_000, numPartitions=8)
    sample = fares.trip_sample(trips, ["id"], fraction=0.01)
    ids = sorted(r.id for r in sample.collect())
    assert len(ids) == len(set(ids)) and 1_800 < len(ids) < 2_200
    tenths = [sum(k * 20_000 <= i < (k + 1) * 20_000 for i in ids) for k in range(10)]
    assert min(tenths) > 140
    again = fares.trip_sample(trips.repartition(3), ["id"], fraction=0.01)
    assert sorted(r.id for r in again.collect()) == ids
    assert fares.trip_sample(trips, ["id"], fraction=1.0).count() == 200_000
    assert fares.trip_sample(trips, ["id"], fraction=0.0).isEmpty()


def test_counts_in_one_pass(spark, sf_dir, rows):
    row = fares.split_counts(fares_from_tables(spark, sf_dir), ["trip_id"]).first()
    train, test = fares.stable_split(rows, ["trip_id"])
    assert row.n_clean == rows.count()
    assert (row.n_train, row.n_test) == (train.count(), test.count())
    assert row.n_trips == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
