"""Train, evaluate and save the fare model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Row

from fareflow.functions import in_hash_split
from fareflow.operators.fares import (
    describe_model,
    example_trips,
    fit_fares,
    fit_quality,
    score,
    stable_split,
    training_set,
)
from fareflow.schema import DROPOFF, PICKUP

# Trips carry no key, so the split hashes the columns that tell them apart.
SPLIT_KEYS = ("vendorid", PICKUP, DROPOFF, "trip_distance", "total_amount")


@dataclass
class TrainReport:
    model: LinearRegressionModel
    summary: Row
    quality: Row
    examples: DataFrame


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for the length of the block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def train_fares(
    trips: DataFrame,
    model_path: str,
    split_keys: Sequence[str] = SPLIT_KEYS,
    keep_in_memory: bool = False,
    chooser: Callable[[Sequence[str], int], Column] = in_hash_split,
) -> TrainReport:
    """Fit on the train part of the lake's trips, evaluate on the rest, save the model.

    ``chooser`` splits by key; ``in_split`` gives a split that other engines can repeat.

    The two passes read a handful of columns each, which beats storing the cleaned
    rows unless the cluster's memory holds them: then pass ``keep_in_memory``.
    """
    # Named apart from the features, which are cast to double on the way.
    keys = [trips[name].alias(f"key_{name}") for name in split_keys]
    usable = training_set(trips, keep=keys)
    names = [f"key_{name}" for name in split_keys]
    if not keep_in_memory:
        return _train(usable, names, model_path, chooser)
    with persisted(usable) as kept:
        return _train(kept, names, model_path, chooser)


def _train(
    usable: DataFrame, keys: Sequence[str], model_path: str, chooser: Callable[[Sequence[str], int], Column]
) -> TrainReport:
    spark = usable.sparkSession
    train, test = stable_split(usable, keys, chooser=chooser)
    model = fit_fares(train)
    model.write().overwrite().save(model_path)
    return TrainReport(
        model=model,
        summary=describe_model(spark, model).first(),
        quality=fit_quality(score(test, model)).first(),
        examples=score(example_trips(spark), model),
    )
