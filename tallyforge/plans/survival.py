"""Two classifiers on encoded rows: encode, assemble, split, fit, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame

from tallyforge.functions.categories import encode
from tallyforge.operators.learning import (
    assembler,
    classification_scores,
    fold_of,
    logistic_search,
    out_of_fold,
    random_forest,
    split_by_key,
)
from tallyforge.session import stage_table

# The passenger data's categories.
PASSENGER_CODES = {"Sex": ({"male": 1}, 0), "Embarked": ({"S": 0, "C": 1, "Q": 2}, 3)}


def encoded(df: DataFrame, codes: Mapping[str, tuple[Mapping, int]]) -> DataFrame:
    return df.withColumns({c: encode(c, mapping, default) for c, (mapping, default) in codes.items()})


def training_and_test(df: DataFrame, key: str, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The rows stored once and split by key; model fitting reads the stored table many times."""
    return split_by_key(stage_table(df, "classifier-rows"), key, percent)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str):
    """Best logistic regression of a cross-validated grid."""
    return logistic_search(train, label, [assembler(features)]).bestModel


def search_report(train: DataFrame, features: Sequence[str], label: str, key: str, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """The search as a table, one row for each grid point and fold with its scores, and the predictions that it is made from.

    Folds are given by a digest of the key, so any engine finds the same. The predictions are stored: each row by the
    models that were fitted without it.
    """
    dealt = stage_table(train.withColumn("fold", fold_of(key, folds)), "folds")
    search = logistic_search(dealt, label, [assembler(features)], folds=folds, fold="fold")
    predictions = stage_table(out_of_fold(search, dealt, key, label, "fold"), "out-of-fold")
    points = [c for c in predictions.columns if c not in (key, "fold", label, "prediction")]
    return classification_scores(predictions, label, by=[*points, "fold"]), predictions


def fit_forest(train: DataFrame, features: Sequence[str], label: str):
    return Pipeline(stages=[assembler(features), random_forest(label)]).fit(train)
