"""Features, splits, models and evaluation on ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.memory import table_from_rows

SEED = 42


def assembler(columns: Sequence[str], into: str = "features", invalid: str = "error") -> VectorAssembler:
    """Numeric columns to one vector. ``invalid``: what to do on nulls (error, skip or keep)."""
    return VectorAssembler(inputCols=list(columns), outputCol=into, handleInvalid=invalid)


def assemble(df: DataFrame, columns: Sequence[str], into: str = "features", invalid: str = "error") -> DataFrame:
    return assembler(columns, into, invalid).transform(df)


def standardise(df: DataFrame, source: str = "features", into: str = "scaled", centre: bool = False) -> DataFrame:
    """Unit sample deviation, optionally zero mean. The moments come from one tree aggregate."""
    return StandardScaler(inputCol=source, outputCol=into, withMean=centre, withStd=True).fit(df).transform(df)


def vector_columns(df: DataFrame, source: str, names: Sequence[str]) -> DataFrame:
    """A vector's entries as plain columns."""
    return df.withColumn("_entries", vector_to_array(source)).select(
        *[c for c in df.columns if c != source], *[F.col("_entries")[i].alias(n) for i, n in enumerate(names)]
    )


def in_training(key: str, percent: int = 80):
    """Whether a row belongs to the training share, decided by a digest of its key.

    The same rows are chosen whatever the partitioning, and in any engine that has MD5. A null
    key counts as empty text, so that no row falls out of both shares.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return (head % 100) < percent


def split_by_key(df: DataFrame, key: str, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    return df.filter(in_training(key, percent)), df.filter(~in_training(key, percent))


def linear_regression(df: DataFrame, features: str, label: str, **params) -> Model:
    return LinearRegression(featuresCol=features, labelCol=label, **params).fit(df)


def logistic_search(
    train: DataFrame,
    label: str,
    stages: Sequence,
    features: str = "features",
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    parallelism: int = 4,
    fold: str | None = None,
) -> CrossValidatorModel:
    """Grid search over a logistic regression by k-fold cross validation, scored by weighted F1.

    ``stages`` (encoding, assembling, scaling) are fitted inside each fold. ``fold`` names a column with the number of each
    row's fold, and the models of the folds are kept; see ``out_of_fold``. Without it give a stored table: folds are
    then drawn by a seeded generator, which repeats only over repeatable input.
    """
    estimator = LogisticRegression(labelCol=label, featuresCol=features)
    builder = ParamGridBuilder()
    # The searched grid.
    for name, values in (grid or {"regParam": [0.1, 0.01], "maxIter": [10, 20]}).items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    search = CrossValidator(
        estimator=Pipeline(stages=[*stages, estimator]),
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(labelCol=label),
        numFolds=folds,
        seed=SEED,
        parallelism=parallelism,
    )
    return (search.setFoldCol(fold).setCollectSubModels(True) if fold else search).fit(train)


def out_of_fold(search: CrossValidatorModel, train: DataFrame, key: str, label: str, fold: str) -> DataFrame:
    """``key, fold, label, prediction`` and the searched parameters: each row by the models that did not see it, one for each grid point."""
    parts = []
    for number, models in enumerate(search.subModels):
        held = train.filter(F.col(fold) == number)
        for model, point in zip(models, search.getEstimatorParamMaps(), strict=True):
            chosen = [F.lit(value).alias(param.name) for param, value in point.items()]
            parts.append(model.transform(held).select(*chosen, key, fold, label, "prediction"))
    return reduce(DataFrame.unionByName, parts)


def random_forest(label: str, features: str = "features", trees: int = 10) -> Estimator:
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, seed=SEED)


def classification_scores(predictions: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """One row for each group ``by``: accuracy and label-weighted precision, recall and F1, from one pass.

    Predictions shrink to the confusion table, one row per pair of classes, before anything else.
    """
    cells = predictions.groupBy(
        *by, F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("predicted")
    ).agg(F.count("*").alias("n"))
    # Every cell counts once for its actual and once for its predicted class.
    sides = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.col("n").alias("actual_n"),
                    F.lit(0).cast("long").alias("predicted_n"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit_n"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("long").alias("actual_n"),
                    F.col("n").alias("predicted_n"),
                    F.lit(0).cast("long").alias("hit_n"),
                ),
            )
        ),
    )
    per_class = sides.groupBy(*by, "class").agg(
        F.sum("actual_n").alias("actual_n"), F.sum("predicted_n").alias("predicted_n"), F.sum("hit_n").alias("hit_n")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit_n", "predicted_n"), zero)
    recall = F.coalesce(F.try_divide("hit_n", "actual_n"), zero)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * precision * recall, precision + recall), zero)
    weight = F.col("actual_n")
    return per_class.groupBy(*by).agg(
        F.sum("actual_n").alias("rows"),
        (F.sum("hit_n") / F.sum("actual_n")).alias("accuracy"),
        (F.sum(precision * weight) / F.sum(weight)).alias("precision"),
        (F.sum(recall * weight) / F.sum(weight)).alias("recall"),
        (F.sum(f1 * weight) / F.sum(weight)).alias("f1"),
    )


def exportable_predictions(predictions: DataFrame, label: str, features: str = "features", keys: Sequence[str] = ()) -> DataFrame:
    """Keys, label, prediction and the features as text, ready for a table sink without a vector type."""
    return predictions.select(
        *keys,
        label,
        "prediction",
        F.concat(F.lit("["), F.array_join(vector_to_array(features).cast("array<string>"), ","), F.lit("]")).alias(
            features
        ),
    )


def fold_of(key: str, folds: int) -> Column:
    """The fold of a row, from 0, by a digest of its key; a null key counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % folds).cast("int")


def ridge_search(
    df: DataFrame, features: Sequence[str], label: str, key: str, penalties: Sequence[float] = (0.0, 0.1, 1.0), folds: int = 5
) -> DataFrame:
    """Held-out scores of ridge regressions: ``fold, penalty, rows, rmse, r2`` (training rows are those of the other folds).

    One aggregate gives the sums of products of features and label of each fold, and everything comes from these: the
    sums without a fold are the total less its own, every penalty is solved from them, and the errors on the fold
    follow from its own sums. So the rows are read once, whatever the numbers of folds and penalties, and what reaches the
    driver is one row for each fold. Products are taken after subtracting the means of the first scan, so that they keep
    their digits.

    Features are scaled to unit deviation (of the training rows, by their number), the intercept is not drawn to zero and
    the penalty is per training row, as ``LinearRegression`` does with ``elasticNetParam=0`` up to the scaling of the label.
    Incomplete rows are left out. A fold without rows gives none; ``r2`` is null if the label is constant in the fold.
    A direction without variance is given no weight.
    """
    names = [*features, label]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names], fold_of(key, folds).alias("fold")).na.drop()
    centre = rows.agg(*[F.avg(c).alias(c) for c in names])
    near = rows.join(F.broadcast(centre.withColumnsRenamed({c: f"_m_{c}" for c in names})))
    shifted = near.select("fold", *[(F.col(c) - F.col(f"_m_{c}")).alias(f"x{i}") for i, c in enumerate(names)])
    size = len(names)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = shifted.groupBy("fold").agg(
        F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(size)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]
    )
    parts = {}
    for r in sums.collect():  # one row for each fold
        cross = np.zeros((size + 1, size + 1))
        cross[0, 0], cross[0, 1:], cross[1:, 0] = r["n"], [r[f"s{i}"] for i in range(size)], [r[f"s{i}"] for i in range(size)]
        for i, j in pairs:
            cross[i + 1, j + 1] = cross[j + 1, i + 1] = r[f"p{i}_{j}"]
        parts[r["fold"]] = cross
    total = sum(parts.values()) if parts else None
    found = []
    for fold, own in sorted(parts.items()):
        for penalty in penalties:
            weights = _ridge(total - own, penalty)
            if weights is not None:
                # Squared errors on the fold: the sums of products, weighted by (intercept, weights, -1) on both sides.
                line = np.append(weights, -1.0)
                error, spread = float(line @ own @ line), float(own[-1, -1] - own[0, -1] ** 2 / own[0, 0])
                found.append((fold, float(penalty), int(own[0, 0]), math.sqrt(max(0.0, error) / own[0, 0]), 1 - error / spread if spread > 0 else None))
    return table_from_rows(df.sparkSession, found, "fold int, penalty double, rows long, rmse double, r2 double")


def _ridge(cross: np.ndarray, penalty: float) -> np.ndarray | None:
    """Intercept and weights from sums of products (first the count, last the label); None without rows."""
    n = cross[0, 0]
    if n <= 0:
        return None
    mean = cross[0, 1:] / n
    cov = cross[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
    used = np.flatnonzero(scale > 1e-12 * np.maximum(1.0, np.abs(mean[:-1])))
    weights = np.zeros(len(scale))
    if len(used):
        inside = cov[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        weights[used] = np.linalg.lstsq(inside + penalty * np.eye(len(used)), cov[used, -1] / scale[used], rcond=None)[0] / scale[used]
    return np.append(mean[-1] - weights @ mean[:-1], weights)
