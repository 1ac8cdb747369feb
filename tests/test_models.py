from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.operators import forests, learning
from tallyforge.plans import survival


@pytest.fixture(scope="module")
def passengers(spark):
    """1200 rows whose label mostly follows two of three features."""
    base = spark.range(1200).select(
        F.col("id"),
        (F.hash("id") % 100 / 50.0).alias("a"),
        (F.hash(F.col("id") + 7) % 100 / 50.0).alias("b"),
        (F.hash(F.col("id") + 13) % 100 / 50.0).alias("c"),
    )
    noise = F.hash(F.col("id") + 29) % 100 / 200.0
    return base.withColumn("label", F.when(F.col("a") + F.col("b") + noise > 0, 1).otherwise(0))


def test_assembling_nulls_is_a_choice(table):
    df = table([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        learning.assemble(df, ["a", "b"]).collect()
    assert learning.assemble(df, ["a", "b"], invalid="skip").count() == 1


def test_scaling(table, rows):
    df = learning.assemble(table([(1.0,), (2.0,), (3.0,)], "x double"), ["x"])
    plain = learning.vector_columns(learning.standardise(df).select("scaled"), "scaled", ["s"])
    assert rows(plain) == [(1.0,), (2.0,), (3.0,)]
    centred = learning.vector_columns(learning.standardise(df, centre=True).select("scaled"), "scaled", ["s"])
    assert rows(centred) == [(-1.0,), (0.0,), (1.0,)]


def test_split_depends_on_the_key_only(spark, rows):
    df = spark.range(5000)
    train, test = learning.split_by_key(df, "id")
    again, _ = learning.split_by_key(df.repartition(13), "id")
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83
    gaps = df.select(F.when(F.col("id") < 10, F.col("id")).alias("id"))
    assert sum(part.count() for part in learning.split_by_key(gaps, "id")) == 5000


def test_scores_agree_with_the_evaluator(table):
    pairs = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 7 + [(1, 2.0)] * 1 + [(2, 2.0)] * 3 + [(2, 0.0)] * 4
    df = table(pairs, "label int, prediction double")
    scores = learning.classification_scores(df, "label").first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs)
        assert scores[ours] == pytest.approx(evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))))
    assert scores["rows"] == len(pairs)


def test_logistic_search_and_forest(passengers):
    train, test = survival.training_and_test(passengers, "id")
    features = ["a", "b", "c"]
    model = survival.fit_logistic(train, features, "label")
    best = model.stages[-1]
    assert best.getRegParam() in (0.1, 0.01) and best.getMaxIter() in (10, 20)
    scored = model.transform(test)
    assert learning.classification_scores(scored, "label").first()["accuracy"] > 0.85

    row = scored.first()
    margin = sum(w * row[f] for w, f in zip(best.coefficients, features)) + best.intercept
    assert row["probability"][1] == pytest.approx(1 / (1 + math.exp(-margin)))

    forest = survival.fit_forest(train, features, "label")
    assert forest.stages[-1].getNumTrees == 10
    exported = learning.exportable_predictions(forest.transform(test), "label")
    assert exported.columns == ["label", "prediction", "features"]
    assert dict(exported.dtypes)["features"] == "string"
    first = test.orderBy("id").first()
    assert f"[{first['a']},{first['b']},{first['c']}]" in {r["features"] for r in exported.collect()}


def test_ridge_search_against_a_fit_for_every_fold(spark, rows):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 3)) * [1, 50, 0.01] + [1e5, 0, 3]
    y = x @ [2.0, 0.1, 40.0] + draw.normal(size=600) + 1e6
    values = [(k, *map(float, x[k]), float(y[k])) for k in range(600)] + [(600, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(values, "id int, a double, b double, c double, y double")
    fold = {r["id"]: r["fold"] for r in df.select("id", learning.fold_of("id", 4).alias("fold")).collect()}
    found = rows(learning.ridge_search(df, ["a", "b", "c"], "y", "id", [0.0, 0.3], folds=4))
    assert [(f, p) for f, p, *_ in found] == [(f, p) for f in range(4) for p in (0.0, 0.3)]
    for f, penalty, n, rmse, r2 in found:
        own = np.array([fold[k] == f for k in range(600)])
        mean, deviation = x[~own].mean(axis=0), x[~own].std(axis=0)
        z = (x[~own] - mean) / deviation
        w = np.linalg.solve(z.T @ z / len(z) + penalty * np.eye(3), z.T @ (y[~own] - y[~own].mean()) / len(z))
        gap = y[own] - y[~own].mean() - ((x[own] - mean) / deviation) @ w
        assert n == own.sum() and rmse == pytest.approx(np.sqrt((gap**2).mean()), rel=1e-6)
        assert r2 == pytest.approx(1 - (gap**2).sum() / ((y[own] - y[own].mean()) ** 2).sum(), abs=1e-6)


def test_ridge_search_of_odd_rows(table, rows):
    df = table([(k, 1.0, float(k), 5.0) for k in range(12)], "id int, a double, b double, y double")
    found = rows(learning.ridge_search(df, ["a", "b"], "y", "id", [0.0], folds=2))
    assert [r2 for *_, r2 in found] == [None, None] and all(rmse < 1e-9 for *_, rmse, _ in found)
    assert learning.ridge_search(df.limit(0), ["a"], "y", "id").collect() == []
    assert learning.ridge_search(df.limit(1), ["a"], "y", "id").collect() == []


def test_a_walk_through_the_nodes_predicts_as_the_model(spark, passengers):
    train, test = survival.training_and_test(passengers, "id")
    model = survival.fit_forest(train, ["a", "b", "c"], "label")
    nodes = forests.forest_table(spark, model.stages[-1])
    assert nodes.select("tree").distinct().count() == 10
    assert nodes.filter("(left IS NULL) <> (votes IS NOT NULL)").count() == 0
    assert nodes.filter("votes IS NOT NULL AND abs(votes[0] + votes[1] - 1) > 1e-12").count() == 0
    walked = forests.walk(test, nodes, "id", ["a", "b", "c"], model.stages[-1].getMaxDepth())
    both = walked.join(model.transform(test).withColumnRenamed("prediction", "expected"), "id").select(
        "prediction", "expected", "votes", vector_to_array("rawPrediction").alias("raw")
    )
    found = both.collect()
    assert len(found) == test.count()
    assert all(r["prediction"] == r["expected"] and r["votes"] == r["raw"] for r in found)
    assert forests.walk(test.limit(0), nodes, "id", ["a", "b", "c"], 5).count() == 0
    gap = test.limit(5).withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a")))
    assert forests.walk(gap, nodes, "id", ["a", "b", "c"], 5).count() == gap.filter("a IS NOT NULL").count()


def test_the_search_table_is_made_from_out_of_fold_predictions(passengers):
    report, predictions = survival.search_report(passengers, ["a", "b", "c"], "label", "id", folds=3)
    rows = report.collect()
    assert len(rows) == 4 * 3
    cells = defaultdict(list)
    for r in predictions.collect():
        cells[r["regParam"], r["maxIter"], r["fold"]].append((r["label"], int(r["prediction"])))
    folds = {r["id"]: r["fold"] for r in passengers.select("id", learning.fold_of("id", 3).alias("fold")).collect()}
    for r in rows:
        pairs = cells[r["regParam"], r["maxIter"], r["fold"]]
        assert r["rows"] == len(pairs) == sum(f == r["fold"] for f in folds.values())
        assert r["accuracy"] == pytest.approx(sum(a == p for a, p in pairs) / len(pairs))
        parts = []
        for c in (0, 1):
            hits, actual, predicted = sum(a == p == c for a, p in pairs), sum(a == c for a, _ in pairs), sum(p == c for _, p in pairs)
            precision, recall = hits / predicted if predicted else 0, hits / actual if actual else 0
            parts.append((actual, precision, recall, 2 * precision * recall / (precision + recall) if precision + recall else 0))
        for k, name in enumerate(("precision", "recall", "f1"), 1):
            assert r[name] == pytest.approx(sum(p[0] * p[k] for p in parts) / len(pairs))


def test_classifiers_beat_the_larger_class_on_a_label_that_can_be_learned(passengers):
    train, test = survival.training_and_test(passengers, "id")
    scores = learning.classification_scores(survival.fit_forest(train, ["a", "b", "c"], "label").transform(test), "label").first()
    larger = max(r["count"] for r in test.groupBy("label").count().collect())
    assert scores["accuracy"] > larger / test.count() + 0.1
