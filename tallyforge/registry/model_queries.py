"""Features and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.forests import forest_table, walk
from tallyforge.operators.learning import (
    assemble,
    classification_scores,
    exportable_predictions,
    in_training,
    linear_regression,
    ridge_search,
    standardise,
    vector_columns,
)
from tallyforge.plans.housing import fit_price, fit_report
from tallyforge.plans.survival import encoded, fit_forest, fit_logistic, search_report, training_and_test
from tallyforge.registry.catalog import Catalog
from tallyforge.sources.memory import table_from_rows
from tallyforge.sources.tables import Tables

catalog = Catalog()

_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_KEY = ["l_orderkey", "l_linenumber"]


def _vectors(t: Tables) -> DataFrame:
    return assemble(t.lineitem.select(*_KEY, *_FEATURES), _FEATURES)


@catalog.query("SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem")
def ml_assemble(t: Tables) -> DataFrame:
    return vector_columns(_vectors(t).select(*_KEY, "features"), "features", ["f0", "f1", "f2"])


def _rounded_entries(df: DataFrame) -> DataFrame:
    entries = vector_columns(df.select(*_KEY, "scaled"), "scaled", ["f0", "f1", "f2"])
    return entries.withColumns({f: F.round(f, 6) + 0.0 for f in ("f0", "f1", "f2")})


@catalog.query(
    """WITH s AS (SELECT STDDEV_SAMP(l_quantity) AS s0, STDDEV_SAMP(l_discount) AS s1, STDDEV_SAMP(l_tax) AS s2
                  FROM lineitem)
       SELECT l_orderkey, l_linenumber, ROUND(l_quantity / s0, 6) AS f0, ROUND(l_discount / s1, 6) AS f1,
              ROUND(l_tax / s2, 6) AS f2
       FROM lineitem CROSS JOIN s"""
)
def ml_scale_std(t: Tables) -> DataFrame:
    return _rounded_entries(standardise(_vectors(t)))


@catalog.query(
    """WITH s AS (SELECT STDDEV_SAMP(l_quantity) AS s0, STDDEV_SAMP(l_discount) AS s1, STDDEV_SAMP(l_tax) AS s2,
                         AVG(l_quantity) AS m0, AVG(l_discount) AS m1, AVG(l_tax) AS m2
                  FROM lineitem)
       SELECT l_orderkey, l_linenumber, ROUND((l_quantity - m0) / s0, 6) AS f0,
              ROUND((l_discount - m1) / s1, 6) AS f1, ROUND((l_tax - m2) / s2, 6) AS f2
       FROM lineitem CROSS JOIN s"""
)
def ml_scale_zscore(t: Tables) -> DataFrame:
    return _rounded_entries(standardise(_vectors(t), centre=True))


@catalog.query(
    """SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
              ROUND(SQRT(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity))
                         / regr_count(l_extendedprice, l_quantity)), 4) AS rmse
       FROM lineitem"""
)
def ml_linear_regression(t: Tables) -> DataFrame:
    rows = assemble(t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity"])
    model = linear_regression(rows, "features", "l_extendedprice", solver="normal")
    found = (
        round(float(model.coefficients[0]), 4),
        round(float(model.intercept), 4),
        round(float(model.summary.r2), 6),
        round(float(model.summary.rootMeanSquaredError), 4),
    )
    return table_from_rows(t.spark, [found], "slope double, intercept double, r2 double, rmse double")


@catalog.query(
    """WITH m AS (SELECT VAR_SAMP(l_quantity) AS s11, VAR_SAMP(l_discount) AS s22, VAR_SAMP(l_extendedprice) AS syy,
                         COVAR_SAMP(l_quantity, l_discount) AS s12, COVAR_SAMP(l_quantity, l_extendedprice) AS s1y,
                         COVAR_SAMP(l_discount, l_extendedprice) AS s2y, AVG(l_quantity) AS m1, AVG(l_discount) AS m2,
                         AVG(l_extendedprice) AS my, COUNT(*) AS n
                  FROM lineitem),
            b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
                         (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
            f AS (SELECT *, b1 * s1y + b2 * s2y AS explained FROM b)
       SELECT 'weight_l_quantity' AS term, ROUND(b1 * SQRT(s11), 3) AS value FROM f
       UNION ALL SELECT 'weight_l_discount', ROUND(b2 * SQRT(s22), 3) FROM f
       UNION ALL SELECT 'intercept', ROUND(my - b1 * m1 - b2 * m2, 3) FROM f
       UNION ALL SELECT 'rmse', ROUND(SQRT((syy - explained) * (n - 1) / n), 3) FROM f
       UNION ALL SELECT 'r2', ROUND(explained / syy, 3) FROM f"""
)
def housing_regression(t: Tables) -> DataFrame:
    features = ["l_quantity", "l_discount"]
    model, scaled = fit_price(t.lineitem, features, "l_extendedprice")
    return fit_report(model, scaled, features).withColumn("value", F.round("value", 3))


@catalog.query(
    """WITH numbered AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y,
                            CAST(CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold
                     FROM lineitem),
            folds AS (SELECT DISTINCT fold FROM numbered),
            m AS (SELECT folds.fold, VAR_POP(a) AS aa, VAR_POP(b) AS bb, COVAR_POP(a, b) AS ab, COVAR_POP(a, y) AS ay,
                         COVAR_POP(b, y) AS by_, AVG(a) AS ma, AVG(b) AS mb, AVG(y) AS my
                  FROM folds JOIN numbered ON numbered.fold <> folds.fold GROUP BY folds.fold),
            z AS (SELECT *, ab / SQRT(aa * bb) AS r, ay / SQRT(aa) AS u, by_ / SQRT(bb) AS v, 1 + penalty AS d
                  FROM m, (SELECT unnest([0.0, 0.5, 2.0]::DOUBLE[]) AS penalty)),
            w AS (SELECT fold, penalty, ma, mb, my, (u * d - v * r) / (d * d - r * r) / SQRT(aa) AS wa,
                         (v * d - u * r) / (d * d - r * r) / SQRT(bb) AS wb FROM z),
            e AS (SELECT w.fold, penalty, y, y - my - wa * (a - ma) - wb * (b - mb) AS gap FROM w JOIN numbered USING (fold))
       SELECT fold, penalty, COUNT(*) AS "rows", ROUND(SQRT(AVG(gap * gap)), 3) AS rmse,
              ROUND(1 - SUM(gap * gap) / (COUNT(*) * VAR_POP(y)), 6) AS r2
       FROM e GROUP BY fold, penalty"""
)
def ml_ridge_cv(t: Tables) -> DataFrame:
    found = ridge_search(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice", "l_orderkey", [0.0, 0.5, 2.0], folds=3)
    return found.withColumns({"rmse": F.round("rmse", 3), "r2": F.round("r2", 6)})


@catalog.query(
    """SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS training
       FROM orders"""
)
def ml_split(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", in_training("o_orderkey").alias("training"))


@catalog.query(
    """WITH p AS (SELECT quality AS actual, CASE WHEN n_chars > 900 THEN 1 ELSE 0 END AS predicted
                  FROM labels JOIN documents USING (doc_id)),
            k AS (SELECT DISTINCT actual AS class FROM p UNION SELECT DISTINCT predicted FROM p),
            c AS (SELECT class, COUNT(*) FILTER (actual = class) AS a, COUNT(*) FILTER (predicted = class) AS q,
                         COUNT(*) FILTER (actual = class AND predicted = class) AS h FROM p CROSS JOIN k GROUP BY class),
            m AS (SELECT *, CASE WHEN q = 0 THEN 0 ELSE h / q END AS pr, CASE WHEN a = 0 THEN 0 ELSE h / a END AS re FROM c)
       SELECT CAST(SUM(a) AS BIGINT) AS "rows", ROUND(SUM(h) / SUM(a), 6) AS accuracy, ROUND(SUM(pr * a) / SUM(a), 6) AS "precision",
              ROUND(SUM(re * a) / SUM(a), 6) AS recall,
              ROUND(SUM(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END * a) / SUM(a), 6) AS f1
       FROM m"""
)
def ml_evaluate(t: Tables) -> DataFrame:
    rule = F.when(F.col("n_chars") > 900, 1).otherwise(0)
    predictions = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "quality", rule.alias("prediction")
    )
    scores = classification_scores(predictions, "quality")
    return scores.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


_DOCUMENT_FEATURES = ["n_chars", "n_words", "n_lines", "lang", "toxic"]
_SCORES = ("accuracy", "precision", "recall", "f1")


def _classifier_rows(t: Tables) -> DataFrame:
    """Labelled documents: whether the quality is good, from size, language and the other label."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id",
        "quality",
        "toxic",
        "n_chars",
        F.regexp_count("text", F.lit(r"\S+")).alias("n_words"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("n_lines"),
        "lang",
    )
    return encoded(rows, {"lang": ({"en": 0, "fr": 1, "de": 2}, 3)})


def _fitted_forest(t: Tables):
    train, test = training_and_test(_classifier_rows(t), "doc_id")
    return fit_forest(train, _DOCUMENT_FEATURES, "quality"), test


def _scored(predictions: DataFrame) -> DataFrame:
    return classification_scores(predictions, "quality").withColumns({c: F.round(c, 6) for c in _SCORES})


@catalog.query()
def ml_logistic_cv(t: Tables) -> DataFrame:
    """Scores of the best logistic regression on the test rows."""
    train, test = training_and_test(_classifier_rows(t), "doc_id")
    return _scored(fit_logistic(train, _DOCUMENT_FEATURES, "quality").transform(test))


@catalog.query()
def ml_logistic_search(t: Tables) -> DataFrame:
    """The search itself: one row for each grid point and fold, scored on the rows of the fold."""
    train, _ = training_and_test(_classifier_rows(t), "doc_id")
    report, _ = search_report(train, _DOCUMENT_FEATURES, "quality", "doc_id")
    return report.withColumns({c: F.round(c, 6) for c in _SCORES})


@catalog.query()
def ml_random_forest(t: Tables) -> DataFrame:
    """Scores of a random forest on the test rows."""
    model, test = _fitted_forest(t)
    return _scored(model.transform(test))


@catalog.query()
def ml_predictions_export(t: Tables) -> DataFrame:
    """Label, prediction and features as text of every test row."""
    model, test = _fitted_forest(t)
    return exportable_predictions(model.transform(test), "quality", keys=["doc_id"])


@catalog.query()
def ml_forest_table(t: Tables) -> DataFrame:
    """The nodes of the fitted forest."""
    model, _ = _fitted_forest(t)
    return forest_table(t.spark, model.stages[-1])


@catalog.query()
def ml_forest_walk(t: Tables) -> DataFrame:
    """Prediction of every test row by joins with the nodes."""
    model, test = _fitted_forest(t)
    forest = model.stages[-1]
    walked = walk(test, forest_table(t.spark, forest), "doc_id", _DOCUMENT_FEATURES, forest.getMaxDepth())
    return walked.join(test.select("doc_id", "quality"), "doc_id").select("doc_id", "quality", "prediction", F.transform("votes", lambda v: F.round(v, 6)).alias("votes"))
