"""Price regression on standardised features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame

from tallyforge.operators.learning import assemble, linear_regression, standardise
from tallyforge.sources.memory import table_from_rows

# The text columns that arrive as strings, and the types they are given.
TEXT_NUMBERS = {"floors": "float", "price": "decimal(12,2)"}


def typed(df: DataFrame, types: dict[str, str] = TEXT_NUMBERS) -> DataFrame:
    """Columns read as text as numbers; malformed text becomes null."""
    return df.withColumns({c: df[c].try_cast(t) for c, t in types.items() if c in df.columns})


def fit_price(df: DataFrame, features: Sequence[str], label: str) -> tuple[Model, DataFrame]:
    """Assemble, scale to unit deviation and fit ordinary least squares on all complete rows.

    Scaling, fitting and the fit's summary are one pass each over the columns used; rebuilding
    the vectors costs less than storing them.
    """
    vectors = assemble(df.select(*features, label).na.drop(), features).select("features", label)
    scaled = standardise(vectors)
    return linear_regression(scaled, "scaled", label, solver="normal"), scaled


def fit_report(model: Model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long rows: one per weight, then intercept, RMSE and r2."""
    rows = [(f"weight_{f}", float(w)) for f, w in zip(features, model.coefficients, strict=True)]
    rows.append(("intercept", float(model.intercept)))
    rows.append(("rmse", float(model.summary.rootMeanSquaredError)))
    rows.append(("r2", float(model.summary.r2)))
    return table_from_rows(df.sparkSession, rows, "term string, value double")
