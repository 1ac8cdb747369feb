"""Nulls, duplicates and record validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.projection import each_column
from tallyforge.operators.quantiles import beside, exact_quantiles


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (all by default)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fractional_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)]


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by the column's mean; all float and double columns by default.

    The means of all columns come from one more scan. An input that is costly to compute is better stored first.
    """
    columns = columns or fractional_columns(df)
    return _filled(df, df.agg(*[F.avg(c).alias(c) for c in columns]), columns) if columns else df


def impute_median(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Replace nulls by the column's lower median.

    With ``accuracy`` the median is a mergeable sketch's (rank error 1/accuracy), one scan for
    all columns; without it the medians are exact, all columns in one call.
    """
    if accuracy:
        return _filled(df, df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns]), columns)
    if not columns:
        return df
    kinds = {df.schema[c].dataType for c in columns}
    common = kinds.pop() if len(kinds) == 1 else T.DoubleType()
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(common).alias("value")) for c in columns]))
    medians = exact_quantiles(df.select(pairs.alias("pair")).select("pair.*"), "value", [0.5], by=["column"])
    row = medians.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])
    return _filled(df, row, columns)


def _filled(df: DataFrame, row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the values of a one-row table with the same column names."""
    known = beside(df, row.withColumnsRenamed({c: f"_{c}" for c in columns}), [])
    values = {c: F.coalesce(F.col(c), F.col(f"_{c}")).cast(df.schema[c].dataType) for c in columns}
    return known.withColumns(values).select(*df.columns)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many nulls each column has."""
    return each_column(df, lambda c: F.count_if(F.col(c).isNull()), columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def mark_problems(df: DataFrame, rules: Mapping[str, Column], into: str = "problems") -> DataFrame:
    """Attach the names of the rules a row breaks; a rule that is null counts as broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(into, F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the broken rules named in ``problems``."""
    marked = mark_problems(df, rules)
    return (
        marked.filter(F.size("problems") == 0).drop("problems"),
        marked.filter(F.size("problems") > 0),
    )
