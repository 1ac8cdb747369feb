"""Metrics in long form: one row per named value."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def long_metrics(row: DataFrame, names: Mapping[str, str], on: Column | None = None, places: int = 2) -> DataFrame:
    """Unpivot a one-row table of values of mixed type.

    ``names`` maps column to metric name. ``value`` is text for every metric; ``value_num``
    holds the number where there is one.
    """
    entries = []
    for column, name in names.items():
        numeric = isinstance(row.schema[column].dataType, T.NumericType)
        fractional = isinstance(row.schema[column].dataType, T.FractionalType)
        shown = F.col(column).cast(T.DecimalType(38, places)) if fractional else F.col(column)
        number = F.col(column).cast("double") if numeric else F.lit(None).cast("double")
        entries.append(
            F.struct(F.lit(name).alias("metric"), shown.cast("string").alias("value"), number.alias("value_num"))
        )
    long = row.select(F.inline(F.array(*entries)))
    return long if on is None else long.withColumn("day", on)
