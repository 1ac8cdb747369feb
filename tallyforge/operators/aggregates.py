"""Grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.numbers import total

Keys = str | Sequence[str]


def _keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_numeric(df: DataFrame, keys: Keys, places: int | None = None) -> DataFrame:
    """Sum every numeric column that is not a key, each under its own name.

    ``places`` makes the sums of float and double columns exact in that many decimals.
    """
    keys = _keys(keys)
    numeric = [f for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    exact = T.FloatType | T.DoubleType
    return df.groupBy(*keys).agg(
        *[total(f.name, places if isinstance(f.dataType, exact) else None).alias(f.name) for f in numeric]
    )


def tally(df: DataFrame, keys: Keys, **aggregates: Column) -> DataFrame:
    """Several aggregates in one pass, named by keyword."""
    return df.groupBy(*_keys(keys)).agg(*[a.alias(name) for name, a in aggregates.items()])


def group_counts(df: DataFrame, keys: Keys) -> DataFrame:
    return df.groupBy(*_keys(keys)).count()


def extremes(totals: DataFrame, key: str, measure: str, most: str = "most", least: str = "least") -> DataFrame:
    """One row: the key with the greatest and with the least measure, from one aggregate.

    Keys without a measure take no part. Among equals the greatest key wins ``most`` and the
    least key wins ``least``.
    """
    order = F.struct(measure, key)
    return totals.filter(F.col(measure).isNotNull()).agg(
        F.max_by(key, order).alias(most), F.min_by(key, order).alias(least)
    )


def leader(key: str, measure: str) -> Column:
    """Aggregate giving the key with the greatest measure; among equals, the greatest key.

    Rows without a measure sort last, since nulls order first.
    """
    return F.max_by(key, F.struct(measure, key))
