"""Choosing, naming and dropping columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def name_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def without(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; a name that is not there is ignored."""
    return df.drop(*columns)


def each_column(df: DataFrame, build: Callable[[str], Column], columns: Sequence[str] | None = None) -> DataFrame:
    """One expression per column in a single projection, under the column's own name."""
    return df.select(*[build(c).alias(c) for c in columns or df.columns])


def preview(df: DataFrame, rows: int, order: Sequence[str | Column]) -> DataFrame:
    """The first rows in a stated order: a distributed top-k, not a global sort."""
    return df.orderBy(*order).limit(rows)


def text_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns as text, for binary message payloads."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])
