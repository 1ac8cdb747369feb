"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, matched by column position."""
    return reduce(DataFrame.union, tables)


def union_distinct(tables: Sequence[DataFrame]) -> DataFrame:
    """The distinct rows of all tables; copies collapse inside each task before the shuffle."""
    return union_all(tables).distinct()
