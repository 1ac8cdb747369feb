"""Rule-based encoding of categories."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode(column: Column | str, codes: Mapping[object, int], default: int) -> Column:
    """A chain of equality tests; nulls and unknown values get ``default``."""
    source = F.col(column) if isinstance(column, str) else column
    chain = F
    for value, code in codes.items():
        chain = chain.when(source == F.lit(value), code)
    return F.lit(default) if chain is F else chain.otherwise(default)


def flag(column: Column | str, value: object) -> Column:
    """1 where the column equals ``value``, else 0."""
    return encode(column, {value: 1}, 0)
