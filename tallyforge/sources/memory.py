"""Small tables given in code: dimension constants, empty tables, test rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_from_rows(
    spark: SparkSession,
    rows: Iterable[Sequence | Mapping],
    schema: T.StructType | str,
) -> DataFrame:
    """Tuples, ``Row``s or dicts with a declared schema; an absent dict key is null, no rows is fine.

    The rows travel as Arrow data and become a local relation, whose size the optimizer knows:
    a join against it is a broadcast without a hint.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = struct.fieldNames()
    records = [
        {n: row.get(n) for n in names} if isinstance(row, Mapping) else dict(zip(names, row, strict=True))
        for row in rows
    ]
    columns = pa.table({n: pa.array([record[n] for record in records]) for n in names})
    return spark.createDataFrame(columns, schema=struct)


def rates_table(spark: SparkSession, rates: Mapping[str, float]) -> DataFrame:
    """Exchange rates as ``currency, rate``; double, so 0.9 stays 0.9."""
    return table_from_rows(spark, list(rates.items()), "currency string, rate double")
