"""Relational tables behind JDBC.

Connection settings (url, user, password, driver, ...) always come from the caller.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.upsert import latest_per_key

_IDENTIFIER = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\Z")


@dataclass(frozen=True)
class Split:
    """How a table read is cut into parallel range queries on one numeric or date column."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: Split | None = None,
    fetch_size: int = 10_000,
    one_task: bool = False,
) -> DataFrame:
    """Scan a table; filters and column choice are pushed into the database's query.

    Without a ``split`` the whole table comes through one connection and one task, which ``one_task`` must
    allow: it is for tables known to be small.
    """
    if split is None and not one_task:
        raise ValueError(f"give a split for {table}, or one_task=True for a small table")
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    if split:
        reader = reader.options(**split.options())
    return reader.load()


def column_range(spark: SparkSession, connection: Mapping[str, str], table: str, column: str) -> tuple:
    """Least and greatest value of a column, computed in the database: the bounds of a ``Split``."""
    bounds = f"(SELECT MIN({_name(column)}) AS lo, MAX({_name(column)}) AS hi FROM {_name(table)}) bounds"
    row = spark.read.format("jdbc").options(**connection).option("dbtable", bounds).load().first()
    return row[0], row[1]


def write_table(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    connections: int = 16,
    batch_size: int = 5_000,
    column_types: str | None = None,
    keep_definition: bool = False,
) -> None:
    """Write a table, replacing it by default.

    ``connections`` bounds how many tasks talk to the database at once. With
    ``keep_definition`` an overwrite empties the table but keeps its keys and types.
    """
    writer = vectors_as_text(df).write.format("jdbc").options(**connection).option("dbtable", table)
    writer = writer.option("numPartitions", str(connections)).option("batchsize", str(batch_size))
    if keep_definition:
        writer = writer.option("truncate", "true")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.mode(mode).save()


def vectors_as_text(df: DataFrame) -> DataFrame:
    """Databases have no vector type: such columns are exported as text."""
    vectors = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, VectorUDT)}
    return df.withColumns(vectors) if vectors else df


def merge_statement(target: str, staging: str, keys: Sequence[str], values: Sequence[str], dialect: str) -> str:
    """One set-based statement that inserts new keys and replaces the values of known ones."""
    target, staging = _name(target), _name(staging)
    keys, values = [_name(k) for k in keys], [_name(v) for v in values]
    columns = ", ".join([*keys, *values])
    if dialect == "postgresql":
        assignments = ", ".join(f"{v} = EXCLUDED.{v}" for v in values)
        return (
            f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {assignments}"
        )
    if dialect == "ansi":
        matched = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        assignments = ", ".join(f"{v} = s.{v}" for v in values)
        fresh = ", ".join(f"s.{c}" for c in [*keys, *values])
        return (
            f"MERGE INTO {target} t USING {staging} s ON {matched} "
            f"WHEN MATCHED THEN UPDATE SET {assignments} "
            f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({fresh})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def upsert_table(
    df: DataFrame,
    connection: Mapping[str, str],
    target: str,
    keys: Sequence[str],
    execute: Callable[[str], object],
    staging: str | None = None,
    version: str | None = None,
    dialect: str = "postgresql",
) -> str:
    """Keyed upsert: a parallel write to a staging table, then one merge run through ``execute``.

    ``execute`` takes a statement, such as a database cursor's method of that name. The staging table has
    a name of its own unless one is given, and is dropped after the merge, also after one that failed.
    """
    staging = staging or f"{target}_staging_{uuid.uuid4().hex[:12]}"
    batch = latest_per_key(df, keys, version)
    statement = merge_statement(target, staging, keys, [c for c in batch.columns if c not in keys], dialect)
    try:
        write_table(batch, connection, staging)
        execute(statement)
    finally:
        execute(f"DROP TABLE IF EXISTS {_name(staging)}")
    return statement


def _name(identifier: str) -> str:
    if not _IDENTIFIER.match(identifier):
        raise ValueError(f"not a plain SQL identifier: {identifier!r}")
    return identifier
