"""How a query and its SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import ship_package
from tallyforge.sources.tables import Tables


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, base: str) -> DataFrame:
        ship_package(spark)
        return self.build(Tables(spark, base))


@dataclass
class Catalog:
    entries: dict[str, Entry] = field(default_factory=dict)

    def query(self, sql: str | None = None, name: str | None = None):
        """Register the decorated function under ``name``, by default its own."""

        def register(build: Callable[[Tables], DataFrame]):
            self.entries[name or build.__name__] = Entry(build, sql)
            return build

        return register


def money(expression: str, places: int = 2) -> str:
    """SQL for a sum taken in decimals."""
    return f"CAST(SUM(CAST({expression} AS DECIMAL(18, {places}))) AS DOUBLE)"


def half_up(expression: str) -> str:
    """SQL for rounding a double to two places half up on its printed value."""
    return f"CAST(ROUND(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE)"
