"""Keyed upsert on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import stage_table


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``version``, else the greatest values.

    An aggregate, not a window: copies of a key collapse inside each task before the shuffle.
    """
    values = [c for c in df.columns if c not in keys]
    order = [version, *[v for v in values if v != version]] if version else values
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("row"))
    return picked.select(*keys, "row.*").select(*df.columns)


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """``current`` with the rows of ``changes`` put in by key: known keys replaced, new keys added.

    Only the changes are deduplicated and stored: read back, their size is known, so a small
    batch is broadcast and the large table is not shuffled. As with a unique constraint, null
    keys equal nothing.
    """
    latest = stage_table(latest_per_key(changes, keys, version), "upsert-changes")
    kept = current.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest)
