"""Top-N, globally and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def _keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def top_with_ties(df: DataFrame, per: Keys, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """Rows of rank 1..n per group. Equal rows share a rank, so a group may keep more than n.

    Parts of each group are cut to n first, and only the survivors meet.
    """
    return _ranked(df, F.rank(), per, order, n, rank)


def top_exact(df: DataFrame, per: Keys, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """Exactly the first n rows per group; end ``order`` with a key to make it deterministic."""
    return _ranked(df, F.row_number(), per, order, n, rank)


def ranked_lists(
    df: DataFrame, per: Keys, order: Sequence[Column], n: int, fields: Sequence[str], into: str = "top"
) -> DataFrame:
    """One row per group with the first n rows as an array of structs, best first.

    Rows are cut to n before they are collected, so no array holds a whole group.
    """
    kept = top_exact(df, per, order, n, "rank")
    return kept.groupBy(*_keys(per)).agg(F.sort_array(F.collect_list(F.struct("rank", *fields))).alias(into))


def sliced_rows(lists: DataFrame, per: Keys, n: int, source: str = "top") -> DataFrame:
    """The first n entries of each ranked list as rows again."""
    cut = lists.select(*_keys(per), F.explode(F.slice(source, 1, n)).alias("entry"))
    return cut.select(*_keys(per), "entry.*")


def top_overall(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of all: every task keeps k, no global sort."""
    return df.orderBy(*order).limit(k)


def sort_rows(df: DataFrame, columns: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    return df.orderBy(*columns, ascending=ascending if isinstance(ascending, bool) else list(ascending))


# Parts of a group that are ranked apart before the group is ranked.
_PARTS = 64


def _ranked(df, function: Column, per: Keys, order: Sequence[Column], n: int, rank: str | None) -> DataFrame:
    """Ranks parts of a group first, so for any n a task sorts a part, and at last ``_PARTS`` times n rows of a group."""
    name, keys = rank or "_rank", _keys(per)
    parted = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(_PARTS)))
    first = parted.withColumn("_first", function.over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    cut = first.filter(F.col("_first") <= n).drop("_part", "_first")
    kept = cut.withColumn(name, function.over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)
