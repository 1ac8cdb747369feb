"""Two data sets cleaned, crossed on a shared key and stored."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tallyforge.operators.joins import join_on_pairs
from tallyforge.operators.quality import drop_incomplete, impute_mean
from tallyforge.session import stage_table
from tallyforge.sources.relational import write_table


def clean(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Without the named columns, then without incomplete rows."""
    return drop_incomplete(df.drop(*drop))


def impute(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Without the named columns, with nulls in fractional columns replaced by the mean."""
    return impute_mean(df.drop(*drop))


def cross(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    prepare: Callable[..., DataFrame] = clean,
    drop: tuple[str, ...] = (),
    stored: bool = False,
) -> dict[str, DataFrame]:
    """The prepared inputs and their inner join; ``drop`` names columns of the right side.

    With ``stored`` the prepared inputs are written once, for use with :func:`store`, which reads all three.
    """
    left, right = prepare(left), prepare(right, drop)
    if stored:
        left, right = stage_table(left, "crossing-left"), stage_table(right, "crossing-right")
    return {"left": left, "right": right, "crossed": join_on_pairs(left, right, [left_key], [right_key])}


def store(tables: Mapping[str, DataFrame], connection: Mapping[str, str]) -> None:
    """Write every table to the database under its name."""
    for name, df in tables.items():
        write_table(df, connection, name)
