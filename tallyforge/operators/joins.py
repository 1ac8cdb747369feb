"""Equi-joins. The physical strategy is left to the optimizer, which knows the sizes at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tallyforge.operators.skew import join_measured
from tallyforge.session import stage_table


def join_using(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns; each key appears once in the result."""
    return left.join(right, [keys] if isinstance(keys, str) else list(keys), how)


def join_on_pairs(
    left: DataFrame,
    right: DataFrame,
    left_columns: Sequence[str],
    right_columns: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join on a conjunction of equalities between paired columns; both sides' keys are kept."""
    pairs = zip(left_columns, right_columns, strict=True)
    return left.join(right, [left[a] == right[b] for a, b in pairs], how)


def chain(fact: DataFrame, *dimensions: tuple[DataFrame, str | Sequence[str]], how: str = "inner") -> DataFrame:
    """Fact to dimension to dimension, in the order given."""
    for dimension, keys in dimensions:
        fact = join_using(fact, dimension, keys, how)
    return fact


def full_outer_to_entities(facts: DataFrame, entities: DataFrame, keys: str | Sequence[str], stored: bool = False) -> DataFrame:
    """Full outer join of many facts with entities.

    A full outer join cannot be split when one key is hot, so the heavy keys of the facts are measured and dealt out;
    see ``join_measured``. Facts with a null key match nothing and skip the join, entities without facts are added.

    Facts are read twice; with ``stored`` they are written once first, for facts that are costly to compute.
    Columns that both sides have besides the keys are refused.
    """
    return join_measured(stage_table(facts, "facts") if stored else facts, entities, keys, "full")


def left_join_period(
    entities: DataFrame,
    facts: DataFrame,
    keys: str | Sequence[str],
    when: Column,
) -> DataFrame:
    """Keep every entity, with the facts of one period only.

    The period is applied before the join, where it is pushed into the scan; applied
    afterwards it would drop the entities without facts.
    """
    return join_using(entities, facts.filter(when), keys, "left")
