"""Profile of a table whose gaps are filled first: counts, statistics, percentiles, correlations, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import group_counts
from tallyforge.operators.distributions import box_plot, correlations, histogram, profile
from tallyforge.operators.quality import fill, impute_median, null_counts
from tallyforge.operators.quantiles import approx_quantiles, exact_quantiles
from tallyforge.session import stage_table

QUARTILES = (0.25, 0.5, 0.75)


def fill_gaps(
    df: DataFrame, constants: Mapping[str, object], medians: Sequence[str], accuracy: int | None = 100
) -> DataFrame:
    """Nulls replaced by a constant per column, or by the column's median (a sketch by default)."""
    return impute_median(fill(df, constants), medians, accuracy)


def quartiles(df: DataFrame, columns: Sequence[str], exact: bool = False) -> dict[str, DataFrame]:
    find = exact_quantiles if exact else approx_quantiles
    return {c: find(df, c, QUARTILES) for c in columns}


def report(
    raw: DataFrame, filled: DataFrame, numeric: Sequence[str], label: str, binned: str, bins: int = 20
) -> dict[str, DataFrame]:
    """Lazy tables of the whole profile, from filled rows that are stored once.

    ``label`` is counted; ``binned`` gets the histogram and, by label, the box plots.
    """
    filled = stage_table(filled, "filled-rows")
    return {
        "nulls_before": null_counts(raw),
        "nulls_after": null_counts(filled),
        "statistics": profile(filled, numeric),
        "percentiles": _stacked(quartiles(filled, numeric, exact=True)),
        "correlations": correlations(filled, numeric),
        "label_counts": group_counts(filled, label),
        "histogram": histogram(filled, binned, bins),
        "box_plots": box_plot(filled, binned, [label]),
    }


def _stacked(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables with equal columns under each other, named in ``column``."""
    parts = [df.select(F.lit(name).alias("column"), *[F.col(c).cast("double").alias(c) for c in df.columns]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def long_report(tables: Mapping[str, DataFrame], labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """All tables in long rows ``part, item, measure, value``; ``labels`` names the columns that say what a row is about."""
    parts = []
    for part, df in tables.items():
        about = [c for c in labels.get(part, ()) if c in df.columns]
        item = F.concat_ws("/", *[F.col(c).cast("string") for c in about]) if about else F.lit("")
        values = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in about]
        parts.append(df.select(F.lit(part).alias("part"), item.alias("item"), F.inline(F.array(*values))))
    return reduce(DataFrame.unionByName, parts)
