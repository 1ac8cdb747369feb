"""Column profiles and the aggregates behind charts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.quantiles import beside, exact_quantiles, spread
from tallyforge.session import stage_table
from tallyforge.sources.memory import table_from_rows


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, minimum, maximum. One aggregate for all columns."""
    measured = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*measured).alias("rows")).select(F.inline("rows"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spark's own summary table: a ``summary`` label and one text column per input column."""
    return df.describe(*columns)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, from one aggregate over the unordered pairs."""
    pairs = {(a, b): F.corr(a, b) for a, b in combinations(columns, 2)}
    own = {c: F.when(F.count(c) > 0, F.lit(1.0)) for c in columns}
    rows = [
        F.struct(
            F.lit(a).alias("left"),
            F.lit(b).alias("right"),
            (own[a] if a == b else pairs.get((a, b), pairs.get((b, a)))).alias("correlation"),
        )
        for a in columns
        for b in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same long rows from ``pyspark.ml``'s matrix over a vector column.

    Only the matrix, one cell per pair of columns, reaches the driver.
    """
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(df)
    cells = Correlation.corr(vectors.select("features"), "features").first()[0].toArray()
    rows = [(a, b, float(cells[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return table_from_rows(df.sparkSession, rows, "left string, right string, correlation double")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum; the last bin is closed, empty bins are kept."""
    known = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    ends = known.agg(F.min("x").alias("least"), F.max("x").alias("most"))
    # A single value sits in the middle of a range of width one.
    single = F.col("least") == F.col("most")
    frame = ends.select(
        F.when(single, F.col("least") - 0.5).otherwise(F.col("least")).alias("low"),
        (F.when(single, 1.0).otherwise(F.col("most") - F.col("least")) / bins).alias("width"),
    )
    place = F.least(F.floor((F.col("x") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    counted = beside(known, frame, []).groupBy(place.alias("bin")).agg(F.count("*").alias("found"))
    every = beside(df.sparkSession.range(bins).select(F.col("id").alias("bin")), frame, [])
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce("found", F.lit(0)).alias("count"),
    )


def box_plot(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Per group: size, quartiles (linear), whiskers within 1.5 interquartile ranges, outlier count."""
    by = list(by)
    names = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    quartiles = stage_table(spread(exact_quantiles(df, value, list(names), by, interpolate=True), by, names), "quartiles")
    rows = df.select(*by, F.col(value).alias("value")).filter(F.col("value").isNotNull())
    x = F.col("value")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        beside(rows, quartiles, by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.count("*").alias("count"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.min(F.when(inside, x)).alias("lowest_inside"),
            F.max(F.when(inside, x)).alias("highest_inside"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            *by,
            "count",
            "min",
            "q1",
            "median",
            "q3",
            "max",
            F.least("lowest_inside", "q1").alias("whisker_low"),
            F.greatest("highest_inside", "q3").alias("whisker_high"),
            "outliers",
        )
    )
