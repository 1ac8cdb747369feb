"""Stored summaries that are merged for any period without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], size: int = 800) -> DataFrame:
    """``by, sketch binary``: one KLL sketch of the doubles of each group; null and NaN values do not count.

    A rank read from a sketch is off by about 2.3 / size ** 0.9 of the rows (0.6 % for 800) with a confidence of
    99 %, merged or not. A group without values has no sketch.
    """
    x = F.col(value).cast("double")
    return df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*by).agg(F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str | Column] = ()) -> DataFrame:
    """``by, n, p, value``: quantiles of everything that the sketches of each group saw."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch")).filter(F.col("sketch").isNotNull())
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.kll_sketch_get_quantile_double("sketch", wanted)
    names = [c for c in merged.columns if c != "sketch"]
    pairs = merged.select(*names, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(F.arrays_zip(wanted.alias("p"), found.alias("value"))).alias("q"))
    return pairs.select(*names, "n", "q.p", "q.value")


def id_bitmaps(df: DataFrame, number: str, by: Sequence[str]) -> DataFrame:
    """``by, bucket long, bits binary``: which whole numbers occur in each group, exactly, 32,768 of them in a row of 4 KB.

    Meant for numbers given out one after the other, so that bitmaps are well filled. Null numbers do not count.
    """
    known = df.filter(F.col(number).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Bitmaps of larger groups, such as months from days."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str | Column] = (), into: str = "n") -> DataFrame:
    """``by, n long``: how many different numbers the bitmaps of each group have, a number in several of them once."""
    merged = merged_bitmaps(bitmaps, by)
    names = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(into))


def day_masks(df: DataFrame, day: str, by: Sequence[str]) -> DataFrame:
    """``by, month date, days int``: on which days of a month a group has rows, a bit for each day.

    An entity and month is one row of some bytes however busy it is. Null days do not count.
    """
    at = F.to_date(day)
    bit = F.expr("shiftleft(1, dayofmonth(_at) - 1)")
    known = df.withColumn("_at", at).filter("_at IS NOT NULL")
    return known.groupBy(*by, F.trunc("_at", "month").alias("month")).agg(F.bit_or(bit).alias("days"))


def merged_days(masks: DataFrame, by: Sequence[str]) -> DataFrame:
    """One mask for a group and month, from several such as those of later loads."""
    return masks.groupBy(*by, "month").agg(F.bit_or("days").alias("days"))


def active_days(masks: DataFrame, by: Sequence[str], into: str = "active_days") -> DataFrame:
    """``by, active_days long``: how many different days each group has in the months given."""
    return merged_days(masks, by).groupBy(*by).agg(F.sum(F.bit_count("days")).cast("long").alias(into))
