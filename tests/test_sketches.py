from __future__ import annotations

import bisect
import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import quality, quantiles, sketches
from tallyforge.registry import entries


def rank_gap(ordered, value, p):
    """How far the ranks of the value are from the wanted one, as a share of the rows."""
    low, high = bisect.bisect_left(ordered, value), bisect.bisect_right(ordered, value)
    wanted = p * len(ordered)
    return max(0, low - wanted, wanted - high) / len(ordered)


@pytest.fixture(scope="module")
def values():
    draw = random.Random(12)
    # One day has a third of all rows, and one value is frequent.
    return [(0 if k % 3 == 0 else draw.randint(1, 60), 5.0 if k % 4 == 0 else draw.lognormvariate(2, 1)) for k in range(30_000)]


def test_merged_sketches_against_exact_ranks(spark, values):
    df = spark.createDataFrame([*values, (1, None), (2, float("nan")), (99, None)], "day int, x double").repartition(9)
    days = sketches.quantile_sketches(df, "x", ["day"])
    assert days.count() == 61
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    groups = defaultdict(list)
    for day, x in values:
        groups[day // 20].append(x)
    found = sketches.merged_quantiles(days, wanted, [F.floor(F.col("day") / 20).cast("int").alias("part")]).collect()
    assert len(found) == len(groups) * len(wanted)
    for r in found:
        ordered = sorted(groups[r["part"]])
        assert r["n"] == len(ordered) and rank_gap(ordered, r["value"], r["p"]) <= 0.02
    everything = sketches.merged_quantiles(days, wanted).collect()
    assert all(rank_gap(sorted(x for _, x in values), r["value"], r["p"]) <= 0.02 for r in everything)
    assert sketches.merged_quantiles(days.limit(0), wanted, ["day"]).collect() == []


def test_one_scan_sketches_are_within_their_accuracy(spark, values, table):
    ordered = sorted(x for _, x in values)
    df = spark.createDataFrame(values, "day int, x double").repartition(9)
    for r in quantiles.approx_quantiles(df, "x", [0.25, 0.5, 0.75], accuracy=1000).collect():
        assert rank_gap(ordered, r["value"], r["p"]) <= 0.001
    gaps = spark.createDataFrame([(k, None if k % 5 == 0 else x) for k, (_, x) in enumerate(values)], "id int, x double")
    known = sorted(x for k, (_, x) in enumerate(values) if k % 5)
    filled = quality.impute_median(gaps, ["x"], accuracy=1000)
    fills = {r["x"] for r in filled.filter("id % 5 = 0").collect()}
    assert len(fills) == 1 and rank_gap(known, fills.pop(), 0.5) <= 0.001
    assert filled.filter("id % 5 > 0").exceptAll(gaps.filter("id % 5 > 0")).count() == 0


def test_ranks_of_given_values_are_judged_exactly(spark, table, rows):
    df = spark.createDataFrame([(float(k),) for k in range(1000)] + [(None,)], "x double").repartition(3)
    found = table([(0.25, 249.0), (0.5, 520.0), (0.75, 735.0), (0.9, 909.0)], "p double, value double")
    assert rows(quantiles.within_error(df, "x", found, 100)) == [(0.25, 249.0, True), (0.5, 520.0, False), (0.75, 735.0, False), (0.9, 909.0, True)]


def test_sketch_queries_give_values_and_what_their_ranks_say(spark, tmp_path):
    prices = [float(k * 7919 % 5000) for k in range(5000)]
    day = dt.datetime(1995, 1, 1)
    orders = [(k, x, "P" if k % 9 == 0 else "O", "1-URGENT", day) for k, x in enumerate(prices)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderstatus string, o_orderpriority string, o_orderdate timestamp").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    found = entries()["percentile_approx_column"].run(spark, str(tmp_path))
    assert found.columns == ["p", "value", "within"] and [r["within"] for r in found.collect()] == [True] * 3
    assert all(rank_gap(sorted(prices), r["value"], r["p"]) <= 1 / 10_000 for r in found.collect())
    known = sorted(x for k, x in enumerate(prices) if k % 9)
    filled = entries()["impute_median_sketch"].run(spark, str(tmp_path)).collect()
    assert len(filled) == 5000 and all(r["within"] and r["gap"] == (r["o_orderkey"] % 9 == 0) for r in filled)
    assert all(rank_gap(known, r["price"], 0.5) <= 0.01 if r["gap"] else r["price"] == prices[r["o_orderkey"]] for r in filled)


def test_bitmaps_count_numbers_once_over_any_period(spark, rows):
    draw = random.Random(13)
    pairs = [(draw.randint(0, 30), draw.choice([0, 1, -5, 32_768, 32_769, 10**10, draw.randint(0, 90_000)])) for _ in range(5000)] + [(3, None)]
    df = spark.createDataFrame(pairs, "day int, id long")
    days = sketches.id_bitmaps(df, "id", ["day"])
    seen = defaultdict(set)
    for day, number in pairs:
        seen[day // 7] |= {number} - {None}
    week = F.floor(F.col("day") / 7).cast("int").alias("week")
    assert rows(sketches.distinct_counts(days, [week])) == sorted((w, len(s)) for w, s in seen.items())
    weeks = sketches.merged_bitmaps(days, [week])
    assert rows(sketches.distinct_counts(weeks)) == [(len(set().union(*seen.values())),)]
    assert sketches.distinct_counts(days.limit(0), ["day"]).collect() == []


def test_masks_of_days(spark, rows):
    draw = random.Random(14)
    acts = [(draw.randint(0, 20), dt.date(2023, 12, 1) + dt.timedelta(draw.randint(0, 120))) for _ in range(3000)] + [(1, None), (77, None)]
    df = spark.createDataFrame(acts, "who int, day date")
    halves = [sketches.day_masks(df.filter(f"hash(day) % 2 {sign} 0"), "day", ["who"]) for sign in ("=", "<>")]
    expected = defaultdict(set)
    for who, day in acts:
        if day:
            expected[who].add(day)
    both = halves[0].union(halves[1])
    assert rows(sketches.active_days(both, ["who"])) == sorted((w, len(d)) for w, d in expected.items())
    january = sketches.active_days(both.filter("month = DATE '2024-01-01'"), ["who"])
    inside = {w: sum(x.year == 2024 and x.month == 1 for x in d) for w, d in expected.items()}
    assert rows(january) == sorted((w, n) for w, n in inside.items() if n)
