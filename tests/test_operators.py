from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.numbers import total
from tallyforge.operators import aggregates, distributions, joins, metrics, projection, quality, quantiles, ranking, sets
from tallyforge.operators.upsert import latest_per_key, upsert


# Projections


def test_projection_helpers(table, rows):
    df = table([(1, "a"), (2, "b")], "k int, Year string")
    assert projection.without(df, "year", "missing").columns == ["k"]
    assert projection.name_by_position(df, ["x", "y"]).columns == ["x", "y"]
    assert projection.rename(df, {"k": "key"}).columns == ["key", "Year"]
    assert rows(projection.pick(df, [F.col("k")])) == [(1,), (2,)]
    assert rows(projection.each_column(df, lambda c: F.upper(F.col(c).cast("string")))) == [("1", "A"), ("2", "B")]
    assert rows(projection.preview(df, 1, [F.desc("k")])) == [(2, "b")]
    assert rows(projection.text_columns(df.select(F.encode("Year", "UTF-8").alias("value")), "value")) == [("a",), ("b",)]


# Quality


def test_incomplete_rows_are_dropped(table, rows):
    df = table([("north", 5, 0.5), (None, 3, 0.1), ("south", 4, None)], "zone string, people int, share double")
    assert rows(quality.drop_incomplete(df)) == [("north", 5, 0.5)]
    assert quality.drop_incomplete(df, ["people", "zone"]).count() == 2


def test_fill_is_per_column(table, rows):
    df = table([(None, None), ("A1", 3)], "cabin string, age int")
    assert rows(quality.fill(df, {"cabin": "unknown"})) == [("A1", 3), ("unknown", None)]


def test_mean_imputation_touches_fractional_columns_only(table, rows):
    df = table([(1.0, None, None), (3.0, 2.0, 7), (None, 4.0, 9)], "a double, b float, c int")
    assert rows(quality.impute_mean(df)) == [(1.0, 3.0, None), (2.0, 4.0, 9), (3.0, 2.0, 7)]


def test_mean_imputation_of_an_empty_column(table, rows):
    assert rows(quality.impute_mean(table([(None,)], "a double"))) == [(None,)]


@pytest.mark.parametrize("accuracy", [None, 100])
def test_median_imputation(table, rows, accuracy):
    df = table([(1,), (2,), (10,), (20,), (None,)], "age int")
    assert rows(quality.impute_median(df, ["age"], accuracy)) == [(1,), (2,), (2,), (10,), (20,)]


def test_null_counts(table, rows):
    df = table([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(quality.null_counts(df)) == [(1, 2)]


def test_validation_splits_without_losing_rows(table, rows):
    df = table([("a", 1), ("b", -1), (None, 5), ("c", None)], "name string, n int")
    valid, rejected = quality.split_valid(df, {"name": F.col("name").isNotNull(), "n": F.col("n") > 0})
    assert rows(valid) == [("a", 1)]
    assert rows(rejected.select("name", F.array_join("problems", ","))) == [(None, "name"), ("b", "n"), ("c", "n")]


def test_duplicates(table, rows):
    df = table([("m", "1", "d"), ("m", "1", "d"), ("m", "2", "d")], "metric string, value string, day string")
    assert rows(quality.distinct_rows(df)) == [("m", "1", "d"), ("m", "2", "d")]


# Joins


def test_pair_join(table, rows):
    sales = table([(7, "n", 2.5), (7, "s", 4.0), (8, "n", 9.0), (None, "n", 1.0)], "shop int, zone string, amount double")
    shops = table([(7, "n", "Alba"), (8, "s", "Brisa"), (None, "n", "Cima")], "id int, area string, name string")
    assert rows(joins.join_on_pairs(sales, shops, ["shop", "zone"], ["id", "area"])) == [(7, "n", 2.5, 7, "n", "Alba")]
    assert joins.join_on_pairs(sales, shops, ["shop"], ["id"]).count() == 3
    with pytest.raises(ValueError):
        joins.join_on_pairs(sales, shops, ["shop", "zone"], ["id"])


def test_outer_join_keeps_gaps_on_both_sides(table, rows):
    people = table([(1, "Ana"), (2, "Luis"), (None, "Nadie")], "id int, name string")
    acts = table([(1, "r1"), (1, "r1"), (9, "r2"), (None, "r3")], "id int, route string")
    expected = rows(acts.join(people, "id", "full_outer").select("id", "route", "name"))
    assert rows(joins.full_outer_to_entities(acts, people, "id")) == expected
    assert len(expected) == 7 - 1


def test_left_join_with_null_keys_and_empty_side(table, rows):
    left = table([(1,), (None,)], "k int")
    right = table([(None, "n"), (1, "x")], "k int, v string")
    assert rows(joins.join_using(left, right, "k", "left")) == [(None, None), (1, "x")]
    assert rows(joins.join_using(left, table([], "k int, v string"), "k", "left")) == [(None, None), (1, None)]


def test_period_join_keeps_inactive_entities(table, rows):
    people = table([(1,), (2,)], "id int")
    acts = table([(1, "2024-01-05"), (2, "2023-12-31")], "id int, day string")
    joined = joins.left_join_period(people, acts, "id", F.col("day") >= "2024-01-01")
    assert rows(joined) == [(1, "2024-01-05"), (2, None)]


def test_chain_and_multi_key(table, rows):
    acts = table([(1, 10), (2, 11)], "person int, route int")
    people = table([(1, "Ana")], "person int, name string")
    routes = table([(10, 5.5)], "route int, km double")
    assert rows(joins.chain(acts, (people, "person"), (routes, "route"))) == [(10, 1, "Ana", 5.5)]
    assert rows(joins.join_using(acts, acts.withColumn("x", F.lit(1)), ["person", "route"])) == [(1, 10, 1), (2, 11, 1)]


# Aggregates


def test_sum_of_every_numeric_column(table, rows):
    df = table([(1, "d", 0.1, 5), (1, "d", 0.2, 6)], "id int, day string, amount double, n int")
    assert aggregates.sum_numeric(df, ["id", "day"], places=2).columns == ["id", "day", "amount", "n"]
    assert rows(aggregates.sum_numeric(df, ["id", "day"], places=2)) == [(1, "d", 0.3, 11)]


def test_several_aggregates_in_one_pass(table, rows, plan):
    df = table([("a", 1, "d1"), ("a", 2, "d1"), ("a", None, "d2")], "k string, x int, day string")
    tallied = aggregates.tally(
        df, "k", s=F.sum("x"), days=F.count_distinct("day"), n=F.count("*"), known=F.count("x"), lo=F.min("x"), hi=F.max("x")
    )
    assert rows(tallied) == [("a", 3, 2, 3, 2, 1, 2)]
    assert "Join" not in plan(tallied)
    assert rows(aggregates.group_counts(df, "day")) == [("d1", 2), ("d2", 1)]


def test_repeated_rows_count_twice(table, rows):
    df = table([("a", 50.0), ("a", 50.0)], "k string, km double")
    assert rows(aggregates.tally(df, "k", km=total("km", 2))) == [("a", 100.0)]


def test_extremes(table, rows):
    df = table([("t1", 5.0), ("t2", 9.0), ("t3", 1.0), ("t4", None), ("t5", 9.0), ("t0", 1.0)], "till string, sold double")
    assert rows(aggregates.extremes(df, "till", "sold", "best", "worst")) == [("t5", "t0")]
    assert rows(aggregates.extremes(df.filter("sold > 99"), "till", "sold")) == [(None, None)]


# Quantiles


def test_quantiles_of_four_totals(table, rows):
    df = table([(8.0,), (31.5,), (46.0,), (90.25,)], "x double")
    expected = [(0.25, 8.0), (0.5, 31.5), (0.75, 46.0)]
    assert rows(quantiles.exact_quantiles(df, "x", [0.25, 0.5, 0.75])) == expected
    assert rows(quantiles.approx_quantiles(df, "x", [0.25, 0.5, 0.75])) == expected


def _disc(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(len(ordered) * p), 1) - 1]


def _cont(values, p):
    ordered = sorted(values)
    position = (len(ordered) - 1) * p
    low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
    return low + (high - low) * (position - math.floor(position))


@pytest.mark.parametrize("interpolate", [False, True])
def test_exact_quantiles_against_brute_force(spark, interpolate):
    # Group a is large and a third of it is one value; b is small; c is a single row; the null group counts too.
    draw = random.Random(5)
    data = {
        "a": [draw.choice([draw.gauss(0, 1000), draw.gauss(0, 1), 42.0]) for _ in range(60_000)],
        "b": [float(draw.randint(0, 9)) for _ in range(501)],
        "c": [3.5],
        None: [draw.random() for _ in range(40)],
    }
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    rows = [(k, v) for k, values in data.items() for v in values] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    found = quantiles.exact_quantiles(df, "v", probabilities, by=["k"], interpolate=interpolate).collect()
    reference = _cont if interpolate else _disc
    assert {(r["k"], r["p"]): r["value"] for r in found} == {
        (k, p): pytest.approx(reference(values, p)) for k, values in data.items() for p in probabilities
    }
    assert len(found) == len(data) * len(probabilities)


def _candidates(spark, make):
    """The quantiles, and how many rows were written as candidates in how many slices."""
    from tallyforge.session import _staged

    before = len(_staged.get(spark.sparkContext.applicationId, []))
    found = make().collect()
    paths = [p for p in _staged[spark.sparkContext.applicationId][before:] if "quantile-candidates" in p]
    return found, spark.read.parquet(paths[-1])


def test_exact_quantiles_shuffle_only_brackets(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    found, candidates = _candidates(spark, lambda: quantiles.exact_quantiles(df, "v", [0.5]))
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert found[0]["value"] == values[99_999]
    assert candidates.count() < 2_000


def test_many_small_groups_store_few_rows(spark):
    df = spark.range(40_000).select((F.col("id") % 2_000).alias("k"), (F.col("id") * 7919 % 40_009).alias("v"))
    found, candidates = _candidates(spark, lambda: quantiles.exact_quantiles(df, "v", [0.5], by=["k"]))
    groups = {}
    for i in range(40_000):
        groups.setdefault(i % 2_000, []).append(i * 7919 % 40_009)
    assert {r["k"]: r["value"] for r in found} == {k: sorted(v)[9] for k, v in groups.items()}
    assert candidates.count() <= 3 * 2_000


def test_a_heavy_tail_is_spread_over_slices(spark):
    df = spark.range(300_000).select(F.exp(F.col("id") / 15_000.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would share a task
    try:
        found, candidates = _candidates(spark, lambda: quantiles.exact_quantiles(df, "v", [0.999]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0]["value"] == pytest.approx(math.exp(299_699 / 15_000.0))
    sizes = [r["count"] for r in candidates.groupBy("slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)


def test_approximate_quantiles_stay_in_their_rank_error(spark):
    df = spark.range(100_001).select((F.col("id") * 7919 % 100_003).alias("v"))
    values = sorted(i * 7919 % 100_003 for i in range(100_001))
    for row in quantiles.approx_quantiles(df, "v", [0.1, 0.5, 0.9], accuracy=1000).collect():
        assert abs(values.index(row["value"]) - row["p"] * len(values)) <= len(values) / 1000 + 1


def test_group_columns_may_have_any_name(table, rows):
    df = table([(1, "a", 5.0), (1, "a", 7.0), (2, None, 1.0)], "value int, p string, n double")
    assert rows(quantiles.exact_quantiles(df, "n", [0.5], by=["value"])) == [(1, 0.5, 5.0), (2, 0.5, 1.0)]
    named = quantiles.exact_quantiles(df.withColumnRenamed("p", "kept"), "n", [1.0], by=["kept", "value"])
    assert rows(named) == [(None, 2, 1.0, 1.0), ("a", 1, 1.0, 7.0)]


def test_quantiles_of_nothing(table, rows):
    empty = table([], "k string, v double")
    assert rows(quantiles.exact_quantiles(empty, "v", [0.5], by=["k"])) == []
    assert rows(quantiles.exact_quantiles(empty, "v", [0.5])) == []


# Distributions


def test_profile(table, rows):
    df = table([(1, 2.0), (2, 4.0), (3, None)], "a int, b double")
    assert rows(distributions.profile(df, ["a", "b"])) == [
        ("a", 3, 2.0, 1.0, 1.0, 3.0),
        ("b", 2, 3.0, pytest.approx(statistics.stdev([2, 4])), 2.0, 4.0),
    ]


def test_correlations_agree_with_the_matrix(spark, rows):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * F.col("id")).cast("double").alias("b"), F.sin("id").alias("c")
    )
    long = {(a, b): r for a, b, r in rows(distributions.correlations(df, ["a", "b", "c"]))}
    matrix = {(a, b): r for a, b, r in rows(distributions.correlation_matrix(df, ["a", "b", "c"]))}
    assert len(long) == 9 and long[("a", "a")] == 1.0
    for pair, value in matrix.items():
        assert long[pair] == pytest.approx(value)


def test_histogram_keeps_empty_bins_and_closes_the_last(table, rows):
    df = table([(0.0,), (1.0,), (10.0,), (10.0,), (None,)], "x double")
    assert [(b, n) for b, _, _, n in rows(distributions.histogram(df, "x", 5))] == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 2)]
    single = rows(distributions.histogram(table([(3.0,), (3.0,)], "x double"), "x", 4))
    assert single[0][1] == 2.5 and sum(n for *_, n in single) == 2


def test_box_plot(table, rows):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 100.0]
    df = table([("g", v) for v in values] + [("h", 5.0), ("g", None)], "k string, x double")
    assert rows(distributions.box_plot(df, "x", ["k"])) == [
        ("g", 10, 1.0, 3.25, 5.5, 7.75, 100.0, 1.0, 9.0, 1),
        ("h", 1, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 0),
    ]


# Ranking


def test_rank_shares_places_and_row_number_does_not(table, rows):
    df = table([("p", i, km) for i, km in enumerate([61.5, 60.0, 58.25, 58.25, 33.0, 7.5])], "region string, id int, km double")
    assert rows(ranking.top_with_ties(df, "region", [F.desc("km")], 5, rank="r"), "id", "r") == [
        (0, 1), (1, 2), (2, 3), (3, 3), (4, 5),
    ]
    assert rows(ranking.top_with_ties(df, "region", [F.desc("km")], 3), "id") == [(0,), (1,), (2,), (3,)]
    assert rows(ranking.top_exact(df, "region", [F.desc("km"), F.asc("id")], 3), "id") == [(0,), (1,), (2,)]


@pytest.mark.parametrize("n", [5, 2000])
def test_top_n_ranks_parts_of_a_group_first(spark, plan, n):
    df = spark.range(0, 20_000, 1, 8).select((F.col("id") % 2).alias("k"), "id")
    top = ranking.top_exact(df, "k", [F.desc("id")], n)
    text = plan(top)
    assert "hashpartitioning(k#" in text and "_part#" in text and text.count("Window [") == 2
    found = sorted((r["k"], r["id"]) for r in top.collect())
    assert found == sorted((k, 20_000 - 2 + k - 2 * i) for k in (0, 1) for i in range(n))


def test_ranked_lists_and_slices(table, rows):
    df = table([("a", i, float(i)) for i in range(12)] + [("b", 1, 1.0)], "k string, id int, km double")
    lists = ranking.ranked_lists(df, "k", [F.desc("km")], 5, ["id", "km"])
    assert {r["k"]: [e["id"] for e in r["top"]] for r in lists.collect()} == {"a": [11, 10, 9, 8, 7], "b": [1]}
    assert rows(ranking.sliced_rows(lists, "k", 2)) == [("a", 1, 11, 11.0), ("a", 2, 10, 10.0), ("b", 1, 1, 1.0)]
    assert rows(ranking.ranked_lists(df.filter("km > 99"), "k", [F.desc("km")], 5, ["id"])) == []


def test_global_order(table, plan):
    df = table([("a", 1), ("b", 3), ("b", 2)], "p string, km int")
    assert [tuple(r) for r in ranking.sort_rows(df, ["p", "km"], ascending=False).collect()] == [("b", 3), ("b", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in plan(ranking.top_overall(df, [F.desc("km")], 1))


# Sets, upsert, metrics


def test_unions(table, rows):
    a, b = table([(1, "x")], "k int, v string"), table([(1, "x"), (2, "y")], "a int, b string")
    assert rows(sets.union_all([a, b])) == [(1, "x"), (1, "x"), (2, "y")]
    assert rows(sets.union_distinct([a, b])) == [(1, "x"), (2, "y")]


def test_upsert_replaces_adds_and_keeps(table, rows):
    schema = "metric string, day string, value string"
    current = table([("a", "d1", "1"), ("b", "d1", "2"), (None, "d1", "n")], schema)
    changes = table([("a", "d1", "10"), ("a", "d1", "9"), ("c", "d1", "3"), (None, "d1", "m")], schema)
    assert rows(upsert(current, changes, ["metric", "day"])) == [
        (None, "d1", "m"), (None, "d1", "n"), ("a", "d1", "9"), ("b", "d1", "2"), ("c", "d1", "3"),
    ]


def test_latest_row_by_version(table, rows):
    df = table([("a", "z", 1), ("a", "b", 2)], "k string, v string, at int")
    assert rows(latest_per_key(df, ["k"], "at")) == [("a", "b", 2)]


def test_long_metrics(table, rows):
    row = table([(1, 845120.0, "leche", None)], "till int, p25 double, product string, none double")
    long = metrics.long_metrics(row, {"till": "best", "p25": "p", "product": "top", "none": "nothing"})
    assert rows(long) == [("best", "1", 1.0), ("nothing", None, None), ("p", "845120.00", 845120.0), ("top", "leche", None)]
