from __future__ import annotations

import math

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.categories import encode, flag
from tallyforge.functions.dates import day_from_text, day_from_text_udf, day_of, day_text
from tallyforge.functions.numbers import as_decimal, conversions, lenient_number, mean, product, ratio, total


def test_exact_total_does_not_depend_on_order(table):
    values = [0.1] * 10 + [1e9 + 0.01, -5.55, None]
    df = table([(v,) for v in values], "x double")
    assert df.agg(total("x", 2)).first()[0] == 999999995.46 + 0.0
    assert df.repartition(5).agg(total("x", 2)).first()[0] == 999999995.46


def test_exact_total_beyond_one_integer(spark):
    # 2000 times 9e13 in cents is more than a 64-bit integer holds.
    df = spark.range(2000).select(F.lit(9e13).alias("x"))
    assert df.agg(total("x", 2)).first()[0] == 1.8e17
    assert df.agg(total(-F.col("x"), 2)).first()[0] == -1.8e17


def test_totals_of_floats_nulls_and_nothing(table):
    df = table([(0.1,), (0.2,), (None,)], "x float")
    assert df.agg(total("x", 2)).first()[0] == 0.3
    assert df.filter("x > 9").agg(total("x", 2)).first()[0] is None
    assert df.agg(mean("x", 2)).first()[0] == pytest.approx(0.15)
    assert df.filter("x > 9").agg(mean("x", 2)).first()[0] is None
    assert table([(1,), (2,)], "x int").agg(total("x")).first()[0] == 3


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf"), 1e17, -3e20])
def test_exact_totals_take_any_number(table, odd):
    df = table([(1.25,), (odd,), (2.5,), (None,)], "x double")
    found, plain = df.agg(total("x", 2), total("x")).first()
    assert (math.isnan(found) and math.isnan(plain)) or found == plain
    assert table([(odd,)], "x double").agg(total("x", 2)).first()[0] == pytest.approx(odd, nan_ok=True)


def test_ratio_rounds_half_up_and_survives_zero(table, rows):
    df = table([(33.0, 8.0), (1.0, 3.0), (0.125, 1.0), (5.0, 0.0), (None, 1.0)], "a double, b double")
    assert rows(df.select(ratio("a", "b", 2))) == [(None,), (None,), (0.13,), (0.33,), (4.13,)]


def test_products_and_conversions(table, rows):
    df = table([(180.0,), (1000.0,)], "amount double")
    converted = df.withColumns(conversions("amount", {"EUR": 0.9, "CRC": 600.0}))
    assert converted.columns == ["amount", "amount_in_eur", "amount_in_crc"]
    assert rows(converted) == [(180.0, 162.0, 108000.0), (1000.0, 900.0, 600000.0)]
    assert rows(df.select(product("amount", F.lit(2), F.lit(3)))) == [(1080.0,), (6000.0,)]


def test_casts(table, rows):
    df = table([("730415.25",), ("n/a",)], "price string")
    number = lenient_number("price")
    assert rows(df.select(number)) == [(None,), (730415.25,)]
    assert [str(r[0]) for r in df.select(as_decimal(number)).collect()] == ["730415", "None"]
    assert [str(r[0]) for r in df.select(as_decimal(number, 12, 2)).collect()] == ["730415.25", "None"]


def test_days(table, rows, plan):
    df = table([(dt.datetime(2020, 3, 1, 23, 59, 59),), (None,)], "at timestamp_ntz")
    day = dt.date(2020, 3, 1)
    text = day_text("at")
    shown = df.select(text, day_from_text(text), day_of("at"), day_from_text_udf(text))
    assert rows(shown) == [(None, None, None, None), ("03/01/2020", day, day, day)]
    assert "Python" not in plan(df.select(text, day_from_text(text), day_of("at")))


def test_encoding(table, rows):
    df = table([("S",), ("C",), ("Q",), ("X",), (None,)], "port string")
    codes = df.select("port", encode("port", {"S": 0, "C": 1, "Q": 2}, 3), flag("port", "S"))
    assert rows(codes) == [(None, 3, 0), ("C", 1, 0), ("Q", 2, 0), ("S", 0, 1), ("X", 3, 0)]
    assert rows(df.select(encode("port", {}, 7)).distinct()) == [(7,)]
