from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import crossing, daily_spend, housing, passengers, survival
from tallyforge.plans import till_reports as tills
from tallyforge.plans.top_entities import activity_per_entity, top_per_region, unify, with_daily_average
from tallyforge.sources.memory import rates_table

CUSTOMERS = [(1, "Olga", "CRC"), (2, "Iván", "EUR"), (3, "Noa", "USD")]
TRANSACTIONS = [
    (1, 100.0, dt.datetime(2020, 3, 1, 8)),
    (1, 80.0, dt.datetime(2020, 3, 1, 23, 59)),
    (1, 96.0, dt.datetime(2020, 3, 2)),
    (2, 1000.0, dt.datetime(2020, 3, 1)),
    (2, 55.0, dt.datetime(2020, 3, 3)),
    (3, 5.0, dt.datetime(2020, 3, 3)),
]
D1, D2, D3 = dt.date(2020, 3, 1), dt.date(2020, 3, 2), dt.date(2020, 3, 3)


@pytest.fixture
def daily(table):
    return daily_spend.daily_spend(
        table(TRANSACTIONS, "customer_id int, amount float, purchased_at timestamp_ntz"),
        "customer_id",
        "amount",
        "purchased_at",
    )


def test_daily_spend_in_fixed_currencies(daily, rows):
    assert rows(daily_spend.in_fixed_currencies(daily)) == [
        (1, D1, 180.0, 162.0, 108000.0),
        (1, D2, 96.0, pytest.approx(86.4), 57600.0),
        (2, D1, 1000.0, 900.0, 600000.0),
        (2, D3, 55.0, 49.5, 33000.0),
        (3, D3, 5.0, 4.5, 3000.0),
    ]


def test_daily_spend_with_names_and_own_currency(daily, table, spark, rows, plan):
    customers = table(CUSTOMERS, "id int, name string, currency string")
    named = daily_spend.with_names(daily, customers, "id")
    assert rows(named, "customer_id", "id", "name", "day")[0] == (1, 1, "Olga", D1)
    rates = rates_table(spark, daily_spend.RATES)
    own = daily_spend.in_own_currency(daily, customers, rates, "id", "name")
    assert rows(own) == [
        (1, "Olga", D1, 108000.0),
        (1, "Olga", D2, 57600.0),
        (2, "Iván", D1, 900.0),
        (2, "Iván", D3, 49.5),
    ]
    assert "BroadcastHashJoin" in plan(customers.join(rates, "currency"))


PEOPLE = [(1, "Ana", "SJ"), (2, "Luis", "SJ"), (3, "Eva", "SJ"), (4, "Leo", "AL")]
ROUTES = [(10, "Uno", 50.0), (11, "Dos", 30.5)]
ACTS = [(10, 1, D1), (10, 1, D1), (11, 1, D2), (10, 2, D1), (11, 4, D1), (99, 4, D1), (10, 77, D1)]


@pytest.fixture
def riders(table):
    return (
        table(ACTS, "route int, id int, day date"),
        table(PEOPLE, "id int, name string, region string"),
        table(ROUTES, "route int, route_name string, km double"),
    )


def test_top_entities(riders, rows):
    acts, people, routes = riders
    per_entity = with_daily_average(activity_per_entity(acts, "id", "km", "day", routes, "route", places=2))
    columns = ("region", "id", "total", "active_days", "daily_average")
    assert rows(top_per_region(per_entity, people, "id", "region", 5), *columns) == [
        ("AL", 4, 30.5, 1, 30.5),
        ("SJ", 1, 130.5, 2, 65.25),
        ("SJ", 2, 50.0, 1, 50.0),
    ]
    everyone = top_per_region(per_entity, people, "id", "region", 5, ties=False, keep_inactive=True)
    assert ("SJ", 3, None, None, None) in rows(everyone, *columns)
    assert rows(top_per_region(per_entity, people, "id", "region", 1), "id") == [(1,), (4,)]


def test_top_entities_ties_by_average(table, rows):
    per_entity = table([(1, 10.0, 2, 5.0), (2, 10.0, 1, 10.0), (3, 10.0, 2, 5.0)], "id int, total double, active_days int, daily_average double")
    people = table([(i, "x") for i in (1, 2, 3)], "id int, region string")
    assert rows(top_per_region(per_entity, people, "id", "region", 2), "id") == [(1,), (2,), (3,)]
    assert rows(top_per_region(per_entity, people, "id", "region", 2, ties=False), "id") == [(1,), (2,)]


def test_unification_keeps_every_gap(riders, rows):
    acts, people, routes = riders
    united = unify(acts, people, "id", routes, "route")
    expected = acts.join(people, "id", "full_outer").join(routes, "route", "left")
    columns = ("id", "name", "route", "km", "day")
    assert rows(united, *columns) == rows(expected, *columns)
    assert (3, "Eva", None, None, None) in rows(united, *columns)
    assert (77, None, 10, 50.0, D1) in rows(united, *columns)


LINES = [
    (1, "leche", 4.0, 100.0),
    (1, "pan", 1.0, 900.0),
    (2, "leche", 1.0, 100.0),
    (3, "jugo", 2.0, 250.0),
    (4, "pan", 1.0, 300.0),
    (4, "pan", 1.0, 300.0),
]
LINE_SCHEMA = "till int, product string, quantity double, unit_price double"


def test_totals_and_metrics(table, rows):
    lines = table(LINES, LINE_SCHEMA)
    totals = tills.totals_by_till(tills.with_sale(lines))
    assert rows(totals) == [(1, 1300.0), (2, 100.0), (3, 500.0), (4, 600.0)]
    assert rows(tills.totals_by_product(lines)) == [("jugo", 2.0), ("leche", 5.0), ("pan", 3.0)]
    assert rows(tills.till_metrics(totals)) == [(1, 2, 100.0, 500.0, 600.0)]
    assert rows(tills.till_metrics(totals, exact=False)) == [(1, 2, 100.0, 500.0, 600.0)]
    assert rows(tills.product_metrics(lines)) == [("leche", "pan")]


def test_dated_report(table, rows):
    lines = table(LINES, LINE_SCHEMA)
    day = dt.date(2024, 10, 16)
    report = {r["metric"]: r["value"] for r in tills.report(lines, day, deduplicate=False).collect()}
    assert report == {
        "caja_con_mas_ventas": "1",
        "caja_con_menos_ventas": "2",
        "percentil_25_por_caja": "100.00",
        "percentil_50_por_caja": "500.00",
        "percentil_75_por_caja": "600.00",
        "producto_mas_vendido_por_unidad": "leche",
        "producto_de_mayor_ingreso": "pan",
    }
    merged = {r["metric"]: r["value"] for r in tills.report(lines, day).collect()}
    assert merged["percentil_75_por_caja"] == "500.00"


def test_clean_till_totals(table, rows):
    sales = [("a", 64.25), ("a", -7.5), ("b", 0.0), ("c", None), (None, 12.0), ("d", -3.0), ("a", 0.55)]
    df = table(sales, "till string, sale double")
    assert rows(tills.clean_totals_by_till(df, places=2)) == [("a", 64.8), ("b", 0.0)]
    assert rows(tills.clean_totals_by_till(df)) == [("a", pytest.approx(64.8)), ("b", 0.0)]
    text = table([("a", "7.5"), ("a", "bad")], "till string, sale string")
    assert rows(tills.clean_totals_by_till(text)) == [("a", 7.5)]
    assert rows(tills.clean_totals_by_till(df.limit(0))) == []


def test_clean_product_totals(table, rows):
    sold = [("queso", 7), ("Queso", 6), ("QUESO", 8), (None, 9), ("miel", None), ("miel", 0), ("miel", -4), ("kiwi", 2)]
    df = table(sold, "product string, quantity int")
    assert rows(tills.clean_totals_by_product(df)) == [("kiwi", 2), ("queso", 21)]
    half = table([("a", 1.5), ("A", 2.25)], "product string, quantity double")
    assert rows(tills.clean_totals_by_product(half)) == [("a", 3.75)]


def test_crossing_in_both_variants(table, rows):
    tracts = table([("east", 10.0), ("west", None), (None, 1.0)], "zone string, income double")
    cases = table([("east", 5.0, 2018), ("east", None, 2019), ("west", 7.0, 2018)], "area string, cases double, Year int")
    cleaned = crossing.cross(tracts, cases, "zone", "area", drop=("year",))
    assert rows(cleaned["right"]) == [("east", 5.0), ("west", 7.0)]
    assert rows(cleaned["crossed"]) == [("east", 10.0, "east", 5.0)]
    imputed = crossing.cross(tracts, cases, "zone", "area", crossing.impute, ("year",))
    assert rows(imputed["crossed"]) == [
        ("east", 10.0, "east", 5.0),
        ("east", 10.0, "east", 6.0),
        ("west", 5.5, "west", 7.0),
    ]


def test_crossed_tables_are_stored(table, monkeypatch):
    stored = []
    monkeypatch.setattr(crossing, "write_table", lambda df, connection, name: stored.append((name, connection)))
    df = table([(1,)], "a int")
    crossing.store({"census_data": df, "crossed_data": df}, {"url": "u"})
    assert stored == [("census_data", {"url": "u"}), ("crossed_data", {"url": "u"})]


def test_house_types_and_regression(spark, table, rows):
    raw = table([("1.5", "730415.25"), ("x", "5")], "floors string, price string")
    assert [(f, str(p)) for f, p in rows(housing.typed(raw))] == [(None, "5.00"), (1.5, "730415.25")]
    houses = spark.range(300).select(
        (F.col("id") % 7).cast("double").alias("rooms"), (F.col("id") % 11).cast("double").alias("age")
    )
    houses = houses.withColumn("price", 100 * F.col("rooms") - 3 * F.col("age") + 50)
    model, scaled = housing.fit_price(houses, ["rooms", "age"], "price")
    found = dict(rows(housing.fit_report(model, scaled, ["rooms", "age"])))
    spread = houses.agg(F.stddev("rooms"), F.stddev("age")).first()
    assert found["weight_rooms"] == pytest.approx(100 * spread[0], rel=1e-3)
    assert found["weight_age"] == pytest.approx(-3 * spread[1], rel=1e-3)
    assert found["intercept"] == pytest.approx(50, rel=1e-3) and found["r2"] == pytest.approx(1.0)


def test_passenger_encoding(table, rows):
    df = table([("male", "S"), ("female", None), ("male", "Q")], "Sex string, Embarked string")
    assert rows(survival.encoded(df, survival.PASSENGER_CODES)) == [(0, 3), (1, 0), (1, 2)]


def test_passenger_profile(table, rows):
    raw = table(
        [(0, 20.0, 7.0, None), (1, None, 80.0, "C1"), (1, 40.0, 30.0, None), (0, 30.0, 8.0, "B2")],
        "Survived int, Age double, Fare double, Cabin string",
    )
    filled = passengers.fill_gaps(raw, {"Cabin": "unknown"}, ["Age"])
    tables = passengers.report(raw, filled, ["Age", "Fare"], "Survived", "Age")
    assert rows(tables["nulls_before"]) == [(0, 1, 0, 2)] and rows(tables["nulls_after"]) == [(0, 0, 0, 0)]
    assert rows(tables["statistics"], "column", "count", "mean", "min", "max") == [
        ("Age", 4, 30.0, 20.0, 40.0),
        ("Fare", 4, 31.25, 7.0, 80.0),
    ]
    assert rows(tables["label_counts"]) == [(0, 2), (1, 2)]
    assert len(rows(tables["correlations"])) == 4
    assert sum(n for *_, n in rows(tables["histogram"])) == 4
    assert rows(passengers.box_plot(filled, "Fare", ["Survived"]), "Survived", "median", "outliers") == [(0, 7.5, 0), (1, 55.0, 0)]
    for exact in (False, True):
        found = passengers.quartiles(filled, ["Age", "Fare"], exact)
        assert rows(found["Fare"]) == [(0.25, 7.0), (0.5, 8.0), (0.75, 30.0)]
