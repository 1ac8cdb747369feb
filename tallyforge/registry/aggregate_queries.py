"""Grouped aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import mean, product, total
from tallyforge.operators.aggregates import extremes, group_counts, sum_numeric, tally
from tallyforge.operators.quantiles import approx_quantiles, beside, exact_quantiles, within_error
from tallyforge.operators.sketches import active_days, day_masks, distinct_counts, id_bitmaps, merged_quantiles, quantile_sketches
from tallyforge.registry.catalog import Catalog, money
from tallyforge.session import stage_table
from tallyforge.sources.tables import Tables

catalog = Catalog()


def order_days(t: Tables) -> DataFrame:
    return t.orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@catalog.query(
    f"""SELECT o_custkey AS customer_id, {_DAY} AS day, CAST(SUM(o_orderkey) AS BIGINT) AS o_orderkey,
               {money("o_totalprice")} AS amount
        FROM orders GROUP BY 1, 2"""
)
def agg_sum_all_numeric(t: Tables) -> DataFrame:
    sums = sum_numeric(order_days(t), ["o_custkey", "day"], places=2)
    return sums.withColumnsRenamed({"o_custkey": "customer_id", "o_totalprice": "amount"})


@catalog.query(f"SELECT l_suppkey, {money('l_extendedprice')} AS income FROM lineitem GROUP BY l_suppkey")
def agg_sum(t: Tables) -> DataFrame:
    return tally(t.lineitem, "l_suppkey", income=total("l_extendedprice", 2))


@catalog.query(f"SELECT o_custkey, {_DAY} AS day, {money('o_totalprice')} AS amount FROM orders GROUP BY 1, 2")
def agg_sum_multi_key(t: Tables) -> DataFrame:
    return tally(order_days(t), ["o_custkey", "day"], amount=total("o_totalprice", 2))


@catalog.query(
    f"""SELECT l_partkey, {money("l_quantity * l_extendedprice")} AS income,
               {money("l_extendedprice * (1 - l_discount)", 4)} AS net
        FROM lineitem GROUP BY l_partkey"""
)
def agg_sum_expr(t: Tables) -> DataFrame:
    return tally(
        t.lineitem,
        "l_partkey",
        income=total(product("l_quantity", "l_extendedprice"), 2),
        net=total(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
    )


@catalog.query(
    "SELECT o_custkey, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS active_days FROM orders GROUP BY o_custkey"
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return tally(t.orders, "o_custkey", active_days=F.count_distinct(F.to_date("o_orderdate")))


@catalog.query(f"SELECT o_custkey, {_DAY} AS day, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2")
def agg_count_star(t: Tables) -> DataFrame:
    return tally(order_days(t), ["o_custkey", "day"], n_orders=F.count("*"))


@catalog.query(
    """SELECT o_custkey, COUNT(NULLIF(o_orderpriority, '5-LOW')) AS n_known FROM orders GROUP BY o_custkey"""
)
def agg_count_column(t: Tables) -> DataFrame:
    return tally(t.orders, "o_custkey", n_known=F.count(F.nullif("o_orderpriority", F.lit("5-LOW"))))


@catalog.query('SELECT event_type, COUNT(*) AS "count" FROM events GROUP BY event_type')
def agg_group_count(t: Tables) -> DataFrame:
    return group_counts(t.events, "event_type")


@catalog.query("SELECT o_custkey, MIN(o_totalprice) AS least FROM orders GROUP BY o_custkey")
def agg_min(t: Tables) -> DataFrame:
    return tally(t.orders, "o_custkey", least=F.min("o_totalprice"))


@catalog.query("SELECT o_custkey, MAX(o_totalprice) AS most FROM orders GROUP BY o_custkey")
def agg_max(t: Tables) -> DataFrame:
    return tally(t.orders, "o_custkey", most=F.max("o_totalprice"))


@catalog.query(
    f"""SELECT o_custkey, {money("o_totalprice")} / COUNT(o_totalprice) AS average FROM orders GROUP BY o_custkey"""
)
def agg_avg(t: Tables) -> DataFrame:
    return tally(t.orders, "o_custkey", average=mean("o_totalprice", 2))


@catalog.query(
    f"""SELECT c_nationkey, {_DAY} AS day, {money("o_totalprice")} AS amount, COUNT(DISTINCT o_custkey) AS customers,
               COUNT(*) AS n_orders, MIN(o_totalprice) AS least, MAX(o_totalprice) AS most
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
)
def agg_multi(t: Tables) -> DataFrame:
    # One row per customer and day before the join, so customers of a day can be counted as rows after it.
    per_customer = tally(
        order_days(t),
        ["o_custkey", "day"],
        amount=total("o_totalprice", 2),
        n_orders=F.count("*"),
        least=F.min("o_totalprice"),
        most=F.max("o_totalprice"),
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return tally(
        per_customer.join(customers, "o_custkey"),
        ["c_nationkey", "day"],
        amount=total("amount", 2),
        customers=F.count("*"),
        n_orders=F.sum("n_orders"),
        least=F.min("least"),
        most=F.max("most"),
    )


@catalog.query(
    f"""WITH totals AS (SELECT l_suppkey, {money("l_extendedprice")} AS income FROM lineitem GROUP BY l_suppkey)
        SELECT (SELECT l_suppkey FROM totals ORDER BY income DESC, l_suppkey DESC LIMIT 1) AS most,
               (SELECT l_suppkey FROM totals ORDER BY income, l_suppkey LIMIT 1) AS least"""
)
def agg_argmax_argmin(t: Tables) -> DataFrame:
    return extremes(tally(t.lineitem, "l_suppkey", income=total("l_extendedprice", 2)), "l_suppkey", "income")


@catalog.query(
    f"""WITH totals AS (SELECT l_suppkey, {money("l_extendedprice")} AS income FROM lineitem GROUP BY l_suppkey)
        SELECT CAST(0.25 AS DOUBLE) AS p, quantile_disc(income, 0.25) AS value FROM totals
        UNION ALL SELECT 0.5, quantile_disc(income, 0.5) FROM totals
        UNION ALL SELECT 0.75, quantile_disc(income, 0.75) FROM totals"""
)
def percentile_disc_totals(t: Tables) -> DataFrame:
    totals = stage_table(tally(t.lineitem, "l_suppkey", income=total("l_extendedprice", 2)), "supplier-totals")
    return exact_quantiles(totals, "income", [0.25, 0.5, 0.75])


@catalog.query(
    """SELECT l_returnflag, p, value FROM (
           SELECT l_returnflag, CAST(0.1 AS DOUBLE) AS p, quantile_disc(l_quantity * l_extendedprice, 0.1) AS value
           FROM lineitem GROUP BY l_returnflag
           UNION ALL
           SELECT l_returnflag, 0.9, quantile_disc(l_quantity * l_extendedprice, 0.9)
           FROM lineitem GROUP BY l_returnflag)"""
)
def percentile_disc_by_group(t: Tables) -> DataFrame:
    sales = t.lineitem.select("l_returnflag", product("l_quantity", "l_extendedprice").alias("sale"))
    return exact_quantiles(sales, "sale", [0.1, 0.9], by=["l_returnflag"])


@catalog.query(
    "".join(
        f"""{"" if p == 0.25 else " UNION ALL "}SELECT l_partkey, CAST({p} AS DOUBLE) AS p,
            quantile_disc(l_extendedprice, {p}) AS value FROM lineitem GROUP BY l_partkey"""
        for p in (0.25, 0.5, 0.75)
    )
)
def percentile_disc_many_groups(t: Tables) -> DataFrame:
    return exact_quantiles(t.lineitem, "l_extendedprice", [0.25, 0.5, 0.75], by=["l_partkey"])


@catalog.query()
def percentile_approx_column(t: Tables) -> DataFrame:
    """Quartiles of the prices by a sketch of one scan, and whether the exact rank of each is within the sketch's error."""
    accuracy = 10_000
    prices = t.orders.select("o_totalprice")
    found = stage_table(approx_quantiles(prices, "o_totalprice", [0.25, 0.5, 0.75], accuracy=accuracy), "sketched")
    return within_error(prices, "o_totalprice", found, accuracy)


@catalog.query()
def percentile_merged_sketches(t: Tables) -> DataFrame:
    """Quartiles of the prices of every year, from stored sketches of days."""
    days = quantile_sketches(t.orders.withColumn("day", F.to_date("o_orderdate")), "o_totalprice", ["day"])
    return merged_quantiles(stage_table(days, "day-sketches"), [0.25, 0.5, 0.75], [F.year("day").alias("year")])


@catalog.query(
    """SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, COUNT(DISTINCT o_custkey) AS customers
       FROM orders GROUP BY 1, 2"""
)
def distinct_from_bitmaps(t: Tables) -> DataFrame:
    """Customers with orders in every quarter, from stored bitmaps of months."""
    months = id_bitmaps(t.orders.withColumn("month", F.trunc("o_orderdate", "month")), "o_custkey", ["month"])
    found = distinct_counts(stage_table(months, "month-bitmaps"), [F.year("month").alias("year"), F.quarter("month").alias("quarter")], "customers")
    return found.withColumns({c: F.col(c).cast("long") for c in ("year", "quarter")})


@catalog.query(
    """SELECT o_custkey, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS active_days FROM orders
       WHERE o_orderdate >= TIMESTAMP '1994-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00' GROUP BY o_custkey"""
)
def active_days_from_masks(t: Tables) -> DataFrame:
    """Active days of every customer in three years, from stored masks of months."""
    masks = stage_table(day_masks(t.orders, "o_orderdate", ["o_custkey"]), "month-masks")
    return active_days(masks.filter("month >= DATE '1994-01-01' AND month < DATE '1997-01-01'"), ["o_custkey"])
