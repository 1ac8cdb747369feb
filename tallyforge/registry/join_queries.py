"""Joins and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import total
from tallyforge.operators.aggregates import tally
from tallyforge.operators.joins import (
    chain,
    full_outer_to_entities,
    join_on_pairs,
    join_using,
    left_join_period,
)
from tallyforge.operators.sets import union_all as union_tables
from tallyforge.operators.sets import union_distinct as union_tables_distinct
from tallyforge.plans.daily_spend import RATES
from tallyforge.operators.skew import join_measured
from tallyforge.plans.top_entities import unify
from tallyforge.registry.catalog import Catalog, money
from tallyforge.sources.memory import rates_table
from tallyforge.sources.tables import Tables

catalog = Catalog()

CURRENCY_SQL = """CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'EUR' WHEN c_mktsegment = 'BUILDING' THEN 'CRC'
                       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'EUR' ELSE 'none' END"""
RATES_SQL = "(VALUES ('EUR', CAST(0.9 AS DOUBLE)), ('CRC', CAST(600 AS DOUBLE))) rates(currency, rate)"


# Every customer has orders and every order a customer. To have gaps, pending orders lose their
# customer, urgent ones get an unknown one, and customers in debt are given keys without orders.
_ORDER_KEY_SQL = """CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN -1 - o_custkey
                         ELSE o_custkey END"""
_CUSTOMER_KEY_SQL = "CASE WHEN c_acctbal < 0 THEN 1000000000000 + c_custkey ELSE c_custkey END"


def _order_key() -> Column:
    unknown = F.when(F.col("o_orderpriority") == "1-URGENT", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return F.when(F.col("o_orderstatus") != "P", unknown)


def _customer_key() -> Column:
    indebted = F.col("c_acctbal") < 0
    return F.when(indebted, F.col("c_custkey") + 1_000_000_000_000).otherwise(F.col("c_custkey"))


def customers_with_currency(t: Tables) -> DataFrame:
    """Every market segment is given a currency; two segments get one without a rate."""
    segment = F.col("c_mktsegment")
    currency = F.when(segment.isin("AUTOMOBILE", "HOUSEHOLD"), "EUR").when(segment == "BUILDING", "CRC")
    return t.customer.withColumn("currency", currency.otherwise("none"))


@catalog.query(
    """SELECT c_custkey, o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_inner_using(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return join_using(orders, t.customer.select("c_custkey", "c_name"), "c_custkey")


_PART_TOTALS_SQL = f"""
    SELECT l_partkey, l_suppkey, {money("l_extendedprice")} AS income,
           COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS days
    FROM lineitem GROUP BY l_partkey, l_suppkey"""


@catalog.query(_PART_TOTALS_SQL)
def join_inner_multi_key(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    income = tally(t.lineitem, keys, income=total("l_extendedprice", 2))
    days = tally(t.lineitem, keys, days=F.count_distinct(F.to_date("l_shipdate")))
    return join_using(income, days, keys)


@catalog.query(_PART_TOTALS_SQL)
def agg_fused_pair(t: Tables) -> DataFrame:
    # The same two aggregates in one pass over the table, without the join.
    return tally(
        t.lineitem,
        ["l_partkey", "l_suppkey"],
        income=total("l_extendedprice", 2),
        days=F.count_distinct(F.to_date("l_shipdate")),
    )


@catalog.query(
    """SELECT o_orderkey, o_custkey, c_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_inner_expr(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"])


@catalog.query(
    f"""SELECT c_custkey, currency, rate FROM (SELECT c_custkey, {CURRENCY_SQL} AS currency FROM customer) c
        JOIN {RATES_SQL} USING (currency)"""
)
def join_lookup_rates(t: Tables) -> DataFrame:
    customers = customers_with_currency(t).select("c_custkey", "currency")
    return join_using(customers, rates_table(t.spark, RATES), "currency")


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_linestatus, o_orderkey, o_orderstatus, o_orderpriority
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus""",
    name="join_on_pairs",
)
def join_pair_lists(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return join_on_pairs(lines, orders, ["l_orderkey", "l_linestatus"], ["o_orderkey", "o_orderstatus"])


@catalog.query(
    f"""SELECT COALESCE(o.key, c.key) AS key, o_orderkey, c_name
        FROM (SELECT {_ORDER_KEY_SQL} AS key, o_orderkey FROM orders) o
        FULL OUTER JOIN (SELECT {_CUSTOMER_KEY_SQL} AS key, c_name FROM customer) c ON o.key = c.key"""
)
def join_full_outer(t: Tables) -> DataFrame:
    orders = t.orders.select(_order_key().alias("key"), "o_orderkey")
    customers = t.customer.select(_customer_key().alias("key"), "c_name")
    return full_outer_to_entities(orders, customers, "key")


@catalog.query(
    """SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_quantity
       FROM orders o LEFT JOIN (
           SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber, l_quantity
           FROM lineitem) l ON o.o_orderkey = l.l_orderkey"""
)
def join_left_outer(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("o_orderkey"), "l_linenumber", "l_quantity"
    )
    return join_using(orders, lines, "o_orderkey", "left")


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, c_name, c_nationkey
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
)
def join_star_chain(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return chain(lines, (orders, "l_orderkey"), (customers, "o_custkey"))


@catalog.query(
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
                                               AND o_orderdate < TIMESTAMP '1996-02-01 00:00:00'"""
)
def join_left_period(t: Tables) -> DataFrame:
    at = F.col("o_orderdate")
    january = (at >= F.lit("1996-01-01").cast("timestamp_ntz")) & (at < F.lit("1996-02-01").cast("timestamp_ntz"))
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    joined = left_join_period(t.customer.select("c_custkey", "c_name"), orders, "c_custkey", january)
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


_HOT_SQL = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 > 0 THEN l_orderkey END AS key, l_linestatus FROM lineitem"""


def _hot_lines(t: Tables) -> DataFrame:
    """Lines of which a third has one key, many of them equal rows, and some no key."""
    key = F.col("l_orderkey")
    return t.lineitem.select(F.when(key % 3 == 0, F.lit(1)).when(key % 7 > 0, key).cast("long").alias("key"), "l_linestatus")


@catalog.query(f"SELECT l.key, l_linestatus, o_custkey, o_orderstatus FROM ({_HOT_SQL}) l JOIN orders ON l.key = o_orderkey")
def join_hot_key(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderstatus")
    return join_measured(_hot_lines(t), orders, "key")


@catalog.query(f"SELECT l.key, l_linestatus, o_custkey, o_orderstatus FROM ({_HOT_SQL}) l LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 1) ON l.key = o_orderkey")
def join_hot_key_left(t: Tables) -> DataFrame:
    orders = t.orders.filter("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderstatus")
    return join_measured(_hot_lines(t), orders, "key", "left")


@catalog.query(
    f"""WITH acts AS (SELECT o_orderkey, {_ORDER_KEY_SQL} AS key, o_totalprice,
                            CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE 'X' END AS flag
                     FROM orders),
            ents AS (SELECT {_CUSTOMER_KEY_SQL} AS key, c_name, c_nationkey FROM customer),
            routes AS (SELECT l_linestatus AS flag, COUNT(*) AS route_lines FROM lineitem GROUP BY l_linestatus)
       SELECT COALESCE(a.key, e.key) AS key, a.o_orderkey, a.o_totalprice, e.c_name, e.c_nationkey, a.flag,
              r.route_lines
       FROM acts a FULL OUTER JOIN ents e ON a.key = e.key LEFT JOIN routes r ON a.flag = r.flag"""
)
def unify_entities(t: Tables) -> DataFrame:
    activities = t.orders.select(
        "o_orderkey",
        _order_key().alias("key"),
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", "O").otherwise("X").alias("flag"),
    )
    entities = t.customer.select(_customer_key().alias("key"), "c_name", "c_nationkey")
    routes = t.lineitem.groupBy(F.col("l_linestatus").alias("flag")).agg(F.count("*").alias("route_lines"))
    return unify(activities, entities, "key", routes, "flag")


@catalog.query("SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return union_tables([customers, t.supplier.select("s_name", "s_acctbal")])


@catalog.query(
    """SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer
       UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier
       UNION SELECT c_nationkey, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def union_distinct(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    suppliers = t.supplier.select("s_nationkey", F.lit("SUPPLIER"))
    # Equal pairs of customer and priority collapse before they meet the customers.
    placed = t.orders.select("o_custkey", "o_orderpriority").distinct()
    orders = join_on_pairs(placed, t.customer, ["o_custkey"], ["c_custkey"]).select("c_nationkey", "o_orderpriority")
    return union_tables_distinct([customers, suppliers, orders])
