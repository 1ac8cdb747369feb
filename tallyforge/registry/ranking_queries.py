"""Sorts and top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import total
from tallyforge.operators.ranking import (
    ranked_lists,
    sliced_rows,
    sort_rows,
    top_exact,
    top_overall,
    top_with_ties,
)
from tallyforge.registry.catalog import Catalog, money
from tallyforge.sources.tables import Tables

catalog = Catalog()

_SPEND_SQL = f"""spend AS (
    SELECT c_custkey, c_nationkey, n_orders, spent
    FROM (SELECT o_custkey AS c_custkey, COUNT(*) AS n_orders, {money("o_totalprice")} AS spent
          FROM orders GROUP BY o_custkey)
    JOIN customer USING (c_custkey))"""


def _order() -> list[Column]:
    return [F.desc("spent"), F.asc("c_custkey")]


def spend(t: Tables) -> DataFrame:
    """Customer totals with the customer's nation; aggregated first, so the join has one row per customer."""
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), total("o_totalprice", 2).alias("spent")
    )
    return totals.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")


@catalog.query(
    f"""WITH {_SPEND_SQL}
        SELECT c_custkey, c_nationkey, n_orders, CAST(position AS INTEGER) AS position
        FROM (SELECT *, RANK() OVER (PARTITION BY c_nationkey ORDER BY n_orders DESC) AS position FROM spend)
        WHERE position <= 5"""
)
def topn_rank(t: Tables) -> DataFrame:
    # Order counts tie often, so many nations keep more than five rows.
    top = top_with_ties(spend(t), "c_nationkey", [F.desc("n_orders")], 5, rank="position")
    return top.select("c_custkey", "c_nationkey", "n_orders", "position")


@catalog.query(
    f"""WITH {_SPEND_SQL}
        SELECT c_custkey, c_nationkey, n_orders, spent
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY spent DESC, c_custkey) AS position FROM spend)
        WHERE position <= 5"""
)
def topn_row_number(t: Tables) -> DataFrame:
    return top_exact(spend(t), "c_nationkey", _order(), 5)


@catalog.query(
    f"""WITH {_SPEND_SQL}
        SELECT c_nationkey, COUNT(*) AS n_listed,
               string_agg(position || ':' || c_custkey, ',' ORDER BY position) AS listed
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY spent DESC, c_custkey) AS position FROM spend)
        WHERE position <= 5 GROUP BY c_nationkey"""
)
def topn_ranked_list(t: Tables) -> DataFrame:
    lists = ranked_lists(spend(t), "c_nationkey", _order(), 5, ["c_custkey", "spent"])
    shown = F.transform("top", lambda e: F.concat_ws(":", e["rank"].cast("string"), e["c_custkey"].cast("string")))
    return lists.select(
        "c_nationkey", F.size("top").cast("bigint").alias("n_listed"), F.array_join(shown, ",").alias("listed")
    )


@catalog.query(
    f"""WITH {_SPEND_SQL}
        SELECT c_nationkey, CAST(position AS INTEGER) AS position, c_custkey, spent
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY spent DESC, c_custkey) AS position FROM spend)
        WHERE position <= 3"""
)
def topn_array_slice(t: Tables) -> DataFrame:
    lists = ranked_lists(spend(t), "c_nationkey", _order(), 5, ["c_custkey", "spent"])
    return sliced_rows(lists, "c_nationkey", 3).withColumnRenamed("rank", "position")


@catalog.query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus DESC, o_totalprice DESC")
def sort_multi_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sort_rows(rows, ["o_orderstatus", "o_totalprice"], ascending=False)


@catalog.query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk_global(t: Tables) -> DataFrame:
    return top_overall(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
