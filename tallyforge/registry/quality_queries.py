"""Nulls, duplicates and validation. The tables have no nulls, so the queries make some."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.quality import (
    distinct_rows,
    drop_incomplete,
    fill,
    impute_mean,
    impute_median,
    null_counts,
    split_valid,
)
from tallyforge.operators.quantiles import beside, within_error
from tallyforge.registry.catalog import Catalog
from tallyforge.sources.tables import Tables

catalog = Catalog()

GAPPED_SQL = """gapped AS (
    SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS priority, NULLIF(o_orderstatus, 'F') AS status,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
    FROM orders)"""


def gapped(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


@catalog.query(
    f"""WITH {GAPPED_SQL} SELECT * FROM gapped
        WHERE priority IS NOT NULL AND status IS NOT NULL AND price IS NOT NULL"""
)
def drop_null_rows(t: Tables) -> DataFrame:
    return drop_incomplete(gapped(t))


@catalog.query(
    f"""WITH {GAPPED_SQL}
        SELECT o_orderkey, COALESCE(priority, 'unknown') AS priority, COALESCE(status, '?') AS status,
               COALESCE(price, 0.0) AS price
        FROM gapped"""
)
def fill_constant(t: Tables) -> DataFrame:
    return fill(gapped(t), {"priority": "unknown", "status": "?", "price": 0.0})


@catalog.query(
    f"""WITH {GAPPED_SQL}
        SELECT o_orderkey, COALESCE(price, (SELECT quantile_disc(price, 0.5) FROM gapped)) AS price FROM gapped""",
    name="impute_median",
)
def impute_median_exact(t: Tables) -> DataFrame:
    return impute_median(gapped(t).select("o_orderkey", "price"), ["price"])


@catalog.query()
def impute_median_sketch(t: Tables) -> DataFrame:
    """Prices with the gaps filled by the median of a sketch, which were gaps, and whether the fill is within the sketch's error."""
    accuracy = 100
    raw = gapped(t).select("o_orderkey", "price", F.col("price").isNull().alias("gap"))
    filled = impute_median(raw, ["price"], accuracy=accuracy)
    fill = filled.agg(F.lit(0.5).alias("p"), F.max(F.when(F.col("gap"), F.col("price"))).alias("value"))
    near = within_error(raw, "price", fill, accuracy).select(F.col("within").alias("near"))
    found = beside(filled, near, [])
    return found.select("o_orderkey", "price", "gap", (~F.col("gap") | F.col("near")).alias("within"))


@catalog.query(
    """WITH gapped AS (
           SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS quantity,
                  CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS price
           FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              ROUND(COALESCE(quantity, (SELECT AVG(quantity) FROM gapped)), 4) AS quantity,
              ROUND(COALESCE(price, (SELECT AVG(price) FROM gapped)), 4) AS price
       FROM gapped""",
    name="impute_mean",
)
def impute_mean_columns(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linestatus") != "F", F.col("l_extendedprice")).alias("price"),
    )
    filled = impute_mean(lines)
    return filled.withColumns({c: F.round(c, 4) for c in ("quantity", "price")})


@catalog.query(
    f"""WITH {GAPPED_SQL}
        SELECT COUNT(*) - COUNT(o_orderkey) AS o_orderkey, COUNT(*) - COUNT(priority) AS priority,
               COUNT(*) - COUNT(status) AS status, COUNT(*) - COUNT(price) AS price
        FROM gapped"""
)
def null_profile(t: Tables) -> DataFrame:
    return null_counts(gapped(t))


@catalog.query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def dedup_rows(t: Tables) -> DataFrame:
    return distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_tax"))


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN problems = '' THEN 'valid' ELSE 'rejected' END AS side, problems
       FROM (SELECT l_orderkey, l_linenumber, l_quantity,
                    concat_ws(',', CASE WHEN COALESCE(l_quantity <= 45, FALSE) THEN NULL ELSE 'quantity' END,
                                   CASE WHEN COALESCE(NULLIF(l_discount, 0) >= 0.01, FALSE) THEN NULL ELSE 'discount' END,
                                   CASE WHEN COALESCE(l_tax < 0.08, FALSE) THEN NULL ELSE 'tax' END) AS problems
             FROM lineitem)"""
)
def validate_split(t: Tables) -> DataFrame:
    rules = {
        "quantity": F.col("l_quantity") <= 45,
        "discount": F.nullif("l_discount", F.lit(0.0)) >= 0.01,
        "tax": F.col("l_tax") < 0.08,
    }
    valid, rejected = split_valid(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), rules)
    shown = ["l_orderkey", "l_linenumber", "l_quantity"]
    return valid.select(*shown, F.lit("valid").alias("side"), F.lit("").alias("problems")).unionByName(
        rejected.select(*shown, F.lit("rejected").alias("side"), F.array_join("problems", ",").alias("problems"))
    )
