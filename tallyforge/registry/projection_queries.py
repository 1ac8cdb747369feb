"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.categories import encode, flag
from tallyforge.functions.dates import day_from_text, day_from_text_udf, day_of, day_text
from tallyforge.functions.numbers import as_decimal, conversions, lenient_number, product, ratio
from tallyforge.operators.projection import pick, without
from tallyforge.plans.daily_spend import RATES
from tallyforge.registry.catalog import Catalog, half_up
from tallyforge.sources.tables import Tables

catalog = Catalog()


@catalog.query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def project_columns(t: Tables) -> DataFrame:
    return pick(t.orders, ["o_orderkey", F.col("o_custkey"), "o_orderpriority"])


@catalog.query("SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS total_sale FROM lineitem")
def derive_product(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", product("l_quantity", "l_extendedprice").alias("total_sale"))


@catalog.query(
    """SELECT o_orderkey, o_totalprice AS amount, o_totalprice * CAST(0.9 AS DOUBLE) AS amount_in_eur,
              o_totalprice * CAST(600 AS DOUBLE) AS amount_in_crc
       FROM orders"""
)
def convert_fixed_rates(t: Tables) -> DataFrame:
    amounts = t.orders.select("o_orderkey", F.col("o_totalprice").alias("amount"))
    return amounts.withColumns(conversions("amount", RATES))


@catalog.query(
    f"""SELECT l_orderkey, l_linenumber, {half_up("l_extendedprice / l_quantity")} AS unit_price,
               CASE WHEN l_discount = 0 THEN NULL ELSE {half_up("l_tax / l_discount")} END AS tax_to_discount
        FROM lineitem"""
)
def derive_ratio(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        ratio("l_extendedprice", "l_quantity", 2).alias("unit_price"),
        ratio("l_tax", "l_discount", 2).alias("tax_to_discount"),
    )


@catalog.query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def drop_column(t: Tables) -> DataFrame:
    return without(t.customer, "c_mktsegment", "year")


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity > 10 AND l_discount <= 0.08 AND l_returnflag = 'R'
         AND l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'"""
)
def filter_compare(t: Tables) -> DataFrame:
    wanted = (
        (F.col("l_quantity") > 10)
        & (F.col("l_discount") <= 0.08)
        & (F.col("l_returnflag") == "R")
        & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    )
    return t.lineitem.filter(wanted).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@catalog.query(
    """SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS priority, o_orderstatus = 'P' AS pending
       FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NOT NULL OR NULLIF(o_orderstatus, 'P') IS NULL"""
)
def filter_not_null(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )
    kept = rows.filter(F.col("priority").isNotNull() | F.col("status").isNull())
    return kept.select("o_orderkey", "priority", F.col("status").isNull().alias("pending"))


@catalog.query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS amount,
              CAST(ROUND(CAST(o_totalprice AS DECIMAL(18, 2)), 0) AS BIGINT) AS whole_amount,
              CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS narrow_amount
       FROM orders"""
)
def cast_types(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_totalprice").cast("string"))
    return t.orders.select(
        "o_orderkey",
        lenient_number(text).alias("amount"),
        as_decimal(F.col("o_totalprice").cast("decimal(18,2)"), 18).cast("bigint").alias("whole_amount"),
        F.col("o_totalprice").cast("float").cast("double").alias("narrow_amount"),
    )


@catalog.query(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_building,
              CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 0 WHEN c_mktsegment = 'BUILDING' THEN 1
                   WHEN c_mktsegment = 'HOUSEHOLD' THEN 2 ELSE 3 END AS segment_code
       FROM customer"""
)
def encode_categories(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        flag("c_mktsegment", "BUILDING").alias("is_building"),
        encode("c_mktsegment", {"AUTOMOBILE": 0, "BUILDING": 1, "HOUSEHOLD": 2}, 3).alias("segment_code"),
    )


@catalog.query("SELECT p_partkey, LOWER(p_name) AS name, LOWER(p_brand) AS brand, LOWER(p_type) AS kind FROM part")
def string_lower(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.lower("p_name").alias("name"), F.lower("p_brand").alias("brand"), F.lower("p_type").alias("kind")
    )


@catalog.query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS date_string FROM orders")
def date_format_text(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", day_text("o_orderdate").alias("date_string"))


@catalog.query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS day_through_text,
              CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_number
       FROM events"""
)
def truncate_to_day(t: Tables) -> DataFrame:
    through_text = day_from_text(day_text("ts"))
    return t.events.select(
        "event_id",
        day_of("ts").cast("string").alias("day"),
        through_text.cast("string").alias("day_through_text"),
        F.date_diff(day_of("ts"), F.lit("2024-01-01").cast("date")).alias("day_number"),
    )


@catalog.query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def udf_parse_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", day_from_text_udf(day_text("o_orderdate")).cast("string").alias("day"))
