"""The ready-made pipelines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import ratio, total
from tallyforge.plans import crossing
from tallyforge.plans import till_reports as tills
from tallyforge.plans.daily_spend import RATES, daily_spend, in_fixed_currencies, in_own_currency, with_names
from tallyforge.plans.top_entities import activity_per_entity, top_per_region, with_daily_average
from tallyforge.registry.catalog import Catalog, half_up, money
from tallyforge.registry.join_queries import CURRENCY_SQL, RATES_SQL, customers_with_currency
from tallyforge.operators.upsert import upsert
from tallyforge.session import stage_table
from tallyforge.sources.memory import rates_table
from tallyforge.sources.tables import Tables

catalog = Catalog()

_REGION_SQL = f"""per_customer AS (
        SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS total,
               COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS active_days
        FROM orders GROUP BY o_custkey),
    averaged AS (
        SELECT c_custkey, c_name, n_name, CAST(total AS DOUBLE) AS total, active_days,
               {half_up("CAST(total AS DOUBLE) / active_days")} AS daily_average
        FROM per_customer JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _customers_by_nation(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.select("c_custkey", "c_name", "c_nationkey").join(nations, "c_nationkey").drop("c_nationkey")


def _customer_activity(t: Tables) -> DataFrame:
    activities = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    return with_daily_average(activity_per_entity(activities, "c_custkey", "o_totalprice", "day", places=2))


@catalog.query(
    f"""WITH {_REGION_SQL}
        SELECT c_custkey, c_name, n_name, total, active_days, daily_average
        FROM (SELECT *, RANK() OVER (PARTITION BY n_name ORDER BY total DESC, daily_average DESC) AS r FROM averaged)
        WHERE r <= 5"""
)
def top5_per_region(t: Tables) -> DataFrame:
    return top_per_region(_customer_activity(t), _customers_by_nation(t), "c_custkey", "n_name", 5)


_DAILY_SQL = f"""daily AS (
        SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS day, {money("o_totalprice")} AS amount
        FROM orders GROUP BY 1, 2)"""


def _daily(t: Tables) -> DataFrame:
    return daily_spend(t.orders, "o_custkey", "o_totalprice", "o_orderdate", places=2)


def _day_shown(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


@catalog.query(
    f"""WITH {_DAILY_SQL}
        SELECT customer_id, day, amount, ROUND(amount * CAST(0.9 AS DOUBLE), 4) AS amount_in_eur,
               ROUND(amount * CAST(600 AS DOUBLE), 4) AS amount_in_crc
        FROM daily"""
)
def daily_spend_fixed_fx(t: Tables) -> DataFrame:
    converted = in_fixed_currencies(_daily(t))
    return _day_shown(converted).withColumns({c: F.round(c, 4) for c in ("amount_in_eur", "amount_in_crc")})


@catalog.query(
    f"""WITH {_DAILY_SQL}
        SELECT customer_id, day, amount, c_custkey, c_name FROM daily JOIN customer ON customer_id = c_custkey"""
)
def daily_spend_named(t: Tables) -> DataFrame:
    return _day_shown(with_names(_daily(t), t.customer.select("c_custkey", "c_name"), "c_custkey"))


@catalog.query(
    f"""WITH {_DAILY_SQL}
        SELECT customer_id, c_name AS name, day, ROUND(amount * rate, 4) AS adjusted_amount
        FROM daily JOIN (SELECT c_custkey, c_name, {CURRENCY_SQL} AS currency FROM customer) c ON customer_id = c_custkey
        JOIN {RATES_SQL} USING (currency)"""
)
def daily_spend_own_currency(t: Tables) -> DataFrame:
    own = in_own_currency(_daily(t), customers_with_currency(t), rates_table(t.spark, RATES), "c_custkey", "c_name")
    return _day_shown(own).withColumn("adjusted_amount", F.round("adjusted_amount", 4))


_LINES_SQL = """lines AS (
        SELECT l_suppkey AS till, 'Part ' || l_partkey AS product, l_quantity AS quantity, l_extendedprice AS unit_price
        FROM lineitem)"""


def _lines(lineitem: DataFrame) -> DataFrame:
    """Order lines as till lines: the supplier is the till, the part the product."""
    return lineitem.select(
        F.col("l_suppkey").alias("till"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("product"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


# Dirty lines: returns, unnamed tills and products, unknown quantities, names differing in case only.
_DIRTY_SQL = """dirty AS (
        SELECT NULLIF(l_suppkey, 7) AS till,
               CASE WHEN l_linestatus = 'F' THEN 'PART ' ELSE 'part ' END || NULLIF(l_partkey, 11) AS product,
               CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE NULLIF(l_quantity, 13) END AS quantity,
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice WHEN l_discount = 0 THEN NULL
                    ELSE l_extendedprice * (CASE WHEN l_tax = 0 THEN 0 ELSE 1 END) END AS sale
        FROM lineitem)"""


def _dirty(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    price = F.when(F.col("l_tax") == 0, 0.0).otherwise(F.col("l_extendedprice"))
    return t.lineitem.select(
        F.nullif("l_suppkey", F.lit(7)).alias("till"),
        F.concat(
            F.when(F.col("l_linestatus") == "F", "PART ").otherwise("part "),
            F.nullif("l_partkey", F.lit(11)).cast("string"),
        ).alias("product"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.nullif("l_quantity", F.lit(13.0))).alias("quantity"),
        F.when(returned, -F.col("l_extendedprice")).when(F.col("l_discount") != 0, price).alias("sale"),
    )


@catalog.query(f"WITH {_LINES_SQL} SELECT till, {money('quantity * unit_price')} AS total_sold FROM lines GROUP BY till")
def totals_by_till(t: Tables) -> DataFrame:
    return tills.totals_by_till(tills.with_sale(_lines(t.lineitem)), places=2)


@catalog.query(f"WITH {_LINES_SQL} SELECT product, {money('quantity')} AS units FROM lines GROUP BY product")
def totals_by_product(t: Tables) -> DataFrame:
    return tills.totals_by_product(_lines(t.lineitem), places=2)


@catalog.query(
    f"""WITH {_DIRTY_SQL} SELECT till, {money("sale")} AS total_sold FROM dirty
        WHERE till IS NOT NULL AND sale >= 0 GROUP BY till"""
)
def totals_by_till_clean(t: Tables) -> DataFrame:
    return tills.clean_totals_by_till(_dirty(t), places=2)


@catalog.query(
    f"""WITH {_DIRTY_SQL} SELECT LOWER(product) AS product, {money("quantity")} AS units FROM dirty
        WHERE product IS NOT NULL AND quantity > 0 GROUP BY LOWER(product)"""
)
def totals_by_product_clean(t: Tables) -> DataFrame:
    return tills.clean_totals_by_product(_dirty(t), places=2)


def _metrics_sql(source: str) -> str:
    return f"""till_totals AS (
            SELECT till, {money("quantity * unit_price")} AS total_sold FROM {source} GROUP BY till),
        product_totals AS (
            SELECT product, {money("quantity")} AS units, {money("quantity * unit_price")} AS income
            FROM {source} GROUP BY product),
        wide AS (
            SELECT (SELECT till FROM till_totals ORDER BY total_sold DESC, till DESC LIMIT 1) AS best_till,
                   (SELECT till FROM till_totals ORDER BY total_sold, till LIMIT 1) AS worst_till,
                   (SELECT quantile_disc(total_sold, 0.25) FROM till_totals) AS p25,
                   (SELECT quantile_disc(total_sold, 0.5) FROM till_totals) AS p50,
                   (SELECT quantile_disc(total_sold, 0.75) FROM till_totals) AS p75,
                   (SELECT product FROM product_totals ORDER BY units DESC, product DESC LIMIT 1) AS top_by_units,
                   (SELECT product FROM product_totals ORDER BY income DESC, product DESC LIMIT 1) AS top_by_income)"""


@catalog.query(f"WITH {_LINES_SQL}, {_metrics_sql('lines')} SELECT best_till, worst_till, p25, p50, p75 FROM wide")
def till_metrics(t: Tables) -> DataFrame:
    return tills.till_metrics(tills.totals_by_till(tills.with_sale(_lines(t.lineitem)), places=2))


@catalog.query(f"WITH {_LINES_SQL}, {_metrics_sql('lines')} SELECT top_by_units, top_by_income FROM wide")
def product_metrics(t: Tables) -> DataFrame:
    return tills.product_metrics(_lines(t.lineitem), places=2)


def _long_sql() -> str:
    rows = []
    for column, name in tills.METRIC_NAMES.items():
        number = "CAST(NULL AS DOUBLE)" if column.startswith("top") else f"CAST({column} AS DOUBLE)"
        text = f"CAST(CAST({column} AS DECIMAL(38, 2)) AS VARCHAR)" if column.startswith("p") else f"CAST({column} AS VARCHAR)"
        rows.append(f"SELECT '{name}' AS metric, {text} AS value, {number} AS value_num, '2024-10-16' AS day FROM wide")
    return " UNION ALL ".join(rows)


@catalog.query(
    f"""WITH {_LINES_SQL}, unique_lines AS (SELECT DISTINCT * FROM lines), {_metrics_sql("unique_lines")} {_long_sql()}"""
)
def metrics_long(t: Tables) -> DataFrame:
    return _day_shown(tills.report(_lines(t.lineitem), date(2024, 10, 16), places=2))


def _report_sql(condition: str, day: str) -> str:
    lines = _LINES_SQL.replace("FROM lineitem", f"FROM lineitem WHERE {condition}")
    rows = _long_sql().replace("2024-10-16", day)
    return f"SELECT * FROM (WITH {lines}, unique_lines AS (SELECT DISTINCT * FROM lines), {_metrics_sql('unique_lines')} {rows})"


@catalog.query(f"""{_report_sql("l_linestatus = 'O'", "2024-10-16")} UNION ALL {_report_sql("l_returnflag <> 'R'", "2024-10-17")}""")
def metrics_upserted(t: Tables) -> DataFrame:
    """Reports of two dates put into one table; the first date is reported again and replaces its rows."""
    first, second = date(2024, 10, 16), date(2024, 10, 17)

    def made(kept: str | None, on: date) -> DataFrame:
        chosen = t.lineitem.filter(kept) if kept else t.lineitem
        return tills.report(_lines(chosen), on, places=2)

    stored = made(None, first)
    for changes in (made("l_returnflag <> 'R'", second), made("l_linestatus = 'O'", first)):
        stored = upsert(stored, changes, ["metric", "day"])
    return _day_shown(stored)


# Customers stand for census rows, yearly order figures per nation for crime rows.
_CROSS_SQL = f"""census AS (
        SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment, c_nationkey AS nation,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS balance
        FROM customer),
    crimes AS (
        SELECT c_nationkey AS nation_key, year(o_orderdate) AS year, COUNT(*) AS n_orders,
               CASE WHEN year(o_orderdate) = 1997 THEN NULL
                    ELSE {money("o_totalprice")} / COUNT(o_totalprice) END AS average
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _census(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).alias("balance"),
    )


def _crimes(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n_orders"), total("o_totalprice", 2).alias("spent")
    )
    yearly = (
        per_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("nation_key")), "c_custkey")
        .groupBy("nation_key", "year")
        .agg(F.sum("n_orders").alias("n_orders"), total("spent", 2).alias("spent"))
    )
    average = F.when(F.col("year") != 1997, ratio("spent", "n_orders"))
    # Stored, because imputing reads it twice.
    return stage_table(yearly.select("nation_key", "year", "n_orders", average.alias("average")), "yearly-orders")


@catalog.query(
    f"""WITH {_CROSS_SQL}
        SELECT c_custkey, segment, nation, balance, nation_key, n_orders, average
        FROM (SELECT * FROM census WHERE segment IS NOT NULL AND nation IS NOT NULL AND balance IS NOT NULL)
        JOIN (SELECT * FROM crimes WHERE average IS NOT NULL) ON nation = nation_key"""
)
def clean_and_cross(t: Tables) -> DataFrame:
    return crossing.cross(_census(t), _crimes(t), "nation", "nation_key", crossing.clean, ("year",))["crossed"]


@catalog.query(
    f"""WITH {_CROSS_SQL}
        SELECT c_custkey, segment, nation, ROUND(COALESCE(balance, (SELECT AVG(balance) FROM census)), 4) AS balance,
               nation_key, n_orders, ROUND(COALESCE(average, (SELECT AVG(average) FROM crimes)), 4) AS average
        FROM census JOIN crimes ON nation = nation_key"""
)
def impute_and_cross(t: Tables) -> DataFrame:
    crossed = crossing.cross(_census(t), _crimes(t), "nation", "nation_key", crossing.impute, ("year",))["crossed"]
    return crossed.withColumns({c: F.round(c, 4) for c in ("balance", "average")})


@catalog.query(
    f"""SELECT n_regionkey, n_name, strftime(o_orderdate, '%Y-%m-%d') AS day, {money("o_totalprice")} AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3"""
)
def region_day_totals(t: Tables) -> DataFrame:
    """Totals by region, entity group and day; spend is first reduced to customer and day."""
    per_customer_day = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day")
    ).agg(total("o_totalprice", 2).alias("amount"))
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    placed = per_customer_day.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey").join(nations, "c_nationkey")
    return _day_shown(placed.groupBy("n_regionkey", "n_name", "day").agg(total("amount", 2).alias("amount")))
