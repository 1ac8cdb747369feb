"""Totals and metrics of till lines (``till, product, quantity, unit_price``)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import lenient_number, product, total
from tallyforge.operators.aggregates import extremes, leader
from tallyforge.operators.metrics import long_metrics
from tallyforge.operators.quantiles import approx_quantiles, beside, exact_quantiles, spread
from tallyforge.session import stage_table

# The names under which metrics are published.
METRIC_NAMES = {
    "best_till": "caja_con_mas_ventas",
    "worst_till": "caja_con_menos_ventas",
    "p25": "percentil_25_por_caja",
    "p50": "percentil_50_por_caja",
    "p75": "percentil_75_por_caja",
    "top_by_units": "producto_mas_vendido_por_unidad",
    "top_by_income": "producto_de_mayor_ingreso",
}
_QUARTILES = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def with_sale(lines: DataFrame, quantity: str = "quantity", unit_price: str = "unit_price") -> DataFrame:
    return lines.withColumn("sale", product(quantity, unit_price))


def totals_by_till(lines: DataFrame, till: str = "till", sale: str = "sale", places: int | None = None) -> DataFrame:
    return lines.groupBy(till).agg(total(sale, places).alias("total_sold"))


def totals_by_product(
    lines: DataFrame, name: str = "product", quantity: str = "quantity", places: int | None = None
) -> DataFrame:
    return lines.groupBy(name).agg(total(quantity, places).alias("units"))


def clean_totals_by_till(lines: DataFrame, till: str = "till", sale: str = "sale", places: int | None = None) -> DataFrame:
    """Returns (negative sales), unknown sales and unknown tills do not count; a sale of zero does."""
    kept = lines.withColumn(sale, lenient_number(sale)).filter(F.col(till).isNotNull() & (F.col(sale) >= 0))
    return totals_by_till(kept, till, sale, places)


def clean_totals_by_product(
    lines: DataFrame, name: str = "product", quantity: str = "quantity", places: int | None = None
) -> DataFrame:
    """Names are compared without case; only positive, known quantities of named products count."""
    kept = lines.filter(F.col(name).isNotNull() & F.col(quantity).isNotNull() & (F.col(quantity) > 0))
    return totals_by_product(kept.withColumn(name, F.lower(name)), name, quantity, places)


def till_metrics(totals: DataFrame, till: str = "till", exact: bool = True) -> DataFrame:
    """One row: ``best_till, worst_till`` and the quartiles of the till totals.

    The totals are stored once and read by every metric.
    """
    stored = stage_table(totals, "till-totals")
    find = exact_quantiles if exact else approx_quantiles
    quartiles = spread(find(stored, "total_sold", list(_QUARTILES)), [], _QUARTILES)
    return beside(extremes(stored, till, "total_sold", "best_till", "worst_till"), quartiles, [])


def product_metrics(
    lines: DataFrame,
    name: str = "product",
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    places: int | None = None,
) -> DataFrame:
    """One row: ``top_by_units, top_by_income``, both from one grouping of the lines."""
    per_product = lines.groupBy(name).agg(
        total(quantity, places).alias("units"), total(product(quantity, unit_price), places).alias("income")
    )
    return _product_leaders(per_product, name)


def report(lines: DataFrame, on: date, deduplicate: bool = True, places: int | None = None) -> DataFrame:
    """All metrics of ``till, product, quantity, unit_price`` lines in long form, dated ``on``.

    ``deduplicate`` merges equal lines first; that also merges genuine repeat purchases. The
    lines are read once: both groupings are taken from stored totals per till and product.
    """
    if deduplicate:
        lines = lines.dropDuplicates()
    pairs = with_sale(lines).groupBy("till", "product").agg(
        total("sale", places).alias("sale"), total("quantity", places).alias("quantity")
    )
    pairs = stage_table(pairs, "till-product-totals")
    per_product = pairs.groupBy("product").agg(
        total("quantity", places).alias("units"), total("sale", places).alias("income")
    )
    row = beside(till_metrics(totals_by_till(pairs, places=places)), _product_leaders(per_product, "product"), [])
    return long_metrics(row, METRIC_NAMES, F.lit(on))


def _product_leaders(per_product: DataFrame, name: str) -> DataFrame:
    return per_product.agg(leader(name, "units").alias("top_by_units"), leader(name, "income").alias("top_by_income"))
