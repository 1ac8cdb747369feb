"""Daily spend per customer, with currency conversion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.dates import day_of
from tallyforge.functions.numbers import conversions, product, total

# Units of each currency per unit of the booking currency.
RATES = {"EUR": 0.9, "CRC": 600.0}


def daily_spend(transactions: DataFrame, customer: str, amount: str, at: str, places: int | None = None) -> DataFrame:
    """``customer_id, day, amount``: one row per customer and day."""
    return transactions.groupBy(F.col(customer).alias("customer_id"), day_of(at).alias("day")).agg(
        total(amount, places).alias("amount")
    )


def in_fixed_currencies(daily: DataFrame, rates: Mapping[str, float] = RATES) -> DataFrame:
    return daily.withColumns(conversions("amount", rates))


def with_names(daily: DataFrame, customers: DataFrame, customer_id: str) -> DataFrame:
    """Customer columns beside each daily row; the spend is aggregated before this join."""
    return daily.join(customers, daily["customer_id"] == customers[customer_id])


def in_own_currency(
    daily: DataFrame, customers: DataFrame, rates: DataFrame, customer_id: str, name: str, currency: str = "currency"
) -> DataFrame:
    """Spend in each customer's own currency; customers whose currency has no rate drop out.

    Rates meet the customers first, so customers without one never reach the large join.
    """
    priced = customers.join(rates, currency).select(customer_id, name, "rate")
    adjusted = daily.join(priced, daily["customer_id"] == priced[customer_id])
    return adjusted.select("customer_id", F.col(name).alias("name"), "day", product("amount", "rate").alias("adjusted_amount"))
