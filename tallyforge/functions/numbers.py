"""Sums, ratios and conversions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

_LOW_BITS = 20
_LARGEST = 2.0**62


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


def total(column: ColumnLike, places: int | None = None) -> Column:
    """Sum; with ``places`` an exact sum of values that have at most that many decimals.

    A plain sum of doubles differs from run to run with the order of the rows, and a decimal
    sum costs several times as much. Here the values are counted in whole units (cents for two
    places), and the units' high and low bits are summed as two integers that cannot overflow.
    NaN, infinities and values too large to be counted so are summed plainly beside them.
    """
    if places is None:
        return F.sum(column)
    scale = 10**places
    value = _col(column).cast("double")
    counted = F.abs(value) < _LARGEST / scale  # false for NaN, which is above all numbers
    units = F.when(counted, F.rint(value * scale).cast("bigint"))
    high, low = F.sum(F.shiftright(units, _LOW_BITS)), F.sum(units.bitwiseAND(2**_LOW_BITS - 1))
    exact = (high.cast("double") * 2**_LOW_BITS + low.cast("double")) / scale
    plain = F.sum(F.when(~counted, value))
    return F.when(plain.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + plain)


def mean(column: ColumnLike, places: int | None = None) -> Column:
    """Mean; with ``places`` an exact total divided by the non-null count."""
    if places is None:
        return F.avg(column)
    return F.try_divide(total(column, places), F.count(column))


def ratio(numerator: ColumnLike, denominator: ColumnLike, places: int | None = None) -> Column:
    """Quotient, null where the divisor is zero, optionally rounded half up."""
    quotient = F.try_divide(_col(numerator), _col(denominator))
    return quotient if places is None else F.round(quotient, places)


def product(*columns: ColumnLike) -> Column:
    result = _col(columns[0])
    for column in columns[1:]:
        result = result * _col(column)
    return result


def conversions(amount: ColumnLike, rates: Mapping[str, float], prefix: str = "amount_in_") -> dict[str, Column]:
    """One converted column per currency, for ``withColumns``."""
    return {f"{prefix}{currency.lower()}": _col(amount) * F.lit(rate) for currency, rate in rates.items()}


def lenient_number(column: ColumnLike, target: str = "double") -> Column:
    """Cast that yields null for malformed text."""
    return _col(column).try_cast(target)


def as_decimal(column: ColumnLike, precision: int = 10, scale: int = 0) -> Column:
    """Decimal cast with stated precision and scale; the defaults round to whole units."""
    return _col(column).cast(T.DecimalType(precision, scale))
