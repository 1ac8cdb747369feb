"""Days as text and as dates."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: how a day is written as text.
DAY_TEXT = "MM/dd/yyyy"
_DAY_TEXT_PYTHON = "%m/%d/%Y"


def day_text(timestamp: Column | str, pattern: str = DAY_TEXT) -> Column:
    return F.date_format(timestamp, pattern)


def day_from_text(text: Column | str, pattern: str = DAY_TEXT) -> Column:
    return F.to_date(text, pattern)


def day_of(timestamp: Column | str) -> Column:
    """The day of a timestamp, directly: no trip through text."""
    return F.to_date(timestamp)


@F.pandas_udf(T.DateType())
def day_from_text_udf(text: pd.Series) -> pd.Series:
    """The same parse as a user-defined function, for formats the built-in parser lacks."""
    return pd.to_datetime(text, format=_DAY_TEXT_PYTHON).dt.date
