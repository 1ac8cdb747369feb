from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyforge.session import build_session  # noqa: E402
from tallyforge.sources.memory import table_from_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table(rows, schema)``: a small DataFrame."""
    return lambda rows, schema: table_from_rows(spark, rows, schema)


def _rows(df, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


@pytest.fixture
def rows():
    return _rows


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text, before adaptive changes."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
