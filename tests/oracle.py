"""Run registered queries beside their SQL and compare. ``python tests/oracle.py <base> [names...]``"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(base: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{base}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_by_name(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in rows)


def difference(spark, connection, base: str, name: str) -> str | None:
    """None when both sides agree in names, value types and rows; else what differs."""
    df = contract.queries()[name](spark, base)
    found = df.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if found else "no rows"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    if not found:
        return "no rows on either side"
    ours, theirs = rows_by_name(df.columns, found), rows_by_name(names, expected)
    if ours != theirs:
        return f"{sum((ours - theirs).values())} rows differ, such as {next(iter(ours - theirs))} against {next(iter(theirs - ours))}"
    return None


def main(base: str, wanted: list[str]) -> int:
    from tallyforge.session import build_session

    scratch = tempfile.mkdtemp(prefix="oracle-scratch-")
    spark = build_session("oracle", "local[8]", spark__checkpoint__dir=scratch, spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(base), 0
    for name in wanted or contract.queries():
        start = time.time()
        try:
            problem = difference(spark, connection, base, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(min(main(sys.argv[1], sys.argv[2:]), 1))
