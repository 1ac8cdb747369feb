from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
import oracle
from tallyforge.registry import entries

BASE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(BASE)


@pytest.mark.parametrize("name", list(entries()))
def test_query_gives_the_rows_of_its_sql(spark, connection, name):
    assert oracle.difference(spark, connection, BASE, name) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["c_custkey", "c_name", "n_name", "total", "active_days", "daily_average"]


#: Fitted models and sketches; tests/test_models.py and tests/test_sketches.py compare these with plain versions.
WITHOUT_SQL = {
    "ml_logistic_cv", "ml_logistic_search", "ml_random_forest", "ml_predictions_export", "ml_forest_table", "ml_forest_walk",
    "percentile_approx_column", "percentile_merged_sketches", "impute_median_sketch",
}


def test_every_other_query_has_sql():
    assert {name for name, found in entries().items() if not found.sql} == WITHOUT_SQL


def test_flagship_plan(spark, plan):
    text = plan(contract.queries()["top5_per_region"](spark, BASE))
    assert "WindowGroupLimit" in text and "Python" not in text
    # Spend by customer and day, then by customer, then parts of a region and the region.
    assert text.count("Exchange hashpartitioning") <= 5
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_filters_and_columns_reach_the_scan(spark, capsys):
    contract.queries()["filter_compare"](spark, BASE).explain("formatted")
    text = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull" in text and "GreaterThan(l_quantity,10.0)" in text


def test_hot_paths_stay_in_the_jvm(spark, plan):
    for name in ("daily_spend_own_currency", "totals_by_till_clean", "topn_array_slice", "clean_and_cross"):
        assert "Python" not in plan(contract.queries()[name](spark, BASE))


_ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", {scratch!r}).config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.queries()["join_hot_key"](spark, {base!r}).count())
"""


def test_tasks_find_the_package_wherever_the_driver_was_started(tmp_path):
    code = _ELSEWHERE.format(repo=str(Path(contract.__file__).resolve().parent), scratch=str(tmp_path / "scratch"), base=BASE)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "rows" in done.stdout, done.stderr[-2000:]


def test_queries_outside_the_subpackage_survive_without_it(monkeypatch):
    monkeypatch.setitem(sys.modules, "tallyforge.llm.queries", None)
    assert set(contract.queries()) == set(entries())
