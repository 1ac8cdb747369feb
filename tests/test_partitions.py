from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.partitions import PartitionedTable, added, keyed

SCHEMA = "metric string, value double, day date"
D1, D2, D3 = (dt.date(2024, 10, d) for d in (16, 17, 18))


@pytest.fixture
def stored(spark, tmp_path, table):
    made = PartitionedTable(spark, str(tmp_path / "metrics"), SCHEMA)
    made.change(table([("a", 1.0, D1), ("b", 2.0, D1), ("a", 3.0, D2), ("a", 9.0, None)], SCHEMA), keyed(["metric", "day"]))
    return made


def files(made, day):
    return {p.name for p in Path(made.path, f"day={day}").glob("*.parquet")}


def test_only_touched_dates_are_rewritten(stored, table, rows):
    before = {d: files(stored, d) for d in (D1, D2)}
    assert stored.change(table([("a", 5.0, D1), ("a", 4.0, D1), ("c", 6.0, D3)], SCHEMA), keyed(["metric", "day"]))
    assert rows(stored.rows()) == [("a", 3.0, D2), ("a", 5.0, D1), ("a", 9.0, None), ("b", 2.0, D1), ("c", 6.0, D3)]
    assert files(stored, D2) == before[D2] and files(stored, D1).isdisjoint(before[D1])


def test_null_dates_and_versions(stored, table, rows):
    stored.change(table([("a", 8.0, None), ("b", 7.0, D2)], SCHEMA), keyed(["metric", "day"]))
    # A null key equals nothing, so both rows without a date stay.
    assert rows(stored.rows().filter("day IS NULL")) == [("a", 8.0, None), ("a", 9.0, None)]
    assert stored.rows().count() == 6


def test_values_are_added(stored, table, rows):
    change = table([("a", 1.0, D1), ("z", 1.0, D1), ("a", None, D2)], SCHEMA)
    stored.change(change, added(["metric", "day"], ["value"]), name="first")
    assert not stored.change(change, added(["metric", "day"], ["value"]), name="first")
    assert rows(stored.rows().filter("day IS NOT NULL")) == [("a", 2.0, D1), ("a", 3.0, D2), ("b", 2.0, D1), ("z", 1.0, D1)]


def test_a_change_cut_short_is_finished_or_dropped(stored, table, rows, monkeypatch):
    before = rows(stored.rows())
    change = table([("a", 50.0, D2)], SCHEMA)
    # The job dies after the change was written whole, before the partitions are replaced.
    monkeypatch.setattr(PartitionedTable, "_apply", lambda self, pending: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        stored.change(change, keyed(["metric", "day"]), name="late")
    monkeypatch.undo()
    assert rows(stored.rows()) == before
    assert stored.recover() == 1 and stored.recover() == 0
    assert rows(stored.rows().filter(F.col("day") == F.lit(D2))) == [("a", 50.0, D2)]
    assert not stored.change(change, keyed(["metric", "day"]), name="late")
    # A change that was not written whole is dropped.
    Path(stored.path, "_pending", "half").mkdir(parents=True)
    assert stored.recover() == 0 and not Path(stored.path, "_pending", "half").exists()


def test_tables_and_changes_without_rows(spark, tmp_path, table, rows):
    made = PartitionedTable(spark, str(tmp_path / "none"), SCHEMA, files=3)
    assert made.rows().columns == ["metric", "value", "day"] and made.rows().count() == 0
    made.change(table([], SCHEMA), keyed(["metric", "day"]))
    assert made.rows().count() == 0
    made.change(table([(str(k), float(k), D1) for k in range(50)], SCHEMA), keyed(["metric", "day"]))
    assert made.rows().count() == 50 and 1 <= len(files(made, D1)) <= 3
