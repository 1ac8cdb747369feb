from __future__ import annotations

import datetime as dt

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.session import _staged, remove_scratch, scratch_path, stage_table
from tallyforge.sources import delimited, documents, relational
from tallyforge.sources.delimited import read_csv, read_csv_inferred, write_csv

DASHED = """
- '- numero_caja': 4
- '- compras':
  - '- compra':
    - '- nombre': leche
      cantidad: 3
      precio_unitario: 500
    - '- nombre': pan
      cantidad: 1
      precio_unitario: 250
  - '- compra':
    - '- nombre': leche
      cantidad: 1
      precio_unitario: 510
"""

MAPPED = """
numero_caja: 7
compras:
  - compra:
    - producto:
        nombre: jugo
        cantidad: 2
        precio_unitario: 300
        fecha: 2024/10/16
    - producto:
        nombre: arroz
        cantidad: 5
        precio_unitario: 100
    - producto:
        nombre: incompleto
        cantidad: 1
  - compra:
    - producto:
        nombre: papas
        cantidad: 1
        precio_unitario: 90
        fecha: 2024-10-17
"""


def test_csv_schema_names_win_over_header(spark, tmp_path, rows):
    path = tmp_path / "people.csv"
    path.write_text("ID,Name,Currency\n4,Olga,EUR\n9,Iván,CRC\n")
    df = read_csv(spark, str(path), "id int, name string, currency string")
    assert df.columns == ["id", "name", "currency"]
    assert rows(df) == [(4, "Olga", "EUR"), (9, "Iván", "CRC")]


def test_csv_inferred_types_and_positions(spark, tmp_path, rows):
    path = tmp_path / "activity.csv"
    path.write_text("1,10000001,2024-01-02\n2,10000002,2024-01-03\n")
    df = read_csv_inferred(spark, str(path), ["route", "id", "day"])
    assert dict(df.dtypes) == {"route": "int", "id": "int", "day": "date"}
    assert rows(df)[0] == (1, 10000001, dt.date(2024, 1, 2))
    with_header = tmp_path / "header.csv"
    with_header.write_text("Zone,Share\nnorth,5.5\n")
    assert dict(read_csv_inferred(spark, str(with_header), header=True).dtypes) == {
        "Zone": "string",
        "Share": "double",
    }


def test_csv_writes_the_number_of_files_asked_for(spark, tmp_path):
    df = spark.range(0, 100, 1, 4)
    for files in (1, 3, None):
        write_csv(df, str(tmp_path / str(files)), files=files)
    assert [len(list((tmp_path / str(n)).glob("*.csv"))) for n in (1, 3, None)] == [1, 3, 4]
    assert read_csv(spark, str(tmp_path / "3"), "id bigint").count() == 100


def test_tables_from_rows(table, rows):
    assert rows(table([], "a int, b string")) == []
    assert rows(table([{"a": 1}, {"a": 2, "b": "x"}], "a int, b string")) == [(1, None), (2, "x")]
    assert rows(table([(None, 1.5)], "a bigint, b double")) == [(None, 1.5)]


def test_documents_in_both_layouts(spark, tmp_path, rows):
    (tmp_path / "caja4.yaml").write_text(DASHED)
    (tmp_path / "caja7.yaml").write_text(MAPPED)
    (tmp_path / "caja8.yaml").write_text("numero_caja: 8\n")
    (tmp_path / "caja9.yaml").write_text("a: [1, 2\n")
    files = documents.read_document_files(spark, str(tmp_path / "caja*.yaml"))
    flat = documents.flatten_till_documents(files).drop("file")
    assert rows(documents.valid_lines(flat)) == [
        (4, "leche", 1.0, 510.0, None),
        (4, "leche", 3.0, 500.0, None),
        (4, "pan", 1.0, 250.0, None),
        (7, "arroz", 5.0, 100.0, None),
        (7, "jugo", 2.0, 300.0, dt.date(2024, 10, 16)),
        (7, "papas", 1.0, 90.0, dt.date(2024, 10, 17)),
    ]
    assert rows(documents.rejected_lines(flat), "till", "product", "problem") == [
        (None, None, "document without till or purchases"),
        (None, None, "unreadable document"),
        (7, "incompleto", "item without name, quantity or price"),
    ]


_ITEM = "  - producto: {nombre: a, cantidad: 1, precio_unitario: 2}\n"


def test_documents_with_unreadable_parts(table, rows):
    texts = [
        ("numero_caja: x\ncompras:\n- compra:\n" + _ITEM, "item with an unreadable number"),
        ("numero_caja: .inf\ncompras:\n- compra:\n" + _ITEM, "item with an unreadable number"),
        ("numero_caja: 3.7\ncompras:\n- compra:\n" + _ITEM, "item with an unreadable number"),
        (None, "document without till or purchases"),
        ("compras: []\nnumero_caja: 1", "document without purchases"),
        ("compras: 5\nnumero_caja: 1", "purchases that are no list"),
        ("compras: {a: 1}\nnumero_caja: 1", "purchases that are no list"),
        ("compras:\n- compra: 7\nnumero_caja: 1", "purchase that is no list of items"),
        ("a: 2001-15-45", "unreadable document"),
    ]
    for text, problem in texts:
        assert [item[-1] for item in documents._items(text)] == [problem]
    flat = documents.flatten_till_documents(table([(t,) for t, _ in texts], "text string"))
    assert rows(flat, "problem") == sorted((p,) for _, p in texts)
    with pytest.raises(ValueError, match="till lines"):
        documents.require_rows(documents.valid_lines(flat), "till lines")


def test_of_two_tills_the_first_counts(table, rows):
    two = "- numero_caja: 1\n- compras:\n  - compra:\n    - {nombre: a, cantidad: 1, precio_unitario: 2}\n- numero_caja: 2\n- compras: []\n"
    assert rows(documents.flatten_till_documents(table([(two,)], "text string"))) == [(1, "a", 1.0, 2.0, None, None)]


@pytest.mark.parametrize("name", ["leche", "Pan dulce", "yes", "null", "12", "a: b", "x #y", "ñ", "a"])
@pytest.mark.parametrize("layout", ["mapped", "dashed"])
def test_built_in_reading_agrees_with_the_parser(table, rows, name, layout):
    items = [(name, "2", "1.50", "2024/01/02"), ("b", "-1", "010", None), ("c", "1e3", "7", "2024-02-31"), ("d", "4", "0.5", "2024-02-03")]
    if layout == "mapped":
        block = "    - producto:\n        nombre: {0}\n        cantidad: {1}\n        precio_unitario: {2}\n"
        head, purchase, date = "numero_caja: 7\ncompras:\n", "  - compra:\n", "        fecha: {0}\n"
    else:
        block = "    - '- nombre': {0}\n      cantidad: {1}\n      precio_unitario: {2}\n"
        head, purchase, date = "- '- numero_caja': 7\n- '- compras':\n", "  - '- compra':\n", "      fecha: {0}\n"
    shown = [purchase + block.format(*item) + (date.format(item[3]) if item[3] else "") for item in items]
    texts = [head + part for part in shown] + [head + shown[0] + shown[3], head + shown[3] + shown[1], head]
    df = table([(k, t) for k, t in enumerate(texts)], "doc int, text string")
    expected = sorted(((k, *item) for k, t in enumerate(texts) for item in documents._items(t)), key=str)
    assert sorted(rows(documents.flatten_till_documents(df)), key=str) == expected


class Recorder:
    """Stands in for a reader or writer and for the object that hands it out; keeps what it was told."""

    def __init__(self):
        self.told, self.row = {}, None
        self.read = self.write = self

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **more):
        self.told.update(more)
        return self

    def load(self):
        return self

    def save(self):
        self.told["saved"] = True

    def first(self):
        return self.row


def test_jdbc_read_settings():
    spark = Recorder()
    split = relational.Split("id", 1, 1000, 8)
    relational.read_table(spark, {"url": "jdbc:x", "user": "u"}, "orders", split)
    assert spark.told == {
        "format": "jdbc",
        "url": "jdbc:x",
        "user": "u",
        "dbtable": "orders",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "8",
    }


def test_jdbc_column_range_is_computed_in_the_database():
    spark = Recorder()
    spark.row = (3, 9)
    assert relational.column_range(spark, {}, "sales.orders", "id") == (3, 9)
    assert spark.told["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM sales.orders) bounds"
    with pytest.raises(ValueError):
        relational.column_range(spark, {}, "orders; DROP TABLE x", "id")


def test_jdbc_write_settings(monkeypatch):
    monkeypatch.setattr(relational, "vectors_as_text", lambda df: df)
    df = Recorder()
    relational.write_table(df, {"url": "jdbc:x"}, "t", connections=4, column_types="a VARCHAR(9)", keep_definition=True)
    assert df.told == {
        "format": "jdbc",
        "mode": "overwrite",
        "url": "jdbc:x",
        "dbtable": "t",
        "numPartitions": "4",
        "batchsize": "5000",
        "truncate": "true",
        "createTableColumnTypes": "a VARCHAR(9)",
        "saved": True,
    }


def test_vectors_are_exported_as_text(spark, rows):
    df = spark.createDataFrame([(1, Vectors.dense([100.0]))], ["id", "v"])
    assert rows(relational.vectors_as_text(df)) == [(1, "[100.0]")]


def test_merge_statements():
    assert relational.merge_statement("metricas", "s", ["metrica", "fecha"], ["valor"], "postgresql") == (
        "INSERT INTO metricas (metrica, fecha, valor) SELECT metrica, fecha, valor FROM s "
        "ON CONFLICT (metrica, fecha) DO UPDATE SET valor = EXCLUDED.valor"
    )
    assert relational.merge_statement("m", "s", ["k"], ["v"], "ansi") == (
        "MERGE INTO m t USING s s ON t.k = s.k WHEN MATCHED THEN UPDATE SET v = s.v "
        "WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)"
    )
    with pytest.raises(ValueError):
        relational.merge_statement("m", "s", ["k"], ["v"], "other")


def test_database_upsert_stages_one_row_per_key(table, monkeypatch, rows):
    written, statements = [], []
    monkeypatch.setattr(relational, "write_table", lambda df, connection, name: written.append((name, rows(df))))
    batch = table([("a", "d", "1"), ("a", "d", "2"), ("b", "d", "9")], "metrica string, fecha string, valor string")
    relational.upsert_table(batch, {}, "metricas", ["metrica", "fecha"], statements.append)
    (staging, batch_rows), = written
    assert staging.startswith("metricas_staging_") and batch_rows == [("a", "d", "2"), ("b", "d", "9")]
    assert statements[0].startswith("INSERT INTO metricas") and statements[1:] == [f"DROP TABLE IF EXISTS {staging}"]


def test_staging_is_dropped_after_a_failed_merge(table, monkeypatch):
    monkeypatch.setattr(relational, "write_table", lambda *a: None)
    statements = []

    def execute(statement):
        statements.append(statement)
        if statement.startswith("INSERT"):
            raise RuntimeError("no such table")

    with pytest.raises(RuntimeError):
        relational.upsert_table(table([("a", "1")], "k string, v string"), {}, "t", ["k"], execute)
    assert statements[-1].startswith("DROP TABLE IF EXISTS t_staging_")


def test_an_unsplit_read_must_be_allowed():
    with pytest.raises(ValueError, match="split"):
        relational.read_table(Recorder(), {}, "orders")
    assert relational.read_table(Recorder(), {}, "orders", one_task=True).told["dbtable"] == "orders"


def test_staged_table_has_the_same_rows_and_a_cut_lineage(spark, plan):
    df = spark.range(100).groupBy("id").count()
    staged = stage_table(df, "test")
    assert staged.count() == 100 and staged.dtypes == df.dtypes
    assert "Exchange" not in plan(staged)


def test_scratch_needs_a_shared_folder():
    for master in ("spark://host:7077", "local[2]"):

        class Session:
            conf = {"spark.master": master}

        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session(), "x")


def test_staged_tables_can_be_removed(spark):
    import os

    stage_table(spark.range(3), "removed")
    paths = list(_staged[spark.sparkContext.applicationId])
    assert os.path.isdir(paths[-1].removeprefix("file:")) and remove_scratch(spark) == len(paths)
    assert not os.path.exists(paths[-1].removeprefix("file:")) and remove_scratch(spark) == 0


def test_malformed_csv_lines_are_rejects(spark, tmp_path, rows):
    lines = ["k,name,x", "1,a,1.5", "2,b", "3,c,1.5,z", "four,d,1.5", "5,e,high", "six,f,low", ",,", '7,"g, h",2', "8,i,", '9,"j,1.0']
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    marked = delimited.read_csv_marked(spark, str(tmp_path / "in.csv"), "k int, name string, x double")
    good, wrong = delimited.split_csv(marked)
    assert rows(good) == [(None, None, None), (1, "a", 1.5), (7, "g, h", 2.0), (8, "i", None)]
    found = {r["line"]: r["problems"] for r in wrong.collect()}
    assert found == {"2,b": ["fields"], "3,c,1.5,z": ["fields"], "four,d,1.5": ["k"], "5,e,high": ["x"], "six,f,low": ["k", "x"], '9,"j,1.0': ["fields"]}
    # Each side alone, and a single column, see the same lines.
    assert wrong.count() == 6 and good.select("x").count() == 4 and marked.select("problems").count() == 10
    (tmp_path / "none.csv").write_text("k,name,x\n")
    assert delimited.read_csv_marked(spark, str(tmp_path / "none.csv"), "k int, name string, x double").collect() == []


def test_documents_as_a_table_function_give_the_same_rows(spark, table, rows):
    texts = [
        "numero_caja: 1\ncompras:\n  - compra:\n    - producto:\n        nombre: pan\n        cantidad: 2\n        precio_unitario: 1.5\n        fecha: 2024/10/01\n",
        "numero_caja: 2\ncompras:\n- compra:\n  - {nombre: a, cantidad: many, precio_unitario: 2}\n  - {nombre: b, cantidad: 1, precio_unitario: 3}\n",
        "numero_caja: [",
        "",
        None,
    ]
    df = table(list(enumerate(texts)), "id int, text string")
    documents.register_till_lines(spark, "lines_of")
    found = spark.sql("SELECT d.id, l.* FROM {docs} d, LATERAL lines_of(d.text) l", docs=df)
    assert rows(found) == rows(documents.flatten_till_documents(df)) and found.count() == 6


def test_regular_documents_are_read_as_the_yaml_parser_reads_them(monkeypatch):
    item = "{{nombre: {}, cantidad: {}, precio_unitario: {}, fecha: {}}}"
    lines = [("part 12", "17.0", "200.10", "1995/01/02"), ("on x", "-3", "0.04", "1995-01-02"), ("yes", "1", "2", "1995-02-30"), ("a", "01", "1e3", "x")]
    texts, layouts = [], documents._WRITTEN
    for k, line in enumerate(lines):
        rest = "\n  - producto: {nombre: tax, cantidad: 1, precio_unitario: 0.5}\n"
        texts.append("numero_caja: 7\ncompras:\n- compra:\n  - producto: " + item.format(*line) + rest)
        name, quantity, price, day = line
        fields = f"cantidad: {quantity}\n{{0}}precio_unitario: {price}\n{{0}}fecha: {day}\n"
        texts.append("numero_caja: 7\ncompras:\n  - compra:\n    - producto:\n        nombre: " + f"{name}\n        " + fields.format(" " * 8))
        texts.append("- '- numero_caja': 7\n- '- compras':\n  - '- compra':\n    - '- nombre': " + f"{name}\n      " + fields.format(" " * 6))
    known = [any(whole.match(t) for whole, _ in layouts) for t in texts]
    found = [documents._items(t) for t in texts]
    monkeypatch.setattr(documents, "_WRITTEN", ())
    assert found == [documents._items(t) for t in texts] and known == [True] * 6 + [False] * 6


def test_documents_are_computed_once(table, plan):
    df = table([(1, "numero_caja: 1\ncompras: 5\n")], "id int, text string").groupBy("id").agg(F.max("text").alias("text"))
    assert plan(documents.flatten_till_documents(df)).count("Exchange") == 1
