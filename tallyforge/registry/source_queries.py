"""Scans, sinks, nested documents, streams and upsert."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import total
from tallyforge.operators.partitions import PartitionedTable, added, keyed
from tallyforge.operators.projection import preview
from tallyforge.operators.upsert import upsert
from tallyforge.registry.catalog import Catalog, money
from tallyforge.session import scratch_path
from tallyforge.sources.delimited import read_csv, read_csv_inferred, read_csv_marked, split_csv, write_csv
from tallyforge.sources.documents import flatten_till_documents, register_till_lines, rejected_lines, valid_lines
from tallyforge.sources.tables import Tables
from tallyforge.streaming.messages import as_text, folder_messages, to_parquet
from tallyforge.streaming.upserts import into_table

catalog = Catalog()


@catalog.query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(t.spark, path, schema)


@catalog.query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def scan_csv_infer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "part-csv")
    names = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    write_csv(t.part.select(*names), path, header=False)
    inferred = read_csv_inferred(t.spark, path, names)
    # Inference picks the narrowest type the data needs, so the key's width varies with the data.
    return inferred.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@catalog.query(
    f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines, {money("l_quantity")} AS units
        FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "status-totals-csv")
    totals = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_lines"), total("l_quantity", 2).alias("units")
    )
    write_csv(totals, path, files=1)
    return read_csv(t.spark, path, totals.schema)


@catalog.query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 35")
def preview_limit(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(rows, 35, [F.desc("o_totalprice"), F.asc("o_orderkey")])


_DOCUMENTS_SQL = """WITH lines AS (
           SELECT l_orderkey, MIN(l_suppkey) OVER (PARTITION BY l_orderkey) AS till, l_partkey, l_quantity, l_extendedprice, l_tax,
                  strftime(l_shipdate, '%Y-%m-%d') AS day
           FROM lineitem)
       SELECT l_orderkey AS document, till, 'part ' || l_partkey AS product, l_quantity AS quantity,
              l_extendedprice AS unit_price, day AS sold_on
       FROM lines
       UNION ALL
       SELECT l_orderkey, till, 'tax', 1.0, l_tax, NULL FROM lines"""


def _formatted(pattern: str, *values: Column) -> Column:
    """``format_string`` for %d and %s alone, by joining strings, which takes a fraction of the time."""
    pieces = re.split("%[ds]", pattern)
    shown = [F.coalesce(v.cast("string"), F.lit("null")) for v in values]
    return F.concat(F.lit(pieces[0]), *(c for v, piece in zip(shown, pieces[1:], strict=True) for c in (v, F.lit(piece))))


def _documents(t: Tables, head: str, purchase: str) -> DataFrame:
    """One document for each order: each of its lines is a purchase of two items, the second without a date."""
    shown = _formatted(
        purchase,
        F.col("l_partkey"),
        F.col("l_quantity").cast("string"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.date_format("l_shipdate", "yyyy/MM/dd"),
        F.col("l_tax").cast("string"),
    )
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.struct("l_linenumber", shown.alias("text")).alias("line"))
    orders = lines.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("till"), F.sort_array(F.collect_list("line")).alias("lines"))
    text = F.concat(_formatted(head, F.col("till")), F.array_join("lines.text", ""))
    return orders.select(F.col("l_orderkey").alias("document"), text.alias("text"))


def _flat(documents: DataFrame) -> DataFrame:
    return valid_lines(flatten_till_documents(documents)).withColumn("sold_on", F.date_format("sold_on", "yyyy-MM-dd"))


@catalog.query(_DOCUMENTS_SQL)
def flatten_nested_docs(t: Tables) -> DataFrame:
    purchase = (
        "  - compra:\n"
        "    - producto:\n"
        "        nombre: part %d\n"
        "        cantidad: %s\n"
        "        precio_unitario: %s\n"
        "        fecha: %s\n"
        "    - producto:\n"
        "        nombre: tax\n"
        "        cantidad: 1\n"
        "        precio_unitario: %s\n"
    )
    return _flat(_documents(t, "numero_caja: %d\ncompras:\n", purchase))


@catalog.query(_DOCUMENTS_SQL)
def flatten_dashed_docs(t: Tables) -> DataFrame:
    purchase = (
        "  - '- compra':\n"
        "    - '- nombre': part %d\n"
        "      cantidad: %s\n"
        "      precio_unitario: %s\n"
        "      fecha: %s\n"
        "    - '- nombre': tax\n"
        "      cantidad: 1\n"
        "      precio_unitario: %s\n"
    )
    return _flat(_documents(t, "- '- numero_caja': %d\n- '- compras':\n", purchase))


@catalog.query(_DOCUMENTS_SQL)
def flatten_docs_in_sql(t: Tables) -> DataFrame:
    """The items of documents by a table function in SQL text."""
    register_till_lines(t.spark)
    head, purchase = "numero_caja: %d\ncompras:\n", (
        "- compra:\n"
        "  - producto: {nombre: part %d, cantidad: %s, precio_unitario: %s, fecha: %s}\n"
        "  - producto: {nombre: tax, cantidad: 1, precio_unitario: %s}\n"
    )
    found = t.spark.sql("SELECT d.document, l.* FROM {documents} d, LATERAL till_lines(d.text) l", documents=_documents(t, head, purchase))
    return valid_lines(found).withColumn("sold_on", F.date_format("sold_on", "yyyy-MM-dd"))


_LINES_OF_CSV = """SELECT o_orderkey,
              CASE o_orderkey % 10 WHEN 1 THEN o_orderkey || ',' || o_custkey
                                   WHEN 2 THEN o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',1.5,more'
                                   WHEN 3 THEN o_orderkey || ',many,' || o_orderstatus || ',1.5'
                                   WHEN 4 THEN o_orderkey || ',many,' || o_orderstatus || ',1,5'
                                   WHEN 5 THEN o_orderkey || ',,,'
                                   ELSE o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',1.5' END AS line
       FROM orders"""


def _written_lines(t: Tables) -> DataFrame:
    """Orders as CSV lines, four of ten of them wrong, marked as they are read back."""
    path = scratch_path(t.spark, "lines-csv")
    lines = t.spark.sql(_LINES_OF_CSV.replace("FROM orders", "FROM {orders}"), orders=t.orders)
    lines.select("line").write.text(path)
    return read_csv_marked(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, price double", header=False)


@catalog.query(
    f"""SELECT line, CASE o_orderkey % 10 WHEN 3 THEN 'o_custkey' WHEN 4 THEN 'fields,o_custkey' ELSE 'fields' END AS problems
        FROM ({_LINES_OF_CSV}) WHERE o_orderkey % 10 BETWEEN 1 AND 4"""
)
def csv_rejects(t: Tables) -> DataFrame:
    _, wrong = split_csv(_written_lines(t))
    return wrong.select("line", F.array_join("problems", ",").alias("problems"))


@catalog.query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 5 THEN o_custkey END AS o_custkey,
              CASE WHEN o_orderkey % 10 <> 5 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 10 <> 5 THEN 1.5::DOUBLE END AS price
       FROM orders WHERE o_orderkey % 10 NOT BETWEEN 1 AND 4"""
)
def csv_accepted(t: Tables) -> DataFrame:
    good, _ = split_csv(_written_lines(t))
    return good


# Documents that are wrong in different ways, by customer, and what each is rejected for.
_WRONG = [
    ("numero_caja: 1\ncompras: 5\n", "purchases that are no list"),
    ("numero_caja: 1\ncompras:\n- compra: 7\n", "purchase that is no list of items"),
    ("numero_caja: 1\ncompras: []\n", "document without purchases"),
    ("numero_caja: 1\ncompras: {a: 1}\n", "purchases that are no list"),
    ("compras:\n- compra: []\n", "document without till or purchases"),
    ("numero_caja: [\n", "unreadable document"),
    ("numero_caja: .inf\ncompras:\n- compra:\n  - {nombre: a, cantidad: 1, precio_unitario: 2}\n", "item with an unreadable number"),
    ("numero_caja: 3.7\ncompras:\n- compra:\n  - {nombre: a, cantidad: 1, precio_unitario: 2}\n", "item with an unreadable number"),
    ("numero_caja: 4\ncompras:\n- compra:\n  - {nombre: a, precio_unitario: 2}\n", "item without name, quantity or price"),
    ("numero_caja: 4\ncompras:\n- compra:\n  - {nombre: a, cantidad: many, precio_unitario: 2}\n", "item with an unreadable number"),
]


@catalog.query(
    "SELECT c_custkey AS document, CASE c_custkey % 11 "
    + " ".join(f"WHEN {k} THEN '{problem}'" for k, (_, problem) in enumerate(_WRONG))
    + " END AS problem FROM customer WHERE c_custkey % 11 < 10"
)
def document_rejects(t: Tables) -> DataFrame:
    """Every wrong document gives one row that names the problem; right ones, every eleventh, give none."""
    right = "numero_caja: 4\ncompras:\n- compra:\n  - {nombre: a, cantidad: 1, precio_unitario: 2}\n"
    texts = F.array(*[F.lit(text) for text, _ in _WRONG], F.lit(right))
    documents = t.customer.select(F.col("c_custkey").alias("document"), F.element_at(texts, (F.col("c_custkey") % 11 + 1).cast("int")).alias("text"))
    return rejected_lines(flatten_till_documents(documents)).select("document", "problem")


@catalog.query("SELECT CAST(event_id AS VARCHAR) AS key, props AS value FROM events")
def stream_text_projection(t: Tables) -> DataFrame:
    messages = folder_messages(t.spark, t.stream_path("events"), t.events.schema, "event_id", "props")
    path, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "messages-progress")
    to_parquet(as_text(messages), path, checkpoint, once=True).awaitTermination()
    return t.spark.read.schema("key string, value string").parquet(path)


@catalog.query(
    f"""WITH old AS (
            SELECT 'income_' || o_orderstatus AS metric, strftime(o_orderdate, '%Y-%m-%d') AS day,
                   {money("o_totalprice")} AS value
            FROM orders GROUP BY 1, 2),
        new AS (
            SELECT 'income_' || l_linestatus AS metric, strftime(l_shipdate, '%Y-%m-%d') AS day,
                   {money("l_extendedprice")} AS value
            FROM lineitem GROUP BY 1, 2)
        SELECT metric, day, value FROM new
        UNION ALL
        SELECT metric, day, value FROM old
        WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.metric = old.metric AND new.day = old.day)"""
)
def upsert_merge(t: Tables) -> DataFrame:
    def daily(df: DataFrame, status: str, at: str, amount: str) -> DataFrame:
        metric = F.concat(F.lit("income_"), status).alias("metric")
        return df.groupBy(metric, F.date_format(at, "yyyy-MM-dd").alias("day")).agg(total(amount, 2).alias("value"))

    stored = daily(t.orders, "o_orderstatus", "o_orderdate", "o_totalprice")
    changes = daily(t.lineitem, "l_linestatus", "l_shipdate", "l_extendedprice")
    return upsert(stored, changes, ["metric", "day"])


@catalog.query(
    f"""WITH old AS (
            SELECT 'income_' || o_orderstatus AS metric, strftime(o_orderdate, '%Y-%m') AS month, {money("o_totalprice")} AS value
            FROM orders GROUP BY 1, 2),
        new AS (
            SELECT 'income_' || l_linestatus AS metric, strftime(l_shipdate, '%Y-%m') AS month, {money("l_extendedprice")} AS value
            FROM lineitem WHERE year(l_shipdate) = 1995 GROUP BY 1, 2)
        SELECT metric, month, value FROM new
        UNION ALL
        SELECT metric, month, value FROM old
        WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.metric = old.metric AND new.month = old.month)"""
)
def upsert_touched_months(t: Tables) -> DataFrame:
    """Figures of one year put into a table kept by month; the other months are not rewritten."""

    def monthly(df: DataFrame, status: str, at: str, amount: str) -> DataFrame:
        metric = F.concat(F.lit("income_"), status).alias("metric")
        return df.groupBy(metric, F.date_format(at, "yyyy-MM").alias("month")).agg(total(amount, 2).alias("value"))

    table = PartitionedTable(t.spark, scratch_path(t.spark, "monthly-metrics"), "metric string, value double, month string", by="month")
    table.change(monthly(t.orders, "o_orderstatus", "o_orderdate", "o_totalprice"), keyed(["metric", "month"]))
    changes = monthly(t.lineitem.filter(F.year("l_shipdate") == 1995), "l_linestatus", "l_shipdate", "l_extendedprice")
    table.change(changes, keyed(["metric", "month"]))
    return table.rows().select("metric", "month", "value")


@catalog.query(
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, COUNT(*) AS n, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents
       FROM events GROUP BY 1, 2"""
)
def stream_upsert_totals(t: Tables) -> DataFrame:
    """Totals by day and kind kept by a stream that is stopped and started again while events arrive."""
    source, progress = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "totals-progress")
    table = PartitionedTable(t.spark, scratch_path(t.spark, "day-totals"), "event_type string, n long, cents long, day string")

    def totals(batch: DataFrame) -> DataFrame:
        cents = F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")
        return batch.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), cents)

    for half in (0, 1):
        t.events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        arriving = t.spark.readStream.schema(t.events.schema).parquet(source)
        into_table(arriving, table, totals, added(["event_type", "day"], ["n", "cents"]), progress, once=True).awaitTermination()
    return table.rows().select("day", "event_type", "n", "cents")
