"""Till documents: nested YAML, one document per file or per row, flattened to one row per item."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import yaml
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parser travels to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The field names of the two document layouts. The older layout is a list whose
# keys carry a leading dash as part of the name; the newer one is a mapping.
TILL = "numero_caja"
PURCHASES = "compras"
PURCHASE = "compra"
PRODUCT = "producto"
NAME = "nombre"
QUANTITY = "cantidad"
UNIT_PRICE = "precio_unitario"
DATE = "fecha"
DATE_FORMATS = ("yyyy/MM/dd", "yyyy-MM-dd")

_ITEM = [
    ("till", pa.int64()),
    ("product", pa.string()),
    ("quantity", pa.float64()),
    ("unit_price", pa.float64()),
    ("sold_on", pa.string()),
    ("problem", pa.string()),
]
_SPARK_TYPES = {pa.int64(): T.LongType(), pa.float64(): T.DoubleType(), pa.string(): T.StringType()}


def _get(mapping: dict, name: str):
    """A field under its plain or its dashed name."""
    return mapping[name] if name in mapping else mapping.get("- " + name)


def _has(mapping: dict, name: str) -> bool:
    return name in mapping or "- " + name in mapping


def _rejected(problem: str) -> list[tuple]:
    return [(None, None, None, None, None, problem)]


def _items(text: str | None) -> list[tuple]:
    """The items of one document, or one row that names what is wrong; never nothing."""
    for whole, item in _WRITTEN if text else ():
        found = whole.match(text)
        if found:
            till = int(found[1])
            return [(till, name, float(quantity), float(price), sold_on or None, None) for name, quantity, price, sold_on in item.findall(text, found.end(1))]
    try:
        document = yaml.load(text or "", Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    except (yaml.YAMLError, ValueError, RecursionError):  # ValueError: a date that does not exist
        return _rejected("unreadable document")
    if isinstance(document, list):  # of several tills or lists of purchases the first counts
        merged: dict = {}
        for part in document:
            for key, value in part.items() if isinstance(part, dict) else ():
                merged.setdefault(key, value)
        document = merged
    if not isinstance(document, dict) or not _has(document, TILL) or not _has(document, PURCHASES):
        return _rejected("document without till or purchases")
    purchases = _get(document, PURCHASES)
    if not isinstance(purchases, list):
        return _rejected("document without purchases" if purchases is None else "purchases that are no list")
    till, found = _get(document, TILL), []
    for purchase in purchases:
        entries = _get(purchase, PURCHASE) if isinstance(purchase, dict) else None
        if not isinstance(entries, list):
            found.extend(_rejected("purchase that is no list of items"))
            continue
        found.extend(_line(till, entry.get(PRODUCT, entry) if isinstance(entry, dict) else None) for entry in entries)
    return found or _rejected("document without purchases")


def _number(value, kind: type):
    """A number of the kind; None stays None, and what is not exactly of the kind raises."""
    if value is None:
        return None
    number = float(value)
    if kind is float:
        return number
    if isinstance(value, bool) or number != int(number) or abs(int(value)) >= 1 << 63:
        raise ValueError(value)
    return int(value)


def _line(till, line) -> tuple:
    fields = line if isinstance(line, dict) else {}
    name, sold_on = _get(fields, NAME), fields.get(DATE)
    try:
        quantity, price = _number(fields.get(QUANTITY), float), _number(fields.get(UNIT_PRICE), float)
        number = _number(till, int)
        whole = _has(fields, NAME) and QUANTITY in fields and UNIT_PRICE in fields
        problem = None if whole else "item without name, quantity or price"
    except (TypeError, ValueError, OverflowError):
        quantity, price, number, problem = None, None, None, "item with an unreadable number"
    return number, _text(name), quantity, price, _text(sold_on), problem


def _text(value) -> str | None:
    return None if value is None else str(value)


def read_document_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file (``file``, ``text``); paths may be globs, so many files are one scan."""
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


# The two block layouts as they are usually written: plain names, numbers and dates that mean themselves in YAML, one
# field a line. Anything else goes through the YAML parser.
_NAME_TEXT = r"((?!(?i:true|false|yes|no|on|off|null)\n)[A-Za-z](?:[A-Za-z0-9 ]*[A-Za-z0-9])?)"
_NUMBER_TEXT = r"(-?(?:0|[1-9][0-9]{0,14})(?:\.[0-9]{1,6})?)"
_DATE_TEXT = r"([0-9]{4}/[0-9]{2}/[0-9]{2}|[12][0-9]{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8]))"
_TILL_TEXT = r"(0|[1-9][0-9]{0,17})"


def _item_text(indent: str) -> str:
    fields = f"\n{indent}{QUANTITY}: {_NUMBER_TEXT}\n{indent}{UNIT_PRICE}: {_NUMBER_TEXT}(?:\n{indent}{DATE}: {_DATE_TEXT})?"
    return rf"\A{_NAME_TEXT}{fields}\n?\z"


@dataclass(frozen=True)
class _Layout:
    head: str
    purchase: str
    item: str
    indent: str

    @property
    def between(self) -> str:
        """What stands before the name of an item; a purchase begins with its first item."""
        return f"(?:{self.purchase})?{self.item}"

    def is_regular(self, text: str, parts: str) -> Column:
        start = F.col(text).rlike(rf"\A{self.head}{self.purchase}{self.item}")
        items = F.forall(F.slice(parts, 2, F.size(parts)), lambda part: part.rlike(_item_text(self.indent)))
        return start & F.element_at(parts, 1).rlike(rf"\A{self.head}\z") & items


_MAPPED = _Layout(
    f"{TILL}: {_TILL_TEXT}\n{PURCHASES}:", f"\n  - {PURCHASE}:", f"\n    - {PRODUCT}:\n        {NAME}: ", " " * 8
)
_DASHED = _Layout(
    f"- '- {TILL}': {_TILL_TEXT}\n- '- {PURCHASES}':", f"\n  - '- {PURCHASE}':", f"\n    - '- {NAME}': ", " " * 6
)


def _written(head: str, purchase: str, item: str) -> tuple[re.Pattern, re.Pattern]:
    """For the parser: a whole document of these parts, and one item in it with its name, quantity, price and date."""
    parts = re.sub(r"\((?!\?)", "(?:", item)
    return re.compile(rf"{head}(?:{purchase}(?:{parts})+)+\n?\Z"), re.compile(item)


def _block(layout: _Layout) -> tuple[re.Pattern, re.Pattern]:
    fields = rf"\n{layout.indent}{QUANTITY}: {_NUMBER_TEXT}\n{layout.indent}{UNIT_PRICE}: {_NUMBER_TEXT}(?:\n{layout.indent}{DATE}: {_DATE_TEXT})?(?=\n|\Z)"
    return _written(layout.head, layout.purchase, f"{layout.item}{_NAME_TEXT}{fields}")


# Documents in these layouts mean the same to the YAML parser, which takes some fifty times as long for them.
_WRITTEN = (
    _block(_MAPPED),
    _block(_DASHED),
    _written(
        _MAPPED.head,
        f"\n- {PURCHASE}:",
        rf"\n  - {PRODUCT}: {{{NAME}: {_NAME_TEXT.replace(chr(92) + 'n', ',')}, {QUANTITY}: {_NUMBER_TEXT}, {UNIT_PRICE}: {_NUMBER_TEXT}(?:, {DATE}: {_DATE_TEXT})?}}",
    ),
)


def flatten_till_documents(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per item with the till repeated; ``problem`` names what is wrong, else null.

    Columns of ``documents`` other than the text stay in front. Documents written in one of the two regular
    block layouts are split and read by built-in functions. All others are parsed as YAML in Arrow
    batches. Every document gives its items or a row with a problem. ``documents`` is computed once.
    """
    carried = [c for c in documents.columns if c != text]
    whole = documents.select(F.struct(*carried).alias("_carried") if carried else F.lit(1).alias("_carried"), F.col(text).alias("_text"))
    dashed = F.col("_text").startswith("-")
    parts = F.when(dashed, F.split("_text", _DASHED.between)).otherwise(F.split("_text", _MAPPED.between))
    told = whole.withColumn("_parts", parts)
    regular = F.when(dashed, _DASHED.is_regular("_text", "_parts")).otherwise(_MAPPED.is_regular("_text", "_parts"))
    told = told.withColumn("_regular", F.coalesce(regular, F.lit(False)))

    till = F.regexp_extract(F.element_at("_parts", 1), rf"{TILL}'?: ([0-9]+)", 1)
    others = F.when(~F.col("_regular"), F.struct(F.col("_text").alias("text")))
    told = told.select("_carried", "_regular", F.when(F.col("_regular"), till.cast("long")).alias("_till"), "_parts", _parsed(others).alias("_parsed"))
    # Of a document that is not regular the numbers of its items are exploded.
    items = F.when(F.col("_regular"), F.slice("_parts", 2, F.size("_parts"))).otherwise(F.transform("_parsed", lambda p: F.lit("")))
    each = told.select("_carried", "_regular", "_till", "_parsed", F.posexplode(items).alias("_at", "_part"))
    # A regular item is one field a line, and no field has a colon in it.
    cut = each.select("_carried", "_regular", "_till", F.get("_parsed", F.col("_at")).alias("_item"), F.split("_part", "\n").alias("_lines"))
    quantity, unit_price, sold_on = (F.substring_index(F.get("_lines", F.lit(k)), ": ", -1) for k in (1, 2, 3))
    read = {
        "till": F.col("_till"),
        "product": F.get("_lines", F.lit(0)),
        "quantity": quantity.cast("double"),
        "unit_price": unit_price.cast("double"),
        "sold_on": F.nullif(sold_on, F.lit("")),
        "problem": F.lit(None).cast("string"),
    }
    front = [F.col("_carried").getField(c).alias(c) for c in carried]
    return cut.select(*front, *(F.when(F.col("_regular"), c).otherwise(F.col("_item").getField(name)).alias(name) for name, c in read.items()))


class TillLines:
    """Table function: the items of one document as rows ``till, product, quantity, unit_price, sold_on, problem``."""

    def eval(self, text: str) -> Iterator[tuple]:
        yield from _items(text)


def register_till_lines(spark: SparkSession, name: str = "till_lines") -> None:
    """Make the items of documents callable from SQL: ``SELECT d.file, l.* FROM docs d, LATERAL till_lines(d.text) l``.

    Rows travel pickled, as an Arrow batch would be made for each document; every document gives its items or a row with a problem, as
    ``flatten_till_documents`` does; documents that are in no regular layout go through the YAML parser.
    """
    kinds = T.StructType([T.StructField(n, _SPARK_TYPES[k]) for n, k in _ITEM])
    spark.udtf.register(name, F.udtf(TillLines, returnType=kinds, useArrow=False))


def _parsed(document: Column) -> Column:
    """The same items by the YAML parser, as an array for each document ``struct<text>``; null for a null."""

    def parse(documents: pa.Array) -> pa.Array:
        given = documents.is_valid().to_pylist()
        if not any(given):
            return pa.nulls(len(given), kind)
        texts = documents.field("text").to_pylist()
        return pa.array([[dict(zip(names, item)) for item in _items(text)] if there else None for there, text in zip(given, texts)], kind)

    names = [n for n, _ in _ITEM]
    kind = pa.list_(pa.struct(_ITEM))
    spark_kind = T.ArrayType(T.StructType([T.StructField(n, _SPARK_TYPES[k]) for n, k in _ITEM]))
    return F.arrow_udf(parse, spark_kind)(document)


def valid_lines(flattened: DataFrame) -> DataFrame:
    return (
        flattened.filter(F.col("problem").isNull())
        .drop("problem")
        .withColumn("sold_on", F.coalesce(*[F.try_to_date("sold_on", f) for f in DATE_FORMATS]))
    )


def rejected_lines(flattened: DataFrame) -> DataFrame:
    return flattened.filter(F.col("problem").isNotNull())


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early when there is nothing to work on."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df
