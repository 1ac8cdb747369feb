"""Quality rules with lines that too many documents of one host share."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.llm.batches import mapped
from tallyforge.session import stage_table

# Fixed values of the rules: the characters counted as symbols, and white space between words.
SYMBOLS = "#*$%&|<>"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in some window of ``width`` words which the text has twice or more, first ones included."""
    if len(words) < width + 1:
        return 0
    numbers: dict[bytes, int] = {}
    word = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    window = word[: len(word) - width + 1]
    for k in range(1, width):
        # Numbered anew after each word, so a window's number stays below the number of words.
        pair = window * len(words) + word[k : len(word) - width + 1 + k]
        window = np.unique(pair, return_inverse=True)[1].reshape(-1)
    twice = np.bincount(window)[window] > 1
    covered = np.zeros(len(word) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``; a null text has none of anything."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def normalised(line: str) -> bytes:
    """Lower case, single spaces, none at the ends; what makes two lines the same line."""
    return b" ".join(line.lower().encode("utf-8").split())


def line_number(line: bytes) -> int:
    return int.from_bytes(blake2b(line, digest_size=8).digest(), "little", signed=True)


def _lines(text: str | None) -> list[bytes]:
    """The lines with a word, in the form in which they are compared."""
    return [n for n in map(normalised, (text or "").split("\n")) if n]


def frequent_lines(docs: DataFrame, text: str, host: str, least: int, share: float) -> DataFrame:
    """``host, lines array<long>``: lines in more documents of the host than ``max(least, share * documents)``.

    A document counts once for a line, and documents with the same lines in the same order are one, here and in the
    number of documents; so copies do not make a line frequent. A line over the limit is in more than ``share`` of
    the documents, so a host has at most 1 / ``share`` times as many of them as a document has lines on average.
    """
    schema = pa.schema([("host", pa.string()), ("doc", pa.int64()), ("line", pa.int64())])

    def lines(piece: pa.RecordBatch) -> dict:
        made = {f.name: [] for f in schema}
        for h, t in zip(piece.column("host").to_pylist(), piece.column("text").to_pylist()):
            shown = _lines(t)
            own = line_number(b"\n".join(shown))
            for line in {*map(line_number, shown), None}:
                for name, value in zip(made, (h, own, line)):
                    made[name].append(value)
        return made

    rows = docs.select(F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    found = rows.mapInArrow(mapped(lines, "text", schema), "host string, doc long, line long")
    # One row for a document has no line: it counts the documents of the host. Copies of a text count once.
    per_doc = found.groupBy("host", "line", "doc").agg(F.lit(1).alias("one"))
    documents = per_doc.groupBy("host", "line").agg(F.count("*").alias("documents"))
    total = documents.filter("line IS NULL").select(F.col("host").alias("t_host"), F.greatest(F.lit(float(least)), share * F.col("documents")).alias("limit"))
    over = documents.filter(F.col("line").isNotNull() & (F.col("documents") > least))
    over = over.join(total, F.col("host").eqNullSafe(F.col("t_host"))).filter("documents > limit")
    return over.groupBy("host").agg(F.collect_list("line").alias("lines"))


def judged(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    least: int = 20,
    share: float = 0.01,
    depleted_percent: int = 50,
    min_words: int = 50,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The measures of every document, what is left of it, and whether it is kept.

    Columns: ``key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words`` (long),
    ``base_failed, kept`` (boolean), ``cleaned`` (the text without the lines over the limit of its host).
    A document is kept if the base rules pass and at least ``depleted_percent`` of its words are left.

    A null text has no words, fails the base rules and stays null; a null host is a host of its own; null
    and repeated keys are passed on, one row for each row. Columns named in ``carry`` come along in the
    struct ``carried``; others are not read.
    """
    kind = docs.schema[key].dataType
    over = stage_table(frequent_lines(docs, text, host, least, share), "frequent-lines")
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(host).cast("string").alias("host"),
        F.col(text).alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    rows = rows.join(over.withColumnRenamed("host", "o_host"), F.col("host").eqNullSafe(F.col("o_host")), "left").drop("host", "o_host")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words")
    schema = pa.schema([("key", pa.int64()), *((c, pa.int64()) for c in counts), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("cleaned", pa.string())])
    made_schema = StructType.fromDDL(f"key long, {', '.join(f'{c} long' for c in counts)}, base_failed boolean, kept boolean, cleaned string")
    if carry:
        made_schema = made_schema.add("carried", rows.schema["carried"].dataType)
        schema = schema.append(pa.field("carried", pa.null()))  # passed on with its own type

    def judge(piece: pa.RecordBatch) -> dict:
        made: dict[str, list] = {f.name: [] for f in schema if f.name != "carried"}
        for k, lines, t in zip(*(piece.column(c).to_pylist() for c in ("key", "lines", "text"))):
            found = measures(t)
            cleaned, removed = without(t, frozenset(lines)) if lines and t else (t, 0)
            failed = found[0] < min_words or 100 * found[4] > 50 * found[0]
            kept = not failed and 100 * (found[0] - removed) >= depleted_percent * found[0]
            for name, value in zip(made, (k, *found, removed, failed, kept, cleaned)):
                made[name].append(value)
        return made | ({"carried": piece.column("carried")} if carry else {})

    return rows.mapInArrow(mapped(judge, "text", schema), made_schema).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def without(text: str, lines: frozenset[int]) -> tuple[str, int]:
    """The text without the given lines, and how many words went with them."""
    left, removed = [], 0
    for line in text.split("\n"):
        shown = normalised(line)
        if shown and line_number(shown) in lines:
            removed += shown.count(b" ") + 1
        else:
            left.append(line)
    return "\n".join(left), removed
