"""Near-equal lines by a segment-partition edit join."""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import mapped, mixed
from tallyforge.llm.bits import sketch_of
from tallyforge.llm.graph import components
from tallyforge.operators.skew import join_measured
from tallyforge.session import stage_table

#: Bytes of text at a time: hashes of its prefixes and the keys of its lines take forty times as much and more in every
#: worker, which keeps it; shorter slices than this take longer.
_SLICE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def allowed_edits(length: int, most: int, chars_per_edit: int) -> int:
    """Edits within which a line of this length, the shorter of two, is the same line."""
    return min(most, length // chars_per_edit)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of ``edits + 1`` parts that differ by one character at most, longer ones last."""
    base, longer = divmod(length, edits + 1)
    sizes = [base + (k > edits - longer) for k in range(edits + 1)]
    return [(sum(sizes[:k]), size) for k, size in enumerate(sizes)]


def window(of: int, length: int, k: int, edits: int) -> range:
    """Where the ``k``-th segment of a line of length ``of`` can start in one of ``length`` within the edits.

    The edits before the segment and those after it must both be able to explain its shift.
    """
    start, size = segments(of, edits)[k]
    gap = length - of
    return range(max(start - k, start + gap - (edits - k), 0), min(start + k, start + gap + (edits - k), length - size) + 1)


def first_segment(a: str, b: str, edits: int) -> int | None:
    """The first segment of ``a``, the shorter line, that ``b`` has where the edits allow it."""
    for k, (start, size) in enumerate(segments(len(a), edits)):
        part = a[start : start + size]
        if any(b.startswith(part, at) for at in window(len(a), len(b), k, edits)):
            return k
    return None


def banded_distance(a: str, b: str, limit: int) -> int:
    """Edit distance of two strings, or ``limit + 1`` if it is larger.

    Bit-parallel over the band of ``2 * limit + 1`` diagonals: bit p of column j stands for row j - limit + p.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return limit + 1
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    whole = (1 << (2 * limit + 1)) - 1
    plus, minus, score = whole ^ ((1 << limit) - 1), 0, min(limit, len(a))
    for j, c in enumerate(b, 1):
        low = j - limit
        match = where.get(c, 0)
        match = (match >> (low - 1) if low >= 1 else match << (1 - low)) & whole
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & whole
        up = minus | ~(zero | plus) & whole
        down = zero & plus
        if j + limit <= len(a):
            score += not zero >> 2 * limit & 1
        else:
            row = len(a) - low
            score += (up >> row & 1) - (down >> row & 1)
        plus = down | ~(zero >> 1 | up) & whole
        minus = zero >> 1 & up
    return min(score, limit + 1)


def line_number(line: str) -> int:
    """64 bits of a digest: what stands for a line between the tasks."""
    return int.from_bytes(blake2b(line.encode("utf-8"), digest_size=8).digest(), "little", signed=True)


def _shown_lines(text: str | None) -> list[tuple[int, str]]:
    """Number in the text and trimmed content of the lines that have any."""
    return [(k, line) for k, line in enumerate(map(str.strip, (text or "").split("\n"))) if line]


def _distinct_lines(piece: pa.RecordBatch) -> list[str]:
    return list(dict.fromkeys(line for t in piece.column("text").to_pylist() for _, line in _shown_lines(t)))


_KEYS = pa.schema([("key", pa.int64()), ("seg", pa.int8()), ("line", pa.int64())])
_KEYS_DDL = "key long, seg byte, line long"


def _keys(lines: list[str], most: int, chars_per_edit: int, index: bool) -> dict[str, np.ndarray]:
    """Keys of the segments of lines (``index``) or of the substrings that they look up, all lines at once.

    A line within ``t`` edits of a shorter or equally long one has one of its ``t + 1`` segments in ``window``; only
    these places are looked up, and not a line's own segment at its own place.
    """
    lines = [line for line in lines if len(line) >= chars_per_edit]
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    made: dict[str, list] = {f.name: [np.zeros(0, np.int64)] for f in _KEYS}
    if len(codes):
        sizes = np.array([len(line) for line in lines])
        first = np.cumsum(sizes) - sizes
        # A prefix sum of powers: the hash of any substring is a difference and one product away.
        power = np.cumprod(np.full(len(codes) + 1, _BASE)) * _INVERSE
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes) * power[:-1])])
        down = np.cumprod(np.full(len(codes) + 1, _INVERSE)) * _BASE
        numbers = np.array([line_number(line) for line in lines], np.int64)

        def put(own, of, k, at, size):
            low = first[own] + at
            part = (prefix[low + size] - prefix[low]) * down[low]
            for name, value in zip(made, (mixed(part + (of * 64 + k).astype(np.uint64)).view(np.int64), np.full(len(own), k), numbers[own])):
                made[name].append(value)

        for gap in range(1 if index else most + 1):
            for edits in range(max(1, gap), most + 1):
                own = np.flatnonzero(np.minimum(most, (sizes - gap) // chars_per_edit) == edits)
                of = sizes[own] - gap
                base, longer = np.divmod(of, edits + 1)
                for k in range(edits + 1):
                    size, start = base + (k > edits - longer), k * base + np.maximum(0, k - (edits + 1 - longer))
                    if index:
                        put(own, of, k, start, size)
                        continue
                    low = np.maximum(np.maximum(start - k, start + gap - (edits - k)), 0)
                    high = np.minimum(np.minimum(start + k, start + gap + (edits - k)), sizes[own] - size)
                    for shift in range(2 * edits + 1):
                        fits = (low + shift <= high) & ((gap > 0) | (low + shift != start))
                        put(own[fits], of[fits], k, (low + shift)[fits], size[fits])
    return {name: np.concatenate(value) for name, value in made.items()}


def near_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 2, chars_per_edit: int = 20) -> DataFrame:
    """One row for each line with content: ``key, line_no int, n_links long, class_key, class_line_no, kept``.

    Lines are trimmed; two lines are linked when at most ``min(most, shorter length // chars_per_edit)`` edits
    part them, so lines below ``chars_per_edit`` are only compared for equality. ``n_links`` is the number
    of different lines that a line is linked with, each counted once however often it occurs. Links join
    lines to classes; the first occurrence of a class (smallest key, then line) is ``class_key,
    class_line_no`` and the only one ``kept``.

    Each distinct line of a slice leaves the keys of its segments. A sketch of these tells which of the substrings that
    lines look up can be a segment of another line; only those leave keys, and only segments that are looked up or that
    several lines have stay. Lines with a key in common are compared in blocks of ``BLOCK`` by ``BLOCK``, texts being
    fetched for these lines alone. A pair is compared where the first segment that they share is the key, so once; what leaves a
    block is a count for each line and one link that joins it to the others, never the pairs. A line stands for all its copies.

    Null and empty texts have no lines; null keys come last; rows that repeat key and text are one occurrence
    and judged alike. Other columns are not read.
    """
    return _judged_lines(docs, key, text, most, chars_per_edit).drop("row")


def _row(key: str, text: str):
    """Tells rows apart that differ in key or text; nulls as well."""
    return F.xxhash64(F.col(key).cast("long"), F.col(text))


def _judged_lines(docs: DataFrame, key: str, text: str, most: int, chars_per_edit: int) -> DataFrame:
    """``near_lines`` with the column ``row`` of ``_row``."""
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), _row(key, text).alias("row"))
    schema = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("line_no", pa.int32()), ("line", pa.int64())])

    def occurrences(piece: pa.RecordBatch) -> dict:
        made: dict[str, list] = {f.name: [] for f in schema}
        for r, k, t in zip(*(piece.column(c).to_pylist() for c in ("row", "key", "text"))):
            for number, line in _shown_lines(t):
                for name, value in zip(made, (r, k, number, line_number(line))):
                    made[name].append(value)
        return made

    ddl = "row long, key long, line_no int, line long"
    seen = stage_table(rows.mapInArrow(mapped(occurrences, "text", schema, _SLICE), ddl), "lines")
    linked = stage_table(links(rows, most, chars_per_edit), "line-links")
    joined = components(linked.select(F.col("line").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("line"), F.col("component").alias("class"))
    degrees = linked.groupBy("line").agg(F.sum("n").alias("n_links"))
    known = stage_table(joined.join(degrees, "line"), "linked-lines")
    placed = stage_table(join_measured(seen, known, "line", "left").withColumn("class", F.coalesce("class", "line")), "placed-lines")
    place = F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("class_key"), F.col("line_no").alias("class_line_no"), F.col("row").alias("class_row"))
    firsts = placed.groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = join_measured(placed, firsts, "class", "left")
    own = (F.col("first.class_row") == F.col("row")) & (F.col("first.class_line_no") == F.col("line_no"))
    return joined.select(
        "row",
        F.col("key").cast(kind).alias(key),
        "line_no",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("first").isNull(), F.col("key")).otherwise(F.col("first.class_key")).cast(kind).alias("class_key"),
        F.coalesce("first.class_line_no", "line_no").alias("class_line_no"),
        (F.col("first").isNull() | own).alias("kept"),
    )


def links(rows: DataFrame, most: int, chars_per_edit: int) -> DataFrame:
    """``line long, n long, root long``: with how many lines compared in a block a line is linked, and the smallest line
    that links of the block join it to. A line has a row for each block with a link of it."""

    def keys_of(index: bool, wanted=None) -> DataFrame:
        def work(piece: pa.RecordBatch) -> dict:
            made = _keys(_distinct_lines(piece), most, chars_per_edit, index)
            if wanted is None:
                return made
            kept = wanted.value.has(made["key"].view(np.uint64))
            return {name: value[kept] for name, value in made.items()}

        return rows.select("text").mapInArrow(mapped(work, "text", _KEYS, _SLICE), _KEYS_DDL)

    share = rows.sparkSession.sparkContext.broadcast
    index = stage_table(keys_of(True), "segments")
    several = index.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low <> high")
    several = stage_table(several.select("key"), "segments-of-several")
    looked_up = stage_table(keys_of(False, share(sketch_of(index, "key"))), "looked-up")
    filters = share((sketch_of(several, "key"), sketch_of(looked_up, "key")))

    def met(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(filters.value[0].has(keys) | filters.value[1].has(keys)))

    both = index.mapInArrow(met, _KEYS_DDL).withColumn("probe", F.lit(False)).unionByName(looked_up.withColumn("probe", F.lit(True)))
    members = both.groupBy("key", "line").agg(F.min(F.struct("probe", "seg")).alias("found")).select("key", "line", "found.*")
    members = stage_table(members, "members")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min("probe").alias("lone")).filter("n > 1 AND NOT lone").drop("lone")
    members = stage_table(join_measured(members, sizes, "key"), "met-members")

    text_schema = pa.schema([("line", pa.int64()), ("text", pa.string())])

    wanted = share(sketch_of(members, "line"))

    def texts(piece: pa.RecordBatch) -> dict:
        found = [line for line in _distinct_lines(piece) if len(line) >= chars_per_edit]
        numbers = np.array([line_number(line) for line in found], np.int64)
        kept = np.flatnonzero(wanted.value.has(numbers.view(np.uint64)))
        return {"line": numbers[kept], "text": [found[k] for k in kept.tolist()]}

    lines = rows.select("text").mapInArrow(mapped(texts, "text", text_schema, _SLICE), "line long, text string")
    lines = lines.join(members.select("line").distinct(), "line", "left_semi").groupBy("line").agg(F.first("text").alias("text"))
    # A row of block i goes to the meetings of i with every block, the smaller number first.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int"))
    own = own.join(lines, "line").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = own.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "probe", "seg", "line", "text")
    dealt = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def compared(batches):
        held: list[tuple] = []
        place = None
        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("key", "x", "y", "block", "probe", "seg", "line", "text")]
            for key, x, y, *row in zip(*columns):
                if (key, x, y) != place:
                    made += _linked(held, most, chars_per_edit)
                    held, place = [], (key, x, y)
                held.append(row)
            yield _rows(made)
        yield _rows(_linked(held, most, chars_per_edit))

    return dealt.mapInArrow(compared, "line long, n long, root long")


#: Lines with one key meet in blocks of about this many.
BLOCK = 256


def _rows(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in made], pa.int64()) for k in range(3)], names=["line", "n", "root"])


def _linked(rows: list[tuple], most: int, chars_per_edit: int) -> list[tuple[int, int, int]]:
    """Counts and roots of the lines of two blocks, or of one, from ``block, probe, seg, line, text`` rows."""
    if len(rows) < 2:
        return []
    block, probe, seg, number, text = zip(*rows)
    sizes, place = np.array([len(t) for t in text]), np.array(block)
    # An edit changes the parity of two letters at most.
    odd = np.array([_odd_letters(t) for t in text], np.uint64)
    near = (np.bitwise_count(odd[:, None] ^ odd) <= 2 * most) & (np.abs(sizes[:, None] - sizes) <= most)
    if place.min() < place.max():
        near &= place[:, None] != place
    degree, root = [0] * len(rows), list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for p, q in zip(*(found.tolist() for found in np.nonzero(np.triu(near, 1)))):
        # The shorter line gives the segments, of equally long ones that with the smaller number.
        a, b = (p, q) if (sizes[p], number[p]) < (sizes[q], number[q]) else (q, p)
        limit = allowed_edits(len(text[a]), most, chars_per_edit)
        if probe[a] or abs(sizes[p] - sizes[q]) > limit or first_segment(text[a], text[b], limit) != seg[a]:
            continue
        if banded_distance(text[a], text[b], limit) <= limit:
            degree[a] += 1
            degree[b] += 1
            one, other = find(a), find(b)
            root[max(one, other, key=number.__getitem__)] = min(one, other, key=number.__getitem__)
    return [(number[k], degree[k], number[find(k)]) for k in range(len(rows)) if degree[k]]


def _odd_letters(line: str) -> int:
    odd = 0
    for letter, times in Counter(line).items():
        odd ^= (times & 1) << (ord(letter) & 63)
    return odd


def without_later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 2, chars_per_edit: int = 20) -> DataFrame:
    """``docs`` without the lines that ``near_lines`` does not keep; documents left without any line go.

    All columns stay. Documents that lose nothing keep their text as it is, also those without any line.
    """
    found = _judged_lines(docs, key, text, most, chars_per_edit)
    numbers = F.collect_set(F.when(~F.col("kept"), F.col("line_no")))
    lost = found.groupBy(F.col("row").alias("_row")).agg(numbers.alias("_lines"), F.count_distinct("line_no").alias("_count"))
    lost = lost.filter(F.size("_lines") > 0)
    # Dealt out at every size, so that what is moved stays in proportion to the input.
    told = docs.select(F.struct(*docs.columns).alias("_doc"), _row(key, text).alias("_row")).repartition("_row")
    joined = told.join(lost, "_row", "left").filter("_lines IS NULL OR size(_lines) < _count")
    whole = F.col("_doc").getField(text)
    left = F.filter(F.split(whole, "\n", -1), lambda line, k: ~F.array_contains("_lines", k))
    cleaned = F.when(F.col("_lines").isNull(), whole).otherwise(F.array_join(left, "\n"))
    return joined.select(*((cleaned if c == text else F.col("_doc").getField(c)).alias(c) for c in docs.columns))
