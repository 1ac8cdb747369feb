"""Byte strings that an earlier document has as well, by sampled positions that equal strings have in common.

The idea of a difference cover: of any two equal strings, some common offset is sampled in both, so the
sampled tuples are sorted and named first, tuples of one document alone drop out, and the remaining suffixes
are compared through the sample next to them. A cover by residues that serves strings of 50 bytes samples a
fifth of all positions; here the sampled offset is the one with the smallest tuple hash in the string, which
the string alone decides, and a sixteenth of the positions is enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import mapped, mixed
from tallyforge.session import stage_table

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of a sampled tuple, of text taken at a time, and of text for each group of tuples or suffixes that a task
#: sorts. Hashes of every position take some sixty times as much memory as the text.
TUPLE = 20
SLICE = 1 << 20
GROUP_BYTES = 2 << 20


class Bytes:
    """Texts of a slice, end to end, with the hash of any stretch at hand."""

    def __init__(self, parts: list[bytes]):
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        codes = mixed(np.arange(1, 257, dtype=np.uint64))[self.data]
        power = np.cumprod(np.full(len(codes) + 1, _BASE))
        self.down = np.cumprod(np.full(len(codes) + 1, _INVERSE))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * power[:-1])])

    def hashes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[stops] - self.prefix[starts]) * self.down[starts] + (stops - starts).astype(np.uint64))

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring strings of ``width`` bytes that share their sampled tuple.

        Text number, first and last start (in the text) and tuple hash of each run; strings that cross
        texts are left out.
        """
        none = np.zeros(0, np.int64)
        count = len(self.data) - TUPLE + 1
        if count < width - TUPLE + 1:
            return none, none, none, none.view(np.uint64)
        place = np.arange(count)
        tuples = self.hashes(place, place + TUPLE)
        least, at, seen = tuples, place.astype(np.int32), 1
        while seen < width - TUPLE + 1:  # doubling; the first of equal ones is taken
            step = min(seen, width - TUPLE + 1 - seen)
            smaller = least[step:] < least[:-step]
            least = np.where(smaller, least[step:], least[:-step])
            at = np.where(smaller, at[step:], at[:-step])
            seen += step
        starts = np.arange(len(at))
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[: len(at)]
        inside = starts + width <= (self.first + self.sizes)[owner]
        starts, at, owner = starts[inside], at[inside], owner[inside]
        if not len(starts):
            return none, none, none, none.view(np.uint64)
        new = np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)])
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(starts)]]) - 1
        of = owner[head]
        return of, starts[head] - self.first[of], starts[tail] - self.first[of], tuples[at[head]]


def _grouped(part: np.ndarray, groups: int, columns: dict[str, np.ndarray], keys: np.ndarray, rows: np.ndarray, of: np.ndarray) -> dict:
    """One output row for each group with the elements of a slice that belong to it."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(groups + 1))
    filled = np.flatnonzero(np.diff(edges))
    made: dict[str, list] = {"part": filled, **{c: [] for c in ("keys", "rows", *columns)}}
    for p in filled.tolist():
        own = order[edges[p] : edges[p + 1]]
        made["keys"].append(keys[of[own]].tobytes())
        made["rows"].append(rows[of[own]].tobytes())
        for c, values in columns.items():
            made[c].append(values[own].tobytes())
    return made


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _smallest(groups: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each element the smallest key of its group."""
    order = np.lexsort((keys, groups))
    new = np.concatenate([[True], np.diff(groups[order].view(np.int64)) != 0])
    found = np.empty(len(keys), np.int64)
    found[order] = keys[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return found


def _shared_tuples(rows: DataFrame, width: int, groups: int) -> DataFrame:
    """``row long, starts array<int>``: runs whose tuple some other document has too."""
    blobs = ("keys", "rows", "names", "starts")
    schema = pa.schema([("part", pa.int64()), *((c, pa.binary()) for c in blobs)])

    def sample(piece: pa.RecordBatch) -> dict:
        texts = Bytes([t.encode("utf-8") for t in piece.column("text").to_pylist()])
        keys, ids = (np.array(piece.column(c).to_pylist(), np.int64) for c in ("key", "row"))
        of, start, _, name = texts.runs(width)
        columns = {"names": (name >> np.uint64(32)).astype("<u4"), "starts": start.astype("<u4")}
        return _grouped((name % np.uint64(groups)).astype(np.int64), groups, columns, keys, ids, of)

    def name_them(table: pa.Table) -> pa.Table:
        keys, ids, names, starts = (_joined(table, c, k) for c, k in zip(blobs, ("<i8", "<i8", "<u4", "<u4")))
        # Sorted by name and key, a name of several documents begins and ends with different keys.
        wide = names.astype(np.uint64)
        several = (_smallest(wide, keys) != keys) | (-_smallest(wide, -keys) != keys)
        return pa.table({"row": ids[several], "start": starts[several].astype(np.int32)})

    ddl = "part long, " + ", ".join(f"{c} binary" for c in blobs)
    named = rows.mapInArrow(mapped(sample, "text", schema, SLICE), ddl).groupBy("part").applyInArrow(name_them, "row long, start int")
    return stage_table(named.groupBy("row").agg(F.collect_set("start").alias("starts")), "shared-tuples")


def _covered(rows: DataFrame, shared: DataFrame, width: int, groups: int) -> DataFrame:
    """``row long, spans array<struct<start int, stop int>>``: bytes that earlier documents have too."""
    blobs = ("keys", "rows", "starts", "sizes", "bytes", "known")
    schema = pa.schema([("part", pa.int64()), *((c, pa.binary()) for c in blobs)])

    def suffixes(piece: pa.RecordBatch) -> dict:
        texts = Bytes([t.encode("utf-8") for t in piece.column("text").to_pylist()])
        keys, ids = (np.array(piece.column(c).to_pylist(), np.int64) for c in ("key", "row"))
        of, start, last, name = texts.runs(width)
        wanted = piece.column("starts").to_pylist()
        asked = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(w, np.int64) + at for w, at in zip(wanted, texts.first.tolist()))]))
        taken = np.isin(start + texts.first[of], asked)
        of, start, last, name = of[taken], start[taken], last[taken], name[taken]
        low, high = start + texts.first[of], last + texts.first[of] + width
        # Equal stretches of a slice: only the smallest document has to ask elsewhere; the others are covered.
        known = _smallest(texts.hashes(low, high), keys[of]) < keys[of] if len(of) else np.zeros(0, bool)
        sizes = np.where(known, 0, high - low)
        index = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text = texts.data[index]
        part = (name % np.uint64(groups)).astype(np.int64)
        columns = {"starts": start.astype("<u4"), "sizes": (high - low).astype("<u4"), "known": known.astype("u1")}
        made = _grouped(part, groups, columns, keys, ids, of)
        byte_part = np.repeat(part, sizes)
        order = np.argsort(byte_part, kind="stable")
        edges = np.searchsorted(byte_part[order], np.arange(groups + 1))
        made["bytes"] = [text[order[edges[p] : edges[p + 1]]].tobytes() for p in made["part"].tolist()]
        return made

    def compare(table: pa.Table) -> pa.Table:
        keys, ids, starts, sizes, data, known = (_joined(table, c, k) for c, k in zip(blobs, ("<i8", "<i8", "<u4", "<u4", "u1", "u1")))
        starts, sizes, known = starts.astype(np.int64), sizes.astype(np.int64), known.astype(bool)
        spans = [(ids[known], starts[known], starts[known] + sizes[known])]
        keys, ids, starts, sizes = keys[~known], ids[~known], starts[~known], sizes[~known]
        texts = Bytes([data.tobytes()])
        first = np.cumsum(sizes) - sizes
        count = sizes - width + 1
        of = np.repeat(np.arange(len(sizes)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = first[of] + inner
        again = _smallest(texts.hashes(at, at + width), keys[of]) < keys[of] if len(at) else np.zeros(0, bool)
        of, inner = of[again], inner[again]
        new = np.concatenate([[True], (np.diff(of) != 0) | (np.diff(inner) != 1)]) if len(of) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(of)]]) - 1 if len(of) else head
        spans.append((ids[of[head]], starts[of[head]] + inner[head], starts[of[head]] + inner[tail] + width))
        row, low, high = (np.concatenate(x) for x in zip(*spans))
        return pa.table({"row": row, "start": low.astype(np.int32), "stop": high.astype(np.int32)})

    ddl = "part long, " + ", ".join(f"{c} binary" for c in blobs)
    with_starts = rows.join(shared, "row")
    found = with_starts.mapInArrow(mapped(suffixes, "text", schema, SLICE), ddl).groupBy("part").applyInArrow(compare, "row long, start int, stop int")
    return stage_table(found.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "covered")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches that the spans cover."""
    found: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], stop))
        else:
            found.append((start, stop))
    return found


def without_earlier_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 50) -> DataFrame:
    """``key, n_bytes long, removed array<struct<start int, stop int>>, kept binary`` for every row.

    Removed are the bytes that lie in a string of ``width`` bytes which starts in a document with a smaller
    key as well; ``kept`` are the others, in order. Strings do not cross documents and are judged on the input.

    First the sampled tuples of all texts are sorted and named in groups by hash, and those of one
    document alone drop out. Then the stretches of text whose strings have the tuples left over meet in
    groups by tuple, all their strings are sorted, and neighbours that are equal tell which bytes an earlier
    document has. Stretches that a slice has twice are settled there, so a passage in very many
    documents reaches a group once for each slice. Strings are compared by 64-bit hashes.

    A null text is empty. Rows with a null key neither remove nor lose anything; rows that repeat a key
    are judged alike and do not remove each other. Other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("key", "text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = 1 + total // GROUP_BYTES
    searched = rows.filter(F.col("key").isNotNull() & (F.octet_length("text") >= width))
    shared = _shared_tuples(searched, width, groups)
    # Dealt out by row at every size, so that what is moved stays in proportion to the input.
    dealt = searched.repartition("row")
    covered = _covered(dealt, shared, width, groups)
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.binary())])

    def cut(piece: pa.RecordBatch) -> dict:
        sizes, removed, kept = [], [], []
        for t, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist()):
            data = t.encode("utf-8")
            own = merged([(s["start"], s["stop"]) for s in spans or ()])
            sizes.append(len(data))
            removed.append([{"start": a, "stop": b} for a, b in own])
            edges = [0, *(x for span in own for x in span), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return {"key": piece.column("key"), "n_bytes": sizes, "removed": removed, "kept": kept}

    ddl = "key long, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary"
    told = rows.repartition("row").join(covered.withColumnRenamed("row", "c_row"), F.col("row") == F.col("c_row"), "left")
    made = told.select("key", "text", "spans").mapInArrow(mapped(cut, "text", schema), ddl)
    return made.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)

