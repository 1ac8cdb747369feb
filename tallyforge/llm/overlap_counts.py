"""Token counts of whole texts; huge texts are cut into overlapping chunks that are spliced again."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import REMEMBERED, mapped
from tallyforge.llm.tokenizer import SPACES, WordTokenizer, loaded
from tallyforge.session import stage_table


class Counter:
    """Encodes pieces of text through the library, each distinct word once while it is remembered."""

    def __init__(self, tokenizer: WordTokenizer):
        self.tokenizer = tokenizer
        self.spelling = dict(enumerate(tokenizer.letters))
        self.known = self._start()

    def _start(self) -> dict[str, int]:
        return {text: 1 for text in self.tokenizer.special}

    def learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self.known]
        if not missing:
            return
        if len(self.known) + len(missing) > REMEMBERED:
            self.known = self._start() | {w: self.known[w] for w in words if w in self.known}
        for word in missing:
            spelled = word.encode("utf-8").decode("latin-1").translate(self.spelling)
            self.known[word] = len(self.tokenizer.library.model.tokenize(spelled))

    def counts(self, texts: list[str | None]) -> list[int]:
        words = [self.tokenizer.words(text) if text else [] for text in texts]
        self.learn(set().union(*words))
        return [sum(map(self.known.__getitem__, each)) for each in words]

    def encoded(self, text: str) -> list[tuple[int, int]]:
        """Where each word starts (-1: unknown) and how many tokens it has, in order."""
        words = self.tokenizer.words_with_starts(text)
        self.learn({w for w, _ in words})
        return [(start, self.known[w]) for w, start in words]

    def chunk(self, text: str, overlap: int, first: bool, last: bool) -> dict[str, object]:
        """The tokens of one chunk and its stable boundaries in the overlaps at either end.

        A boundary is proven stable where a word starts after white space: no word crosses it, so what
        stands on one side does not change the tokens of the other.
        """
        entries = self.encoded(text)
        total = sum(n for _, n in entries)
        left, before, right, after = [], [], [], []
        seen, tail = 0, len(text) - overlap
        for start, n in entries:
            if start > 0 and text[start - 1] in SPACES:
                if not first and start < overlap:
                    left.append(start)
                    before.append(seen)
                if not last and start > tail:
                    right.append(start - tail)
                    after.append(total - seen)
            seen += n
        return {"n": total, "left": left, "before": before, "right": right, "after": after}


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(loaded(path))


_CHUNKS = pa.schema(
    [("key", pa.int64()), ("print", pa.int64()), ("chunk", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("left", "before", "right", "after")]
)
_CHUNK_DDL = "key long, print long, chunk long, n_bytes long, n long, left array<long>, before array<long>, right array<long>, after array<long>"


def count_tokens(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", chunk_chars: int = 32_768, overlap_chars: int = 256
) -> DataFrame:
    """``key``, ``n_bytes long`` and ``n_tokens long`` of every whole text, one row for each row.

    Texts of up to ``chunk_chars`` characters are encoded where they are. Longer ones are cut into chunks
    that share ``overlap_chars`` characters with the next one; chunks are dealt to all tasks, so one huge
    text does not hold up one task. Both neighbours report their stable boundaries in the overlap; the
    first that both have is where they are spliced. Where they have none in common (a run without white
    space longer than the overlap), the overlap is widened until chunks merge and are encoded as one.

    Null and empty texts have no bytes and no tokens; null and repeated keys are passed on, repeated rows
    give repeated rows; other columns are not read. ``tokenizer`` is a path that every executor can open.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    long_text = F.coalesce(F.char_length("text") > chunk_chars, F.lit(False))

    def whole(piece: pa.RecordBatch) -> dict:
        return {"key": piece.column("key"), "n_bytes": piece.column("n_bytes"), "n_tokens": _counter(tokenizer).counts(piece.column("text").to_pylist())}

    short_schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    short = rows.filter(~long_text).withColumn("n_bytes", size)
    short = short.mapInArrow(mapped(whole, "text", short_schema), "key long, n_bytes long, n_tokens long")

    cut_schema = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])

    def cut(piece: pa.RecordBatch) -> dict:
        made = {f.name: [] for f in cut_schema}
        for k, p, b, t in zip(*(piece.column(c).to_pylist() for c in ("key", "print", "n_bytes", "text"))):
            starts = range(0, len(t), chunk_chars)
            for i, start in enumerate(starts):
                last = i == len(starts) - 1
                values = (k, p, b, i, last, t[start : start + chunk_chars + (0 if last else overlap_chars)])
                for name, value in zip(made, values):
                    made[name].append(value)
        return made

    def encode(piece: pa.RecordBatch) -> dict:
        found = [
            _counter(tokenizer).chunk(t, overlap_chars, i == 0, last)
            for t, i, last in zip(*(piece.column(c).to_pylist() for c in ("text", "chunk", "last")))
        ]
        return {c: piece.column(c) for c in ("key", "print", "chunk", "n_bytes")} | {c: [f[c] for f in found] for c in ("n", "left", "before", "right", "after")}

    longer = rows.filter(long_text).withColumns({"print": F.xxhash64("text"), "n_bytes": size})
    dealt = longer.mapInArrow(mapped(cut, "text", cut_schema), "key long, print long, n_bytes long, chunk long, last boolean, text string")
    dealt = dealt.repartition("key", "print", "chunk")
    chunks = stage_table(dealt.mapInArrow(mapped(encode, "text", _CHUNKS), _CHUNK_DDL), "chunks")

    same = ["key", "print"]
    # A seam lies between chunk - 1 and chunk: the first has it on its right side, the second on its left.
    lefts = chunks.filter("chunk > 0").select(*same, F.col("chunk").alias("seam"), F.struct("left", "before").alias("l"), F.lit(None).alias("r"))
    rights = chunks.select(*same, (F.col("chunk") + 1).alias("seam"), F.lit(None).alias("l"), F.struct("right", "after").alias("r"))
    seams = lefts.unionByName(rights).groupBy(*same, "seam").agg(F.first("l", True).alias("l"), F.first("r", True).alias("r"))
    meet = F.array_min(F.array_intersect("l.left", "r.right"))
    twice = F.element_at("l.before", F.array_position("l.left", F.col("meet")).cast("int")) + F.element_at(
        "r.after", F.array_position("r.right", F.col("meet")).cast("int")
    )
    seams = seams.filter("l IS NOT NULL AND r IS NOT NULL").withColumn("meet", meet).withColumn("twice", F.when(F.col("meet").isNotNull(), twice))
    seams = stage_table(seams.select(*same, "seam", "twice"), "seams")

    terms = chunks.select(*same, "n_bytes", F.col("n").alias("tokens"), (F.col("chunk") == 0).cast("long").alias("copies"))
    # Repeated rows gave their chunks as often; seams are there once.
    overlaps = seams.filter("twice IS NOT NULL").select(*same, F.col("twice"))
    failed = seams.filter("twice IS NULL").groupBy(*same).agg(F.sort_array(F.collect_list("seam")).alias("seams"))
    per_text = terms.groupBy(*same).agg(F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("tokens"), F.sum("copies").alias("copies"))
    less = overlaps.groupBy(*same).agg(F.sum("twice").alias("less"))
    if not failed.isEmpty():
        wide_schema = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("less", pa.int64())])

        def widen(piece: pa.RecordBatch) -> dict:
            counter, made = _counter(tokenizer), []
            for t, broken in zip(piece.column("text").to_pylist(), piece.column("seams").to_pylist()):
                extra = 0
                for first, stop in runs(broken):
                    edges = range(first, stop + 1)  # chunks first - 1 to stop
                    end = min(len(t), (stop + 1) * chunk_chars + overlap_chars)
                    single = [t[(c - 1) * chunk_chars : min(len(t), c * chunk_chars + overlap_chars)] for c in edges]
                    single.append(t[stop * chunk_chars : end])
                    extra += sum(counter.counts(single)) - counter.counts([t[(first - 1) * chunk_chars : end]])[0]
                made.append(extra)
            return {"key": piece.column("key"), "print": piece.column("print"), "less": made}

        again = longer.dropDuplicates(same).join(failed.select(*(F.col(c).alias(f"f_{c}") for c in (*same, "seams"))), F.col("key").eqNullSafe(F.col("f_key")) & (F.col("print") == F.col("f_print")))
        wide = again.select(*same, "text", F.col("f_seams").alias("seams")).mapInArrow(mapped(widen, "text", wide_schema), "key long, print long, less long")
        less = less.unionByName(wide).groupBy(*same).agg(F.sum("less").alias("less"))
    less = less.select(F.col("key").alias("l_key"), F.col("print").alias("l_print"), "less")
    joined = per_text.join(less, F.col("key").eqNullSafe(F.col("l_key")) & (F.col("print") == F.col("l_print")), "left")
    spliced = joined.select("key", "n_bytes", (F.col("tokens") / F.col("copies") - F.coalesce("less", F.lit(0))).cast("long").alias("n_tokens"), "copies")
    spliced = spliced.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("key", "n_bytes", "n_tokens")
    return short.unionByName(spliced).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def runs(numbers: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of consecutive numbers in a sorted list; repeats count once."""
    found: list[tuple[int, int]] = []
    for n in numbers:
        if found and n <= found[-1][1] + 1:
            found[-1] = (found[-1][0], n)
        else:
            found.append((n, n))
    return found
