"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyforge.llm.batches import mixed, slices
from tallyforge.llm.bits import Sketch, sketch_of
from tallyforge.operators.ranking import top_exact
from tallyforge.session import stage_table

LONGEST = 4
#: Texts are cut into chunks of about this many bytes, at the end of a piece or else after a word.
CHUNK_BYTES = 8 << 20
#: A prefix with more than this share of all occurrences (so a thousand at most) has its counter dealt to so many parts.
HEAVY_SHARE = 0.001
PARTS = 64
#: Ends a piece. No UTF-8 text has this byte.
_END = b"\xff"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _END * 10 + b" ")
#: On the way to the merge a counter is its words joined by blanks and their counts as 32-bit numbers.
_STRIPE = pa.schema([
    ("lang", pa.string()), ("prefix", pa.string()), ("part", pa.int32()), ("rest", pa.int64()), ("nexts", pa.string()), ("counts", pa.binary()),
])
_STRIPE_DDL = "lang string, prefix string, part int, rest long, nexts string, counts binary"
_COUNTER = pa.schema([*list(_STRIPE)[:4], ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_MERGED = pa.schema([
    ("lang", pa.string()), ("prefix", pa.string()), ("total", pa.int64()),
    ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())),
])
_MERGED_DDL = "lang string, prefix string, total long, nexts array<string>, counts array<long>, marks array<long>"


def chunks(data: bytes, size: int) -> Iterator[tuple[list[bytes], int]]:
    """Words and ends of pieces, and how many of the last words only follow: they are met again in the next chunk."""
    at = 0
    while at < len(data):
        stop = len(data) if len(data) - at <= size else data.rfind(_END, at + 1, at + size)
        if stop < 0:
            stop = data.find(b" ", at + size)
            stop = len(data) if stop < 0 else stop
        found = data[at:stop].replace(_END, b" \xff ").split()
        ahead, reach = [], 64
        while data[stop : stop + 1] == b" " and len(ahead) < LONGEST:
            seen = data[stop : stop + reach].split(_END)[0]
            ahead = seen.split()
            if stop + reach >= len(data) or len(seen) < reach:
                break
            # The last word may go on behind what was read.
            ahead, reach = ahead[:-1], 4 * reach
        ahead = ahead[: LONGEST - 1]
        yield [*found, *ahead, _END], len(ahead)
        at = stop


def _gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.DictionaryArray, np.ndarray]]:
    """By language: words and ends of pieces in order, and which of the words are met here for the first time."""
    for piece in slices(batches, "text", size):
        langs, texts = piece.column("lang").to_pylist(), piece.column("text")
        for lang in sorted(set(langs)):
            words: list[bytes] = []
            own: list[np.ndarray] = []
            for k, name in enumerate(langs):
                if name != lang or not texts[k].is_valid:
                    continue
                for found, ahead in chunks(texts[k].as_buffer().to_pybytes().translate(_PLAIN), size):
                    words += found
                    flags = np.ones(len(found), bool)
                    flags[len(found) - 1 - ahead :] = False
                    own.append(flags)
                    if len(words) * 4 > size:
                        yield lang, pa.array(words, pa.binary()).dictionary_encode(), np.concatenate(own)
                        words, own = [], []
            if words:
                yield lang, pa.array(words, pa.binary()).dictionary_encode(), np.concatenate(own)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxh3_64_intdigest(lang.encode()))


def _numbers(words: list) -> np.ndarray:
    """64-bit hashes of words, texts or bytes."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def marks(words: list[np.ndarray], seed: np.uint64 | np.ndarray) -> np.ndarray:
    """One 64-bit hash for each phrase, from the hashes of its first words, second words and so on."""
    total = np.zeros(len(words[0]), np.uint64) + seed
    for part in words:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + part)
    return total


def _word_counts(docs: DataFrame, size: int) -> DataFrame:
    """``lang, phrase, f, mark``: the counter of the empty prefix."""

    def count(batches):
        for lang, coded, own in _gathered(batches, size):
            n = np.bincount(coded.indices.to_numpy()[own], minlength=len(coded.dictionary))
            words = coded.dictionary.to_pylist()
            shown = np.array([w != _END for w in words]) & (n > 0)
            mark = marks([_numbers(words)], _seed(lang)).view(np.int64)
            kept = pa.array(shown)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * int(shown.sum()), pa.string()), coded.dictionary.filter(kept).cast(pa.string()), pa.array(n[shown]), pa.array(mark[shown])],
                names=["lang", "phrase", "f", "mark"],
            )

    found = docs.mapInArrow(count, "lang string, phrase string, f long, mark long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.first("mark").alias("mark"))


def _stripes(docs: DataFrame, words: int, known: Sketch, heavy: dict[str, list[str]], size: int) -> DataFrame:
    """The counters of the prefixes of so many words that ``known`` has, one for each chunk of text.

    A follower is counted by name only if ``known`` has the phrase that it ends, else in ``rest`` as the ends of
    pieces are; so the sum of a counter is the number of times that its prefix occurs.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, heavy))

    def count(batches):
        sketch, split = shared.value
        for lang, coded, own in _gathered(batches, size):
            ids = coded.indices.to_numpy().astype(np.int64)
            distinct = coded.dictionary.to_pylist()
            numbers = _numbers(distinct)
            n, size_of = len(ids), len(distinct)
            if n <= words:
                continue
            end = ids == distinct.index(_END)
            whole = ~end[: n - words + 1]
            for k in range(1, words):
                whole = whole & ~end[k : n - words + 1 + k]
            common = np.zeros(n + 1, bool)
            common[: n - words + 1] = whole & sketch.has(marks([numbers[ids[k : n - words + 1 + k]] for k in range(words)], _seed(lang)))
            at = np.flatnonzero(common[: n - words + 1] & own[: n - words + 1])
            if not len(at):
                continue
            named = common[at + 1]
            follower = np.where(named, ids[np.minimum(at + words, n - 1)], -1)
            code, first = ids[at], None
            for k in range(1, words):
                code = np.unique(code * size_of + ids[at + k], return_inverse=True)[1]
            _, first, code = np.unique(code, return_index=True, return_inverse=True)
            pairs, counts = np.unique(code * (size_of + 1) + follower + 1, return_counts=True)
            code, follower = pairs // (size_of + 1), pairs % (size_of + 1) - 1
            prefix = [coded.dictionary.take(pa.array(ids[at[first] + k])).cast(pa.string()) for k in range(words)]
            prefix = prefix[0] if words == 1 else pc.binary_join_element_wise(*prefix, " ")
            hot = pc.is_in(prefix, pa.array(split.get(lang, []), pa.string())).to_numpy(zero_copy_only=False)
            part = np.where(hot[code] & (follower >= 0), (numbers[follower] & np.uint64(PARTS - 1)).astype(np.int64), 0)
            order = np.lexsort((follower, part, code))
            code, part, follower, counts = code[order], part[order], follower[order], counts[order]
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (part[1:] != part[:-1])])
            shown = follower >= 0
            rest = np.add.reduceat(np.where(shown, 0, counts), starts)
            offsets = np.r_[0, np.cumsum(np.add.reduceat(shown.astype(np.int32), starts))].astype(np.int32)
            nexts = pa.ListArray.from_arrays(pa.array(offsets), coded.dictionary.take(pa.array(follower[shown])).cast(pa.string()))
            packed = pa.py_buffer(counts[shown].astype("<u4").tobytes())
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(starts), pa.string()),
                    prefix.take(pa.array(code[starts])),
                    pa.array(part[starts], pa.int32()),
                    pa.array(rest, pa.int64()),
                    pc.binary_join(nexts, " "),
                    pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(4 * offsets), packed]),
                ],
                schema=_STRIPE,
            )
            for start in range(0, len(starts), 20_000):
                yield made.slice(start, 20_000)

    return docs.mapInArrow(count, _STRIPE_DDL)


def _unpacked(batch: pa.RecordBatch) -> pa.Table:
    """The counters of a batch as lists."""
    sizes = pc.binary_length(batch.column("counts")).to_numpy(zero_copy_only=False) // 4
    words = pc.split_pattern(batch.column("nexts"), " ")
    # An empty counter is an empty text, which splits into one empty word.
    named = np.repeat(sizes > 0, pc.list_value_length(words).to_numpy(zero_copy_only=False))
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<u4").astype(np.int64)
    lists = [pa.ListArray.from_arrays(offsets, words.flatten().filter(pa.array(named))), pa.ListArray.from_arrays(offsets, pa.array(counts))]
    return pa.table([*batch.select(list(_STRIPE.names[:4])).columns, *lists], schema=_COUNTER)


def _merged_batch(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """The first row of each key of the sorted rows, the sum of its counter, and its counter added up elementwise."""
    changed = np.zeros(len(rows), bool)
    changed[0] = True
    for name in ("lang", "prefix", "part"):
        column = rows.column(name).combine_chunks()
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    group = np.cumsum(changed) - 1
    nexts, counts = rows.column("nexts").combine_chunks(), rows.column("counts").combine_chunks()
    lengths = pc.list_value_length(nexts).to_numpy(zero_copy_only=False)
    entries = pa.table({"group": np.repeat(group, lengths), "next": nexts.flatten(), "count": counts.flatten()})
    entries = entries.group_by(["group", "next"]).aggregate([("count", "sum")]).sort_by("group")
    total = np.zeros(int(group[-1]) + 1, np.int64)
    np.add.at(total, group, rows.column("rest").to_numpy())
    return np.flatnonzero(changed), total, entries


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Counters of one key added up elementwise, without the followers found fewer than ``least`` times.

    Rows arrive sorted by key, so a task holds the counter of one key (of one part of it, for heavy prefixes)
    and the rows of a batch.
    """

    def merge(batches):
        held = None

        def finished(rows, first, rests, entries, keys):
            group, counts = entries.column("group").to_numpy(), entries.column("count_sum").to_numpy()
            total = rests.copy()
            np.add.at(total, group, counts)
            kept = np.flatnonzero((counts >= least) & (group < keys))
            lengths = np.bincount(group[kept], minlength=keys)[:keys]
            offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
            names = entries.column("next").combine_chunks().take(pa.array(kept))
            heads = rows.select(["lang", "prefix"]).take(pa.array(first[:keys]))
            used, at = np.unique(group[kept], return_inverse=True)
            langs, prefixes = (heads.column(c).take(pa.array(used)).to_pylist() for c in ("lang", "prefix"))
            words = [_numbers(w)[at] for w in zip(*(p.split(" ") for p in prefixes))]
            seeds = np.array([_seed(lang) for lang in langs], np.uint64)[at]
            found = marks([*words, _numbers(names.to_pylist())], seeds).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    *(heads.column(c).combine_chunks() for c in ("lang", "prefix")),
                    pa.array(total[:keys], pa.int64()),
                    pa.ListArray.from_arrays(offsets, names),
                    pa.ListArray.from_arrays(offsets, pa.array(counts[kept], pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64())),
                ],
                schema=_MERGED,
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _unpacked(batch)
            rows = rows if held is None else pa.concat_tables([held, rows])
            first, rests, entries = _merged_batch(rows)
            if len(first) > 1:
                yield finished(rows, first, rests, entries, len(first) - 1)
            # The last key may go on in the next batch: its counter is kept whole.
            last = entries.filter(pc.equal(entries.column("group"), len(first) - 1))
            head = rows.slice(int(first[-1]), 1)
            held = pa.table(
                [
                    head.column("lang"), head.column("prefix"), head.column("part"), pa.array([int(rests[-1])], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(last)], pa.int32()), last.column("next").combine_chunks()),
                    pa.ListArray.from_arrays(pa.array([0, len(last)], pa.int32()), last.column("count_sum").combine_chunks()),
                ],
                schema=_COUNTER,
            )
        if held is not None:
            yield finished(held, *_merged_batch(held), 1)

    dealt = stripes.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    return dealt.mapInArrow(merge, _MERGED_DDL)


def _heavy(totals: DataFrame, total: int) -> dict[str, list[str]]:
    """By language, the phrases with more than ``HEAVY_SHARE`` of all occurrences."""
    found: dict[str, list[str]] = {}
    for lang, phrase in totals.filter(F.col("f") > HEAVY_SHARE * total).select("lang", "phrase").toLocalIterator():
        found.setdefault(lang, []).append(phrase)
    return found


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, percent: int = 80, top: int = 2000, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` (numbers long): the best phrases of two to four words of every language.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at blanks and tabs into words.
    ``a`` is how often a phrase occurs, ``least`` at the least; ``l`` and ``r`` how often the two sides of its
    lowest-scoring cut do (of equal scores that with the shortest left side), ``n`` how many words the language has, and
    ``score`` the floor of ``2000000 * a / (l + r)``. A phrase inside a longer one with at least ``percent`` hundredths of
    its count is dropped. Equal scores go by ``a``, the larger first, then by the bytes of the phrase.

    Each prefix of one to three words keys a counter of the words behind it. Counters of one prefix are added up
    elementwise; the sum of a counter is the count of its prefix, its entries are the extensions, and its largest entry is
    what may subsume the prefix. An entry also tells what may subsume the phrase without its first word. A counter keeps by
    name only phrases whose first and last part occur ``least`` times themselves, as none else can; a sketch of
    bounded size tells which those are, so the count of distinct rare phrases is not shuffled. The counters of heavy
    prefixes, known from the round before, are dealt to parts by the following word.

    Arithmetic is in decimals of 38 digits. A null or empty text has no words, a null language is ``und``;
    repeated rows and null keys count as any other. Texts of any length are read in chunks of ``chunk_bytes``. An empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    singles = stage_table(_word_counts(rows, chunk_bytes), "words")
    sizes = singles.groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    frequent = singles.filter(F.col("f") >= least)
    phrases, totals, heavies = [], [frequent.select("lang", "phrase", "f")], [_heavy(frequent, total)]
    sketch = sketch_of(frequent.select("mark"))
    for words in range(1, LONGEST):
        made = stage_table(_merged(_stripes(rows, words, sketch, heavies[-1], chunk_bytes), least), f"stripes-{words}")
        entries = made.select("lang", "prefix", F.inline(F.arrays_zip("nexts", "counts", "marks")))
        entries = entries.select("lang", "prefix", F.concat_ws(" ", "prefix", "nexts").alias("phrase"), F.col("counts").alias("f"), F.col("marks").alias("mark"))
        phrases.append(entries.withColumn("words", F.lit(words + 1)))
        if words > 1:
            summed = made.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").cast("long").alias("f"))
            totals.append(summed.filter(F.col("f") >= least))
        if words + 1 < LONGEST:
            sketch = sketch_of(entries.select("mark"))
            heavies.append(_heavy(entries, total))
    longer = phrases[1].unionByName(phrases[2])
    # What may subsume a phrase: the entries of its own counter, and entries of counters that begin one word earlier.
    inside = longer.select("lang", F.explode(F.array("prefix", F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"), "f")
    widest = inside.groupBy("lang", "phrase").agg(F.max("f").alias("widest"))
    every = phrases[0].unionByName(longer).select("lang", "phrase", "words", F.col("f").alias("a"))
    alone = every.join(widest, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("widest"), F.lit(0)).cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * percent
    )
    sides = alone.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = sides.select(
        "lang", "phrase", "a", "k",
        F.expr("explode(map('l', substring_index(phrase, ' ', k), 'r', substring_index(phrase, ' ', k - words)))").alias("side", "half"),
    )
    looked = _looked_up(sides, totals, [f"{name}\n{phrase}" for held in heavies for name, kept in held.items() for phrase in kept])
    both = looked.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")
    )
    score = F.expr("cast((cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = top_exact(scored, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _looked_up(sides: DataFrame, totals: list[DataFrame], heavy: list[str]) -> DataFrame:
    """The sides with their counts ``f``. Those of heavy phrases, three thousand at most, are sent to all tasks."""
    known = totals[0]
    for more in totals[1:]:
        known = known.unionByName(more)
    known = known.select(F.col("lang").alias("k_lang"), F.col("phrase").alias("k_phrase"), "f")
    name = F.concat_ws("\n", "k_lang", "k_phrase")
    few = known.filter(name.isin(heavy)) if heavy else known.limit(0)
    same = (F.col("lang") == F.col("k_lang")) & (F.col("half") == F.col("k_phrase"))
    near = sides.join(F.broadcast(few), same, "left").drop("k_lang", "k_phrase")
    far = near.filter("f IS NULL").drop("f").join(known, same).drop("k_lang", "k_phrase")
    return near.filter("f IS NOT NULL").unionByName(far)
