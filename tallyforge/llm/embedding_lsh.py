"""Benchmark items inside documents, by the random-walk embedding of edit distance and bit sampling."""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import WordHashes, mapped, mixed

_BREAKS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Steps sampled for one key, and the share of steps that still agree at the edit limit (measured on
#: random edits of a fifth of the words); both give the number of walks that a recall needs.
SAMPLED, AGREE = 2, 0.35
#: Windows embedded at a time.
WINDOWS = 20_000
#: At most so many bytes of item text are handed to the tasks at once; more items take more passes.
ITEM_BYTES = 8 << 20


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case runs of ASCII letters and digits and of all characters beyond ASCII."""
    return (text or "").lower().encode("utf-8").translate(_BREAKS).split()


def walks_needed(recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - AGREE**SAMPLED))


def sampled_steps(length: int, walks: int) -> np.ndarray:
    """For each walk the steps to look at, from the first third of the embedding of 3 * length steps: there no
    walk can have left its window."""
    drawn = np.random.default_rng(length)
    return np.array([np.sort(drawn.choice(max(SAMPLED, length), SAMPLED, replace=False)) % length for _ in range(walks)])


def sample_keys(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, walks: int) -> np.ndarray:
    """Keys of the windows ``symbols[start : start + length]``, one row a walk: what the walk writes at its steps.

    At each step a walk writes down the word it stands on and moves on by one or not, as a random bit
    of the step and the word says. Two windows at a small edit distance fall into step again after each
    edit, so what they write differs in few steps.
    """
    if not len(starts):
        return np.zeros((walks, 0), np.uint64)
    kinds, kind = np.unique(lengths, return_inverse=True)
    steps = np.stack([sampled_steps(int(n), walks) for n in kinds])[kind].transpose(1, 0, 2)
    shape, steps = steps.shape, steps.reshape(-1)
    order = np.argsort(steps, kind="stable")
    edges = np.searchsorted(steps[order], np.arange(steps.max() + 2))
    written = np.zeros(len(steps), np.uint64)
    multipliers = np.random.default_rng(7).integers(1 << 62, size=(steps.max() + 1, walks, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    at = np.repeat(starts[None], walks, axis=0)
    for step, multiplier in enumerate(multipliers):
        word = symbols[np.minimum(at, len(symbols) - 1)]
        now = order[edges[step] : edges[step + 1]]
        written[now] = word.reshape(-1)[now // SAMPLED]
        at += (word * multiplier >> np.uint64(63)).astype(np.int64)
    written = written.reshape(shape)
    keys = lengths.astype(np.uint64) * np.uint64(1000) + np.arange(walks, dtype=np.uint64)[:, None]
    for k in range(SAMPLED):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + written[..., k])
    return keys


def best_prefix(a: list, b: list, limit: int) -> int:
    """Least edit distance of ``a`` to ``b`` without some of its end, in one bit-parallel pass; any number above
    ``limit`` if it is above."""
    if not a:
        return 0
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    whole, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score, best = whole, 0, len(a), len(a)
    for k, x in enumerate(b):
        # A further word makes the distance less by one at most.
        if score - (len(b) - k) > limit:
            break
        match = where.get(x, 0)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(zero | plus) & whole
        down = zero & plus
        score += bool(up & top) - bool(down & top)
        if score < best:
            best, limit = score, min(limit, score)
        up = up << 1 & whole | 1
        plus = down << 1 & whole | ~(zero | up) & whole
        minus = up & zero
    return best


class Items:
    """Benchmark items by length, with the keys of their embeddings."""

    def __init__(self, items: list[tuple[int, str]], edit_share: float, walks: int):
        self.hashes, self.walks = WordHashes(), walks
        self.words: dict[int, list[bytes]] = {}
        self.by_length: dict[int, list[int]] = {}
        for item, text in items:
            words = plain_words(text)
            if words:
                self.words[item] = words
                self.by_length.setdefault(len(words), []).append(item)
        self.limit = {n: int(edit_share * n) for n in self.by_length}
        #: The words of items, numbered from 1; all others are 0.
        self.known = {w: k for k, w in enumerate(dict.fromkeys(w for words in self.words.values() for w in words), 1)}
        self.distinct = {i: frozenset(words) for i, words in self.words.items()}
        order = list(self.words)
        sizes = np.array([len(self.words[i]) for i in order], np.int64)
        symbols = np.concatenate([np.zeros(0, np.uint64), *(self.hashes.of(self.words[i]) for i in order)])
        self.keys: dict[int, list[int]] = {}
        for row in sample_keys(symbols, np.cumsum(sizes) - sizes, sizes, walks).tolist():
            for item, made in zip(order, row):
                self.keys.setdefault(made, []).append(item)
        self.sorted_keys = np.sort(np.array(list(self.keys), np.uint64))
        self.size, self.need = sizes, sizes - 1 - 2 * np.array([self.limit[n] for n in sizes.tolist()], np.int64)
        # The neighbouring pairs of words that items have, each with the items that have it.
        own = [np.unique(self._pairs(self.numbers(self.words[i]))[1]) for i in order]
        pairs = np.concatenate([np.zeros(0, np.int64), *own])
        owners = np.repeat(np.arange(len(order)), [len(p) for p in own])
        sort = np.argsort(pairs, kind="stable")
        self.pairs, self.first, self.count = np.unique(pairs[sort], return_index=True, return_counts=True)
        self.owners = owners[sort]
        # Tells most pairs that no item has at one look.
        self.some = np.zeros(1 << 20, bool)
        self.some[self._look(self.pairs)] = True
        #: Words that stand behind a text for windows that reach beyond it.
        self.beyond = max(self.limit.values(), default=0)

    @staticmethod
    def _look(pairs: np.ndarray) -> np.ndarray:
        return (mixed(pairs.view(np.uint64)) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(0)), np.int64, len(words))

    def _pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the neighbouring words that both stand in items, and a number for each such pair."""
        at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        return at, numbers[at] * (len(self.known) + 1) + numbers[at + 1]

    def windows(self, numbers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the windows that can lie within the limit of some item of that length.

        An edit takes at most two of the n - 1 neighbouring pairs of an item away (a word put in takes one, and another
        where it moves the end of the item out of the window), so a window has at least n - 1 - 2 * limit pairs of
        the item. No window within the limit is lost by this.
        """
        made = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for n in self.by_length:
            if n - 1 - 2 * self.limit[n] <= 0:
                made.append((np.arange(len(numbers)), np.full(len(numbers), n)))
        if len(self.pairs) and len(numbers) > 1:
            at, pairs = self._pairs(numbers)
            some = self.some[self._look(pairs)]
            at, pairs = at[some], pairs[some]
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            same = self.pairs[place] == pairs
            at, place = at[same], place[same]
            times = self.count[place]
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            item = self.owners[np.repeat(self.first[place], times) + inner]
            at = np.repeat(at, times)
            by_item = np.argsort(item, kind="stable")
            item, at = item[by_item], at[by_item]
            # Windows that hold this hit and as many further ones of the item as it needs.
            other = np.arange(len(at)) + np.maximum(self.need[item], 1) - 1
            fits = (other < len(at)) & (self.need[item] > 0)
            fits[fits] = item[other[fits]] == item[fits]
            low, high, size = at[other[fits]] - (self.size[item[fits]] - 2), at[fits], self.size[item[fits]]
            dense = high >= low
            low, high, size = low[dense], high[dense], size[dense]
            times = high - low + 1
            starts = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            made.append((starts, np.repeat(size, times)))
        starts, sizes = (np.concatenate(x) for x in zip(*made))
        inside = (starts >= 0) & (starts + sizes <= len(numbers))
        starts, sizes = np.divmod(np.unique(starts[inside] << 32 | sizes[inside]), 1 << 32)
        inside = owner[starts] == owner[starts + sizes - 1]
        return starts[inside], sizes[inside]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """Text number, item, first word and edits: the best start for each text and item within the limit.

        Only texts with a window are hashed. A word of the item that the range lacks takes an edit, so a candidate that lacks
        more of them than the limit is not compared.
        """
        worded = [plain_words(t) for t in texts]
        behind = np.zeros(self.beyond, np.int64)
        numbers = np.concatenate([np.zeros(0, np.int64), *(part for w in worded for part in (self.numbers(w), behind))])
        owner = np.repeat(np.arange(len(texts)), [len(w) + self.beyond for w in worded])
        first = np.concatenate([[0], np.cumsum([len(w) + self.beyond for w in worded])])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        starts, lengths = self.windows(numbers, owner)
        words = np.zeros(len(numbers), np.uint64)
        for k in np.unique(owner[starts]).tolist():
            words[first[k] : first[k] + len(worded[k])] = self.hashes.of(worded[k])
        for low in range(0, len(starts), WINDOWS):
            some, sizes = starts[low : low + WINDOWS], lengths[low : low + WINDOWS]
            made = sample_keys(words, some, sizes, self.walks)
            place = np.minimum(np.searchsorted(self.sorted_keys, made), max(0, len(self.sorted_keys) - 1))
            walk, window = np.nonzero(self.sorted_keys[place] == made)
            met: Counter[tuple[int, int]] = Counter()
            for w, k in zip(window.tolist(), made[walk, window].tolist()):
                met.update((w, item) for item in self.keys[k])
            for (w, item), _ in met.most_common():  # the likeliest first: most others are then cut short
                start, n = int(some[w]), int(sizes[w])
                text = int(owner[start])
                at = start - int(first[text])
                edits, before = best.get((text, item), (self.limit[n] + 1, 0))
                limit = edits if at < before else edits - 1
                told, own = worded[text][at : at + n + self.limit[n]], self.distinct[item]
                if len(own) - len(own.intersection(told)) > limit:
                    continue
                found = best_prefix(self.words[item], told, limit)
                if found <= limit:
                    best[text, item] = found, at
        return [(text, item, start, edits) for (text, item), (edits, start) in best.items()]


def contained_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    edit_share: float = 0.2, recall: float = 0.99,
) -> DataFrame:
    """``key, item_id, start_word, item_words, edits``: where documents contain benchmark items.

    One row for each document and item with a run of words within ``edit_share`` of the item's words as edits, words put
    in and left out included: the start with the fewest edits, the first among equals. Windows of the item's size at all
    starts of whole texts are candidates where they could be within the limit; their embeddings meet those of the items in
    enough walks for ``recall`` at the limit (equal windows always meet). A candidate is then compared with the
    best end that the limit allows.

    Items go to the tasks in groups of at most ``ITEM_BYTES`` of text, one pass over the documents for
    each; an item above that is a group of its own. Null and empty texts and items contain nothing; null
    keys and items are passed on; repeated rows give repeated rows. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    given = benchmark.filter(F.col(item_text).isNotNull()).select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
    schema = pa.schema([("key", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("item_words", pa.int64()), ("edits", pa.int64())])
    ddl = "key long, item_id long, start_word long, item_words long, edits long"
    passes = [_search(rows, group, edit_share, walks_needed(recall), schema, ddl) for group in _groups(given)]
    if not passes:
        passes = [docs.sparkSession.createDataFrame([], ddl)]
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def _groups(given: DataFrame):
    """Items in groups of bounded size, fetched partition by partition."""
    group, size = [], 0
    for row in given.toLocalIterator():
        more = len(row["text"].encode("utf-8"))
        if group and size + more > ITEM_BYTES:
            yield group
            group, size = [], 0
        group.append((row["item"], row["text"]))
        size += more
    if group:
        yield group


def _search(rows: DataFrame, group: list, edit_share: float, walks: int, schema: pa.Schema, ddl: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(group)
    state: dict[int, Items] = {}

    def search(piece: pa.RecordBatch) -> dict:
        items = state.get(0)
        if items is None:
            items = state[0] = Items(shared.value, edit_share, walks)
        keys = piece.column("key").to_pylist()
        found = items.search(piece.column("text").to_pylist())
        return {
            "key": [keys[text] for text, *_ in found],
            "item_id": [item for _, item, *_ in found],
            "start_word": [start for _, _, start, _ in found],
            "item_words": [len(items.words[item]) for _, item, *_ in found],
            "edits": [edits for *_, edits in found],
        }

    return rows.mapInArrow(mapped(search, "text", schema), ddl)
