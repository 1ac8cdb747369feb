"""Documents to shards of near-equal bytes by best-fit decreasing; equal texts stay together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import stage_table
from tallyforge.sources.memory import table_from_rows

#: Leading bits of a weight that its class keeps; weights are rounded up by less than one part in 2 ** 10,
#: and there are at most 2 ** 10 classes for each doubling of the weight.
CLASS_BITS = 11
#: Parts that a numbering is cut into, so that no task numbers a whole shard or class.
PARTS = 256


class FreeSpace:
    """A balanced search tree (treap) of bins by free space, then number."""

    def __init__(self):
        self.root: list | None = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return hash((key[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, key[1] * 0x85EBCA6B & 0xFFFFFFFF))

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _join(self, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high

    def add(self, free: int, number: int) -> None:
        key = (free, number)
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self._priority(key), None, None]), high)

    def remove(self, key: tuple[int, int]) -> None:
        low, rest = self._split(self.root, key)
        _, high = self._split(rest, (key[0], key[1] + 1))
        self.root = self._join(low, high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least free space that holds ``size``."""
        node, best = self.root, None
        while node is not None:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best


def best_fit(runs: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Places ``(size, count)`` runs, largest size first, each item into the tightest bin that holds it.

    Returns ``(run, bin, items)`` in order. A bin that took an item stays the tightest while it
    holds another of the same size, so a run takes one step for each bin it touches. Without ``bins`` a
    new bin is opened whenever none holds an item; with it, None tells that they are too few.
    """
    free, opened, placed = FreeSpace(), 0, []
    for run, (size, count) in enumerate(runs):
        if size > capacity:
            return None
        while count:
            found = free.tightest(size)
            if found is None:
                if opened == bins:
                    return None
                found = (capacity, opened)
                opened += 1
            else:
                free.remove(found)
            space, number = found
            items = min(count, space // size)
            placed.append((run, number, items))
            count -= items
            free.add(space - items * size, number)
    return placed


def balanced(runs: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """``best_fit`` into ``bins`` with the least capacity that suffices, to one part in 10,000.

    Items above the mean of what is left get a bin of their own first: they cannot be split, and a capacity
    that holds them would leave other bins empty.
    """
    runs = sorted(runs, reverse=True)
    total, alone, placed = sum(s * n for s, n in runs), 0, []
    rest = []
    for run, (size, count) in enumerate(runs):
        while count and bins - alone > 1 and size * (bins - alone) > total:
            placed.append((run, alone, 1))
            alone, count, total = alone + 1, count - 1, total - size
        if count:
            rest.append((run, size, count))
    if not rest:
        return placed
    left = [(size, count) for _, size, count in rest]
    low, high = -(-total // (bins - alone)), -(-total // (bins - alone)) + left[0][0]
    best = best_fit(left, high, bins - alone)
    while high - low > max(1, total // (bins - alone) // 10_000):
        middle = (low + high) // 2
        tried = best_fit(left, middle, bins - alone)
        if tried is None:
            low = middle + 1
        else:
            best, high = tried, middle
    return placed + [(rest[run][0], alone + number, items) for run, number, items in best]


def numbered(df: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name long``: 0, 1, ... within equal ``within``, in an order that the rows' values give.

    Rows are numbered in ``PARTS`` parts by a hash of ``order``, and each part starts after the ones before.
    """
    df = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int"))
    counts = df.groupBy(*within, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy(*within, "_part").orderBy(*order)) - 1
    return df.join(offsets, [*within, "_part"]).withColumn(name, F.col("_before") + inner).drop("_part", "_before")


def weight_class(weight: str) -> Column:
    """The weight with ``CLASS_BITS`` leading bits, rounded up."""
    shift = F.greatest(F.length(F.bin(weight)) - CLASS_BITS, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.ceil(F.col(weight) / step).cast("long") * step


def packed(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """``key, size long, text_crc32 long, shard int, slot long``: every row, in one of ``shards`` shards.

    A row's size is the UTF-8 bytes of its text and ``overhead``. Rows with equal texts are one indivisible
    group. Groups are placed by best fit, largest first, so that shards have nearly equal sizes; a group above
    the mean gets a shard to itself. Slots number the rows of a shard from 0.

    The driver sees only how many groups each weight class has, a number bounded by the class bits. It
    gives each class stretches of ranks for shards; tasks rank the groups of a class and look their stretch up.

    A null text counts as empty, and so belongs with empty texts. Null and repeated keys are rows like
    others. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(
        "key",
        (F.octet_length("text") + overhead).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("print"),
    )
    rows = stage_table(rows, "sizes")
    group = ["print", "text_crc32", "size"]
    groups = rows.groupBy(*group).agg((F.count("*") * F.col("size")).alias("weight"))
    groups = stage_table(groups.withColumn("class", weight_class("weight")).drop("weight"), "groups")
    runs = sorted(((r["class"], r["n"]) for r in groups.groupBy("class").agg(F.count("*").alias("n")).collect()), reverse=True)
    first: dict[int, int] = {}
    stretches = []
    for run, shard, items in balanced(runs, shards):
        start = first.get(run, 0)
        stretches.append((runs[run][0], start, start + items, shard))
        first[run] = start + items
    plan = table_from_rows(docs.sparkSession, stretches, "p_class long, low long, high long, shard int")
    ranked = numbered(groups, ["class"], group, "rank")
    placed = ranked.join(plan, (F.col("class") == F.col("p_class")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    # Equal groups may be very large: rows meet their group's shard in a join that can be split.
    sharded = stage_table(rows.join(placed.select(*group, "shard"), group), "sharded")
    slotted = numbered(sharded, ["shard"], ["key", "print"], "slot")
    return slotted.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
