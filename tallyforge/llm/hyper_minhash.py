"""Near-duplicate documents by HyperMinHash sketches, confirmed on whole shingle sets."""

from __future__ import annotations

from collections import OrderedDict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import WordHashes, mapped, mixed, shingle_hashes
from tallyforge.llm.graph import components
from tallyforge.session import stage_table

#: Registers of a sketch, and how many make a band. A pair at similarity 0.8 shares none of the 32 bands
#: with a probability of (1 - 0.8 ** 4) ** 32, or 5 in 10 ** 8.
REGISTERS, ROWS = 128, 4
#: Bits of a register after the leading-zero count.
MANTISSA = 10
_BUCKET_BITS = 7
#: Bytes of text taken at a time.
SLICE = 1 << 20
#: Documents of a block, and parts that the blocks of one component are dealt to.
BLOCK, SPREAD = 32, 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of the lower-cased text (A to Z only)."""
    if not text:
        return np.zeros(0, np.uint64)
    # For bytes, lower() and split() know ASCII alone: A-Z, and space and \x09 to \x0d.
    return np.unique(shingle_hashes(hashes.of(text.encode("utf-8").lower().split()), n))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``REGISTERS`` 16-bit registers for each non-empty set.

    Each element falls into one bucket and leaves a value; the bucket keeps the smallest. Buckets that
    stay empty are filled in further rounds with other hash functions (at last one bucket a round), so
    any two registers agree with the probability that the similarity gives, for small sets too. What is
    kept of a value is its number of leading zeros and the bits after them.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    kept = np.zeros((len(sets), REGISTERS), np.uint16)
    empty = np.ones((len(sets), REGISTERS), bool)
    for turn in range(2 * REGISTERS):
        if not len(items):
            break
        x = mixed(items + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        if turn < REGISTERS:
            bucket = (x >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        else:
            bucket = np.full(len(x), turn - REGISTERS)
        least = np.full((len(sets), REGISTERS), _NONE)
        np.minimum.at(least, (owner, bucket), x << np.uint64(_BUCKET_BITS))
        new = empty & (least != _NONE)
        kept[new] = _register(least[new], turn)
        empty &= ~new
        open_sets = empty.any(axis=1)
        still = open_sets[owner]
        items, owner = items[still], owner[still]
    return kept


def _register(values: np.ndarray, turn: int) -> np.ndarray:
    """Leading zeros above, ``MANTISSA`` bits below; the round is mixed into these."""
    # Zeros of the 57 bits that are left: by the exponent of the upper 32 bits, exact as a double.
    upper = (values >> np.uint64(32)).astype(np.float64)
    zeros = np.where(upper > 0, 32 - np.frexp(upper)[1], 32).astype(np.uint64)
    rest = (values << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | (rest ^ np.uint64(turn * 389 % (1 << MANTISSA)))).astype(np.uint16)


def estimated_similarity(a: str, b: str, size_a: str, size_b: str) -> Column:
    """Share of equal registers less what chance makes equal.

    The chance that two unrelated minima fall into one cell: the cell that begins at x has a width of about
    x * 2 ** -MANTISSA * 0.72 (the mean of 1/x over an octave), and minima of n values are spread
    exponentially, which leaves 0.72 * 2 ** -MANTISSA * n * m / (n + m) ** 2.
    """
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    chance = F.lit(0.7213 / (1 << MANTISSA)) * F.col(size_a) * F.col(size_b) / F.pow(F.col(size_a) + F.col(size_b), F.lit(2.0))
    return (equal / REGISTERS - chance) / (1 - chance)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, slack: float = 0.15) -> DataFrame:
    """``key, n_shingles long, component_id long``: the smallest key that links lead to.

    A link: 100 * shared shingles >= ``percent`` * all shingles of both, on whole sets (of 64-bit shingle
    hashes). Documents with equal sets are one class from the start and stand in for each other. Classes
    whose bands agree are candidates. Pairs whose corrected estimate is below the threshold by
    more than ``slack`` (four standard deviations of 128 registers at 0.8) are dropped, the others are
    confirmed on their texts. Texts of candidates are fetched once.

    No bucket gives all its pairs. First every member meets the smallest and the largest of its bucket, and
    the confirmed links make components. Only members of a bucket that are not in its largest
    component then meet those of other components of the bucket: within a component a further link
    changes nothing. They do so in blocks, and only the links come out.

    Texts without words are linked with nothing and are their own component. Rows with a null key come back
    with a null component; repeated rows come back as often, and a key with several texts stands for all of
    them. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("key", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("registers", pa.list_(pa.int16()))])
    ddl = "key long, n_shingles long, print binary, registers array<short>"

    def sketch(piece: pa.RecordBatch) -> dict:
        hashes = WordHashes()
        sets = [text_shingles(t, words, hashes) for t in piece.column("text").to_pylist()]
        kept = iter(sketches([s for s in sets if len(s)]).view(np.int16))
        return {
            "key": piece.column("key"),
            "n_shingles": [len(s) for s in sets],
            "print": [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "registers": [next(kept) if len(s) else None for s in sets],
        }

    sketched = stage_table(rows.mapInArrow(mapped(sketch, "text", schema, SLICE), ddl), "sketches")
    filled = sketched.filter("n_shingles > 0 AND key IS NOT NULL")
    # One row for each set: its smallest key stands for it.
    classes = stage_table(
        filled.groupBy("print").agg(F.min("key").alias("rep"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "classes"
    )
    # A key with several texts is one node: the same key may stand for several sets.
    member = filled.select("print", "key").distinct()
    same_set = member.join(classes.select("print", "rep"), "print").select(F.col("key").alias("a"), F.col("rep").alias("b"))

    first_in_band = [F.slice("registers", k * ROWS + 1, ROWS) for k in range(REGISTERS // ROWS)]
    bands = classes.select("rep", F.posexplode(F.array(*first_in_band)).alias("band", "part"))
    bands = bands.select(F.xxhash64("band", "part").alias("bucket"), "rep")
    ends = bands.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    buckets = stage_table(bands.join(ends, "bucket"), "buckets")
    star = buckets.select(F.col("rep").alias("x"), F.explode(F.array("low", "high")).alias("y")).filter("x <> y")
    star = star.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    # Dealt by key at every size, so that what is moved stays in proportion to the input.
    candidates = buckets.select(F.col("rep").alias("c_key")).distinct()
    texts = rows.repartition("key").join(candidates, F.col("key") == F.col("c_key"), "left_semi")
    texts = stage_table(texts.groupBy("key").agg(F.collect_set("text").alias("texts")), "candidates")
    confirmed = stage_table(_confirmed(star, classes, texts, words, percent, slack), "links")
    groups = components(confirmed)

    # What is left: members of buckets that hold several components.
    placed = buckets.join(groups, F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    counts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    members = stage_table(placed.join(main.filter("parts > 1"), "bucket"), "mixed")
    rest = stage_table(_links_across(members, texts, words, percent), "links")

    groups = components(confirmed.unionByName(rest).unionByName(same_set))
    found = sketched.join(groups, F.col("key") == F.col("node"), "left")
    return found.select(F.col("key").alias(key), "n_shingles", F.coalesce("component", "key").alias("component_id"))


def _links_across(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b``: links between different components that meet in a bucket.

    Members outside the largest component of a bucket are the queries, all members are what they are held
    against, both in blocks of about ``BLOCK``; a row is a block of either side, with their shingle sets, and is
    compared as a whole. Blocks of one component are dealt to up to ``SPREAD`` parts, so a large family is
    not one task.
    """
    roles = members.groupBy("main", "rep").agg(F.first("component").alias("component"))
    set_schema = pa.schema([("key", pa.int64()), ("shingles", pa.binary())])

    def sets(piece: pa.RecordBatch) -> dict:
        hashes = WordHashes()
        rows = [(k, text_shingles(t, words, hashes)) for k, own in zip(piece.column("key").to_pylist(), piece.column("texts").to_pylist()) for t in own]
        return {"key": [k for k, _ in rows], "shingles": [s.tobytes() for _, s in rows]}

    wanted = texts.join(roles.select(F.col("rep").alias("m_key")).distinct(), F.col("key") == F.col("m_key"), "left_semi")
    found = wanted.mapInArrow(mapped(sets, "texts", set_schema, SLICE), "key long, shingles binary")
    each = stage_table(roles.join(found, F.col("rep") == F.col("key")).select("main", "rep", "component", "shingles"), "members")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        dealt = rows.join(sizes, "main").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        held = F.collect_list(F.struct("rep", "component", "shingles")).alias(name)
        return dealt.groupBy("main", "block").agg(F.first("blocks").alias("blocks"), held)

    strays = blocks(each.filter("component <> main"), "strays").withColumn("parts", F.least("blocks", F.lit(SPREAD)))
    parts = strays.groupBy("main").agg(F.first("parts").alias("parts"))
    strays = strays.select("main", F.pmod("block", "parts").alias("part"), "strays")
    others = blocks(each, "others").join(parts, "main")
    others = others.select("main", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "others")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(piece: pa.RecordBatch) -> dict:
        links = []
        for strays, others in zip(piece.column("strays").to_pylist(), piece.column("others").to_pylist()):
            known = [np.frombuffer(o["shingles"], np.uint64) for o in others]
            sizes = np.array([len(k) for k in known])
            owner, flat = np.repeat(np.arange(len(known)), sizes), np.concatenate(known)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for x in strays:
                own = np.frombuffer(x["shingles"], np.uint64)
                low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                hits = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                both = np.bincount(owner[hits], minlength=len(known))
                near = np.flatnonzero((both > 0) & (100 * both >= percent * (len(own) + sizes - both)))
                links.extend((x["rep"], others[k]["rep"]) for k in near.tolist() if others[k]["component"] != x["component"])
        return {"a": [a for a, _ in links], "b": [b for _, b in links]}

    pairs = strays.join(others, ["main", "part"]).select("strays", "others", F.lit("").alias("text"))
    return pairs.mapInArrow(mapped(compare, "text", schema), "a long, b long").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int, slack: float) -> DataFrame:
    """``a, b``: the pairs of classes ``x, y`` that are links, by their keys."""
    sketch = classes.select("rep", "n", "registers")
    left = sketch.select(*(F.col(c).alias(f"x_{c}") for c in sketch.columns))
    right = sketch.select(*(F.col(c).alias(f"y_{c}") for c in sketch.columns))
    likely = pairs.join(left, F.col("x") == F.col("x_rep")).join(right, F.col("y") == F.col("y_rep"))
    likely = likely.filter(100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    likely = likely.filter(estimated_similarity("x_registers", "y_registers", "x_n", "y_n") >= percent / 100 - slack)
    likely = stage_table(likely.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "likely")
    second = likely.join(texts.select(F.col("key").alias("b"), F.col("texts").alias("second")), "b")
    both = second.join(texts.select(F.col("key").alias("a"), F.col("texts").alias("first")), "a")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def confirm(piece: pa.RecordBatch) -> dict:
        hashes, known = WordHashes(), OrderedDict()

        def shingles(key: int, texts: list[str]) -> list[np.ndarray]:
            if key not in known:
                if len(known) >= 8:
                    known.popitem(last=False)
                known[key] = [text_shingles(t, words, hashes) for t in texts]
            return known[key]

        linked = []
        for a, b, first, second in zip(*(piece.column(c).to_pylist() for c in ("a", "b", "first", "second"))):
            ones, others = shingles(a, first), shingles(b, second)
            linked.append(any(_linked(s, t, percent) for s in ones for t in others))
        return {"a": piece.column("a"), "b": piece.column("b"), "linked": linked}

    checked = both.select("a", "b", "first", "second").mapInArrow(mapped(confirm, "second", schema, SLICE), "a long, b long, linked boolean")
    return checked.filter("linked").select("a", "b")


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(s, t, assume_unique=True))
    return shared > 0 and 100 * shared >= percent * (len(s) + len(t) - shared)
