"""Importance resampling of documents by hashed n-gram models of target and raw text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import WordHashes, mapped, mixed
from tallyforge.session import stage_table

#: Buckets of the hashed n-grams. A model is one array of this size, whatever the corpus.
BUCKETS = 1 << 16


def ngram_buckets(text: str | None, hashes: WordHashes, orders: int = 2) -> np.ndarray:
    """The bucket of each word and of each pair of neighbours, in lower case, punctuation as part of the word."""
    words = hashes.of((text or "").lower().encode("utf-8").split())
    found, total = [np.zeros(0, np.uint64)], np.zeros(len(words), np.uint64)
    for k in range(orders):
        if len(words) <= k:
            break
        total = mixed(total[: len(words) - k] * np.uint64(0x9E3779B97F4A7C15) + words[k:])
        found.append(total)
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)


def ngram_counts(docs: DataFrame, text: str, kind: str) -> DataFrame:
    """``kind, bucket, n``: how often each bucket occurs in all texts of each kind.

    Each slice of texts is one array of counts for each kind, so a task sends at most one row for each
    bucket, kind and slice, and these are summed before the shuffle.
    """
    schema = pa.schema([("kind", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(piece: pa.RecordBatch) -> dict:
        hashes, sums = WordHashes(), {}
        for k, t in zip(piece.column("kind").to_pylist(), piece.column("text").to_pylist()):
            sums.setdefault(k, []).append(ngram_buckets(t, hashes))
        made: dict[str, list] = {"kind": [], "bucket": [], "n": []}
        for k, parts in sums.items():
            total = np.bincount(np.concatenate(parts), minlength=BUCKETS)
            filled = np.flatnonzero(total)
            made["kind"].append(np.full(len(filled), k))
            made["bucket"].append(filled)
            made["n"].append(total[filled])
        return {c: pa.array(np.concatenate(v)) for c, v in made.items()}

    rows = docs.select(F.col(kind).cast("long").alias("kind"), F.col(text).alias("text"))
    found = rows.mapInArrow(mapped(count, "text", schema), "kind long, bucket long, n long")
    return found.groupBy("kind", "bucket").agg(F.sum("n").alias("n"))


def log_ratio(counts: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """Log of the target's share over the raw share, by bucket. ``kind`` 1 is target, which is raw text as well."""
    sums = np.zeros((2, BUCKETS))
    for row in counts.toLocalIterator():  # two rows for each bucket at most
        sums[row["kind"], row["bucket"]] = row["n"]
    target, raw = sums[1], sums.sum(axis=0)
    shares = [(s + smoothing) / (s.sum() + smoothing * BUCKETS) for s in (target, raw)]
    return np.log(shares[0]) - np.log(shares[1])


def gumbel(*columns: str, seed: int) -> Column:
    """Noise that depends on the columns and the seed alone, so a lost task draws the same again."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def resampled(
    docs: DataFrame, target: DataFrame, share: float, key: str = "doc_id", text: str = "text", temperature: float = 1.0, seed: int = 17,
    target_rows: int = 20_000,
) -> DataFrame:
    """``key, n_grams long, log_weight, noisy, kept``: every document, and whether it is drawn.

    ``target`` has the keys (column ``key``) of documents that the drawn ones should look like; of these at most
    ``target_rows``, chosen by a hash, are used, so their keys can be sent to all tasks. Two models
    of hashed words and pairs, one of the target and one of all documents, give each document the log of the ratio of its
    chances in the two, ``log_weight``: the sum of the log ratios of its n-grams. Gumbel noise is added to it over
    ``temperature``, and the ``share`` of documents with the largest sums is kept: a draw without replacement in proportion to
    the ratio, to the power of one over ``temperature`` (1: the ratio itself; larger ones draw more evenly). Ties at
    the boundary go to the smaller key; sums nearer to it than some 4096 steps of a double count as ties of one key.

    Documents without words have weight 0. Null keys are never a target but take part. Noise depends on key and text:
    rows with a null key draw apart, rows that repeat both are equal in all columns. Without a target document all weights are 0. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType
    wanted = target.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("w_key")).distinct()
    wanted = stage_table(wanted.orderBy(F.xxhash64("w_key"), "w_key").limit(target_rows), "target")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    drawn = rows.withColumn("noise", gumbel("key", "text", seed=seed))
    # Broadcast: at most target_rows numbers.
    labelled = rows.join(F.broadcast(wanted), F.col("key") == F.col("w_key"), "left")
    labelled = labelled.select("text", F.col("w_key").isNotNull().cast("long").alias("kind"))
    ratio = log_ratio(stage_table(ngram_counts(labelled, "text", "kind"), "ngrams"))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    schema = pa.schema([("key", pa.int64()), ("n_grams", pa.int64()), ("log_weight", pa.float64()), ("noise", pa.float64())])

    def weigh(piece: pa.RecordBatch) -> dict:
        hashes, sizes, weights = WordHashes(), [], []
        for t in piece.column("text").to_pylist():
            found = shared.value[ngram_buckets(t, hashes)]
            sizes.append(len(found))
            weights.append(float(found.sum()))
        return {"key": piece.column("key"), "n_grams": sizes, "log_weight": weights, "noise": piece.column("noise")}

    weighed = drawn.mapInArrow(mapped(weigh, "text", schema), "key long, n_grams long, log_weight double, noise double")
    weighed = weighed.withColumn("noisy", F.col("log_weight") / temperature + F.col("noise")).drop("noise")
    weighed = stage_table(weighed, "weights")
    limit, last_key = top_k_boundary(weighed, "noisy", "key", share)
    above = F.lit(False) if limit is None else (F.col("noisy") > limit) | ((F.col("noisy") == limit) & (F.coalesce("key", F.lit((1 << 63) - 1)) <= last_key))
    return weighed.withColumn("kept", above).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def top_k_boundary(df: DataFrame, value: str, key: str, share: float, fan: int = 4096) -> tuple[float | None, int]:
    """The value and key of the last of the ``share`` of rows with the largest values.

    Ranges of values are counted and the one with the boundary is cut again, until it holds one value; then
    the same for the keys of that value. Each pass sends at most ``fan`` counts to the driver.
    """
    total = df.count()
    k = min(total, round(share * total))
    if k == 0:
        return None, 0
    frame, order = df, F.col(value)
    low, high = frame.agg(F.min(order), F.max(order)).first()
    above = 0
    while low < high:
        width = (high - low) / fan
        if width <= 0 or low + width == low:
            break
        part = F.least(F.floor((F.col(value) - low) / width), F.lit(fan - 1))
        counts = {r["p"]: r for r in frame.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()}
        for p in sorted(counts, reverse=True):
            if above + counts[p]["n"] >= k:
                low, high = counts[p]["lo"], counts[p]["hi"]
                break
            above += counts[p]["n"]
        frame = df.filter(F.col(value).between(low, high))
    last = F.coalesce(F.col(key), F.lit((1 << 63) - 1))
    keys = df.filter(F.col(value) == low).select(last.alias("k"))
    need = k - above
    found = keys.groupBy("k").agg(F.count("*").alias("n")).orderBy("k")
    seen = 0
    for row in found.toLocalIterator():
        seen += row["n"]
        if seen >= need:
            return low, row["k"]
    return low, (1 << 63) - 1
