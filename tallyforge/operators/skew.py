"""Joins that deal out the rows of heavy keys, and of those only, after measuring which keys are heavy."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.memory import table_from_rows


@dataclass(frozen=True)
class HeavyKeys:
    """Hashes of heavy keys with their counts, each too low by at most ``rows * share / 4``, and the number of rows."""

    counts: dict[int, int]
    rows: int


def summary(batches, capacity: int):
    """Misra-Gries over the column ``key``: at most ``capacity`` counters at a time, and a row without key that counts all.

    A batch is counted as a whole and put to the counters; if they become too many, the largest that must go is
    subtracted from all, so a count is too low by at most the number of rows over ``capacity``.
    """
    keys, counts, rows = np.empty(0, np.int64), np.empty(0, np.int64), 0
    for batch in batches:
        found, times = np.unique(batch.column("key").to_numpy(zero_copy_only=False), return_counts=True)
        rows += batch.num_rows
        keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, times])).astype(np.int64)
        if len(keys) > capacity:
            counts -= np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
    yield pa.RecordBatch.from_arrays([pa.array([None, *keys.tolist()], pa.int64()), pa.array([rows, *counts.tolist()], pa.int64())], names=["key", "n"])


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> HeavyKeys:
    """The keys with more than ``share`` of the rows that have a key (and perhaps some with more than half of that).

    One scan of the key columns: every task sums its rows up in ``4 / share`` counters, which Spark adds up by
    key. At most ``2 / share`` counters come to the driver.
    """
    capacity = math.ceil(4 / share)
    known = df.filter(_known(keys)).select(F.xxhash64(*keys).alias("key"))
    parts = known.mapInArrow(lambda batches: summary(batches, capacity), "key long, n long")
    # Each task gives 4 / share rows at most.
    summed = parts.groupBy("key").agg(F.sum("n").alias("n"))
    rows = summed.filter("key IS NULL").select("n").first()
    if rows is None or not rows[0]:
        return HeavyKeys({}, 0)
    found = summed.filter(F.col("key").isNotNull() & (F.col("n") > 0.5 * share * rows[0])).collect()
    return HeavyKeys({r["key"]: r["n"] for r in found}, rows[0])


def _known(keys: Sequence[str]) -> Column:
    held = F.lit(True)
    for key in keys:
        held = held & F.col(key).isNotNull()
    return held


def join_measured(many: DataFrame, one: DataFrame, keys: str | Sequence[str], how: str = "inner", share: float | None = None) -> DataFrame:
    """Equi-join of ``many`` rows with ``one`` row or few for each key; ``how`` is inner, left or full.

    The heavy keys of ``many`` are measured first. Their rows are dealt to as many parts as their count asks for, by
    their values and by the task that holds them, so that equal rows are spread as well, and the rows of
    ``one`` with these keys are copied to each part. All other rows go once, as in a plain join; without a heavy key
    the plan is a plain join. Nothing depends on adaptive execution. ``share`` is what makes a key heavy, by default
    half of what a shuffle partition holds on average.

    Null keys meet nothing: rows of ``many`` with one skip the join, if they stay at all. Columns that both sides have
    besides the keys are refused. ``many`` is read twice, with columns other than the keys once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    shared = sorted(set(many.columns) & set(one.columns) - set(keys))
    if shared:
        raise ValueError(f"both sides have {', '.join(shared)}; rename one")
    if how not in ("inner", "left", "full"):
        raise ValueError(f"how is inner, left or full, not {how}")
    many, one = _same_types(many, one, keys)
    parts = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = share or 0.5 / parts
    heavy = heavy_keys(many, keys, share)
    keyed = many.filter(_known(keys))
    if heavy.counts:
        joined = _dealt(keyed, one, keys, how, heavy, parts)
    else:
        joined = keyed.join(one, keys, how)
    if how == "inner":
        return joined
    return joined.unionByName(many.filter(~_known(keys)), allowMissingColumns=True)


def _same_types(many: DataFrame, one: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Keys of both sides in the type that Spark would compare them in, as equal numbers of other types hash differently."""
    for key in keys:
        kinds = [df.schema[key].dataType for df in (many, one)]
        if kinds[0] != kinds[1]:
            common = many.sparkSession.range(0).select(F.coalesce(*[F.lit(None).cast(kind) for kind in kinds]).alias("x")).schema["x"].dataType
            many, one = (df.withColumn(key, F.col(key).cast(common)) for df in (many, one))
    return many, one


def _dealt(many: DataFrame, one: DataFrame, keys: list[str], how: str, heavy: HeavyKeys, parts: int) -> DataFrame:
    # Eight parts for each shuffle partition that the key would fill, so that the parts even out.
    copies = [(key, math.ceil(8 * parts * n / heavy.rows)) for key, n in heavy.counts.items()]
    # A local relation of at most 2 / share rows.
    table = table_from_rows(many.sparkSession, copies, "_hash long, _copies int")
    hashed = F.xxhash64(*keys)
    # The task's number, not its order of rows, so a task that runs again deals its rows the same way.
    own = F.shiftright(F.xxhash64(*many.columns), 1) + F.spark_partition_id()
    placed = many.withColumns({"_own": own, "_hash": hashed}).join(F.broadcast(table), "_hash", "left")
    placed = placed.withColumn("_salt", F.when(F.col("_copies").isNull(), 0).otherwise(F.pmod("_own", "_copies")).cast("int")).drop("_own", "_hash", "_copies")
    copied = one.withColumn("_hash", hashed).join(F.broadcast(table), "_hash", "left").withColumn("_one", F.lit(True))
    copied = copied.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    if how != "full":
        return placed.join(copied.drop("_hash", "_copies", "_one"), [*keys, "_salt"], how).drop("_salt")
    # Copies that meet no row tell nothing; entities with the hash of a heavy key are looked up among the heavy keys themselves.
    marked = placed.withColumn("_many", F.lit(True)).join(copied, [*keys, "_salt"], "full")
    met = marked.filter(F.col("_many") | F.col("_copies").isNull()).drop("_salt", "_many", "_one", "_hash", "_copies")
    few = many.withColumn("_hash", hashed).join(F.broadcast(table.select("_hash")), "_hash", "left_semi").select(*keys).distinct()
    alone = one.withColumn("_hash", hashed).join(F.broadcast(table.select("_hash")), "_hash", "left_semi").drop("_hash").join(few, keys, "left_anti")
    return met.unionByName(alone, allowMissingColumns=True)
