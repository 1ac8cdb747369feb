"""Whitening of integer vectors: the fit is weighted over distinct vectors, each of which is whitened once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import stage_table

#: A vector with more than this share of all rows (so a thousand at most) is sent to all tasks instead of joined by a shuffle.
HOT_SHARE = 0.001
#: Components with less than this share of the variance are rounding noise and are left out.
NOISE = 1e-12


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(rows: DataFrame, vector: str, weight: Column, kind: str) -> list:
    """Weighted sums of the entries by place; integers are summed as decimals, so exactly."""
    entries = rows.select(weight.alias("w"), F.posexplode(vector).alias("place", "x"))
    sums = entries.groupBy("place").agg(F.sum(F.col("x").cast(kind) * F.col("w").cast("decimal(18,0)" if kind != "double" else "double")).alias("s"))
    return [s for _, s in sorted(sums.toLocalIterator())]


def weighted_covariance(rows: DataFrame, vector: str, weight: Column, mean: np.ndarray, total: int) -> np.ndarray:
    """Covariance over the rows, divisor ``total``: entries are centred, then multiplied as matrices, a batch at a time.

    Each task sends one matrix, row by row, and Spark adds them up entry by entry; what comes to the driver is one
    matrix of dimension by dimension.
    """
    dims = len(mean)

    def multiply(batches):
        made = np.zeros((dims, dims))
        for batch in batches:
            centred = _matrix(batch.column("v"), dims) - mean
            made += (centred * batch.column("w").to_numpy()[:, None].astype(float)).T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(list(made), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.select(F.col(vector).alias("v"), weight.cast("long").alias("w")).mapInArrow(multiply, "i int, row array<double>")
    summed = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    found = np.zeros((dims, dims))
    for i, j, x in summed.toLocalIterator():
        found[i, j] = x
    return found / total


def whitened(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id", top: int = 4, scale: int = 256, by_count: bool = False
) -> DataFrame:
    """``key, component int, n long, deviation long, whitened, explained, identity_error`` (double) of every row and component.

    An entry ``c`` becomes the integer ``x = floor(scale * c)``. Equal vectors of integers are grouped; the covariance is
    that of the distinct ones, each with weight one or, with ``by_count``, its number of rows, and ``n`` the sum of the weights.
    With the sums ``S`` of the entries, ``deviation`` is the exact sum of ``(n * x - S)^2`` over the entries, null if a long
    cannot hold it. Components are unit eigenvectors by falling eigenvalue, their largest entry positive, ``top`` at most;
    ``whitened`` is ``x - S / n`` projected on one, over the root of its eigenvalue; ``explained`` its share of the
    variance; ``identity_error`` the largest entry of the covariance of all of them less the identity.

    Rows are dropped whose vector is null or empty, has a null or an entry that is not finite or whose integer a long cannot
    hold, or whose length is not the most frequent one (of equally frequent ones the greater). Directions without
    variance are no components, so equal rows alone, a single row and an empty table give no rows. Null and repeated
    keys are passed on; other columns are not read. Distinct vectors are whitened once and joined back; those of very
    many rows are sent to all tasks.
    """
    entries = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).alias("key"), entries.alias("c")).filter(F.col("c").isNotNull())
    # Not true for nulls, nor for what is not a number.
    rows = rows.filter(F.coalesce(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < float(1 << 63))), F.lit(False)))
    length = rows.filter(F.size("c") > 0).groupBy(F.size("c").alias("dims")).count().agg(F.max(F.struct("count", "dims"))["dims"]).first()[0]
    kept = rows.filter(F.size("c") == (length or -1)).select("key", F.transform("c", lambda c: F.floor(c * scale)).alias("x"))
    schema = f"{key} {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if length is None:
        return df.sparkSession.createDataFrame([], schema)
    distinct = stage_table(kept.groupBy("x").agg(F.count("*").alias("copies")), "vectors")
    weight = F.col("copies") if by_count else F.lit(1).cast("long")
    n, copies = distinct.agg(F.sum(weight), F.sum("copies")).first()
    sums = [int(s) for s in _sums(distinct, "x", weight, "decimal(20,0)")]
    mean = np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(weighted_covariance(distinct, "x", weight, mean, n))
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(values.sum())
    used = [k for k in range(min(top, length)) if values[k] > NOISE * trace]
    if not used:
        return df.sparkSession.createDataFrame([], schema)
    chosen = axes[:, used] * np.sign([axes[np.abs(axes[:, k]).argmax(), k] for k in used]) / np.sqrt(values[used])

    def project(batches):
        largest, exact = max(map(abs, sums)), np.array(sums, object)
        for batch in batches:
            x = _matrix(batch.column("x"), length)
            bound = n * int(np.abs(x.astype(float)).max(initial=0)) + largest
            # In machine integers where no sum can pass them, else in integers of any size.
            far = (n * x - exact.astype(np.int64)) if length * bound * bound < 1 << 62 else (n * x.astype(object) - exact)
            deviation = [int(d) if d < 1 << 63 else None for d in (far * far).sum(axis=1).tolist()]
            made = (x - mean) @ chosen
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("copies"), pa.array(deviation, pa.int64()), pa.array(list(made), pa.list_(pa.float64()))],
                names=["x", "copies", "deviation", "whitened"],
            )

    white = stage_table(distinct.mapInArrow(project, "x array<long>, copies long, deviation long, whitened array<double>"), "whitened")
    centre = np.array(_sums(white, "whitened", weight, "double")) / n
    identity_error = float(np.abs(weighted_covariance(white, "whitened", weight, centre, n) - np.eye(len(used))).max())
    shares = F.array(*[F.lit(float(values[k] / trace)) for k in used])
    # Broadcast: at most 1 / HOT_SHARE vectors.
    few = F.broadcast(white.filter(F.col("copies") > HOT_SHARE * copies).drop("copies"))
    near = kept.join(few, "x", "left")
    far = near.filter("whitened IS NULL").select("key", "x").join(white.drop("copies"), "x")
    both = near.filter("whitened IS NOT NULL").unionByName(far)
    shown = both.select("key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return shown.select(
        F.col("key").alias(key),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(int(n)).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )
