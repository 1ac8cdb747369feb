"""Changes to a partitioned Parquet table that rewrite only the partitions they touch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.upsert import latest_per_key
from tallyforge.session import stage_table

Merge = Callable[[DataFrame, DataFrame], DataFrame]
#: Readers of the table do not see folders that begin like this.
_PENDING, _DONE = "_pending", "_done"


def keyed(keys: Sequence[str], version: str | None = None) -> Merge:
    """Rows of the changes replace those with their key; as with a unique constraint, null keys equal nothing."""

    def merge(current: DataFrame, changes: DataFrame) -> DataFrame:
        latest = latest_per_key(changes, keys, version)
        return current.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest)

    return merge


def added(keys: Sequence[str], values: Sequence[str]) -> Merge:
    """Values of the changes are added to those of their key; nulls count as nothing, null keys are one key."""

    def merge(current: DataFrame, changes: DataFrame) -> DataFrame:
        return current.unionByName(changes).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values]).select(*current.columns)

    return merge


class PartitionedTable:
    """A Parquet folder with one sub-folder for each value of ``by``.

    A change is worked out for the touched partitions alone and written whole below the table, where readers do not see
    it; only then are these partitions replaced. Files of other partitions are not touched. If the job dies before the
    change is whole, nothing has happened; if it dies later, ``recover`` (which every change begins with) replaces the
    partitions again from what was written. One writer at a time. The rows of each partition are dealt to at
    most ``files`` tasks and files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, by: str = "day", files: int = 1):
        self.spark, self.path, self.by, self.files = spark, path.rstrip("/"), by, files
        struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.schema = T.StructType([f for f in struct if f.name != by] + [struct[by]])

    def rows(self) -> DataFrame:
        """The table; without a folder it is empty."""
        if not self._exists(self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)

    def change(self, changes: DataFrame, merge: Merge, name: str | None = None) -> bool:
        """Put the changes in; whether anything was done.

        A ``name`` makes the change happen once: it is noted in the table, and later changes of the same name are skipped.
        The values of ``by`` in the changes come to the driver, one for each touched partition; null is one of them.
        """
        self.recover()
        if name and self._exists(f"{self.path}/{_DONE}/{name}"):
            return False
        stored = stage_table(changes.select(*self.schema.names), "partition-changes")
        values = [r[0] for r in stored.select(self.by).distinct().collect()]
        known = [v for v in values if v is not None]
        touched = F.col(self.by).isin(known) if known else F.lit(False)
        if None in values:
            touched = touched | F.col(self.by).isNull()
        made = merge(self.rows().filter(touched), stored).select(*self.schema.names)
        # The name of a change that has none is its own.
        pending = f"{self.path}/{_PENDING}/{name or uuid.uuid4().hex}"
        made.write.mode("overwrite").parquet(pending)
        self._apply(pending)
        return True

    def recover(self) -> int:
        """Finish changes that were written whole, drop others; returns how many were finished."""
        finished = 0
        for pending in self._children(f"{self.path}/{_PENDING}"):
            if self._exists(f"{pending}/_SUCCESS"):
                self._apply(pending)
                finished += 1
            else:
                self._delete(pending)
        return finished

    def _apply(self, pending: str) -> None:
        made = self.spark.read.schema(self.schema).parquet(pending)
        dealt = made.repartition(F.col(self.by), F.pmod(F.xxhash64(*made.columns), F.lit(self.files)))
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by)
        writer.parquet(self.path)
        self._create(f"{self.path}/{_DONE}/{pending.rsplit('/', 1)[1]}")
        self._delete(pending)

    def _file(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        found, system = self._file(path)
        return system.exists(found)

    def _children(self, path: str) -> list[str]:
        found, system = self._file(path)
        return sorted(s.getPath().toString() for s in system.listStatus(found)) if system.exists(found) else []

    def _create(self, path: str) -> None:
        found, system = self._file(path)
        system.create(found, True).close()

    def _delete(self, path: str) -> None:
        found, system = self._file(path)
        system.delete(found, True)
