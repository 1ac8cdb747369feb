"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: let the adaptive planner split them even if it costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Scratch paths given out, by application.
_staged: dict[str, list[str]] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session; ``conf`` overrides the defaults (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Applications that have the package.
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of the session, once for an application.

    Functions that run in tasks are looked up by name there, so executors need the package wherever the driver was started.
    The archive is made in the driver's own temporary folder; Spark hands it to the executors.
    """
    application, root = spark.sparkContext.applicationId, Path(__file__).resolve().parent
    if application in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with ZipFile(archive, "w") as made:
        for module in sorted(root.rglob("*.py")):
            made.write(module, module.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    The folder must be reachable from the driver and every executor, so none is made up: without the setting
    a ``ValueError`` says what to set. ``remove_scratch`` deletes what a session has staged.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root.rstrip('/')}/tallyforge/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete every scratch path that this application was given; returns how many there were.

    Call it when no DataFrame that reads a staged table is needed any more.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
    return len(paths)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch area and return the written table.

    Used where several passes read one costly intermediate: the lineage is cut, so an executor
    lost later costs a re-read of files and not a recomputation from the source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
