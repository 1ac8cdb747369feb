"""Parquet tables kept side by side in one base folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Attribute access to ``<base>/<name>.parquet``: ``Tables(spark, base).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.base}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """Path for a file stream: a glob, so a single file and a folder of part files both work."""
        return f"{self.base}/[{name[0]}]{name[1:]}.parquet"
