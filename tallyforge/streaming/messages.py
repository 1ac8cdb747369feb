"""Keyed text messages: a broker topic or a growing folder in, text rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def broker_messages(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """One Kafka topic as an unbounded table with binary ``key`` and ``value``.

    Needs Spark's Kafka connector on the class path. ``per_trigger`` bounds a micro-batch.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(per_trigger))
    return reader.options(**options).load()


def folder_messages(
    spark: SparkSession, path: str, schema, key: str, value: str, files_per_trigger: int = 1_000
) -> DataFrame:
    """Parquet files arriving under ``path``, shaped like broker messages."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.selectExpr(
        f"CAST(CAST({key} AS STRING) AS BINARY) AS key", f"CAST(CAST({value} AS STRING) AS BINARY) AS value"
    )


def as_text(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def to_console(messages: DataFrame) -> StreamingQuery:
    """Print each micro-batch; caller awaits or stops the query."""
    return messages.writeStream.outputMode("append").format("console").start()


def to_parquet(messages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to a folder exactly once per message; ``once`` stops after what is there now."""
    writer = messages.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
