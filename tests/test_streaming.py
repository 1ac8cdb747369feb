from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.partitions import PartitionedTable, added
from tallyforge.streaming import messages, upserts


def _incoming(spark, folder):
    return messages.folder_messages(spark, str(folder), "id bigint, body string", "id", "body", files_per_trigger=1)


def test_messages_arrive_once_and_progress_is_kept(spark, tmp_path, rows):
    source, sink, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    spark.createDataFrame([(1, "a"), (2, "é")], "id bigint, body string").repartition(2).write.parquet(str(source))
    incoming = _incoming(spark, source)
    assert incoming.isStreaming and dict(incoming.dtypes) == {"key": "binary", "value": "binary"}
    messages.to_parquet(messages.as_text(incoming), sink, progress, once=True).awaitTermination()
    assert rows(spark.read.parquet(sink)) == [("1", "a"), ("2", "é")]

    spark.createDataFrame([(3, None)], "id bigint, body string").write.mode("append").parquet(str(source))
    messages.to_parquet(messages.as_text(_incoming(spark, source)), sink, progress, once=True).awaitTermination()
    assert rows(spark.read.parquet(sink)) == [("1", "a"), ("2", "é"), ("3", None)]


def test_console_sink_runs_until_stopped(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(1, "a")], "id bigint, body string").write.parquet(str(source))
    query = messages.to_console(messages.as_text(_incoming(spark, source)))
    try:
        query.processAllAvailable()
        assert query.isActive
        assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    finally:
        query.stop()
    assert not query.isActive


def test_broker_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.broker_messages(spark, "localhost:9092", "test", per_trigger=100)


def test_a_stream_upserts_each_batch_once(spark, tmp_path, rows):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    table = PartitionedTable(spark, str(tmp_path / "totals"), "kind string, n long, day string")
    merge, listener = added(["kind", "day"], ["n"]), upserts.Progress()
    schema = "id long, kind string, day string"

    def counted(batch):
        return batch.groupBy("kind", "day").agg(F.count("*").alias("n"))

    def run():
        upserts.into_table(spark.readStream.schema(schema).parquet(source), table, counted, merge, progress, once=True).awaitTermination()

    spark.streams.addListener(listener)
    try:
        spark.createDataFrame([(1, "a", "d1"), (2, "a", "d1"), (3, None, "d2")], schema).coalesce(1).write.parquet(source)
        run()
        assert rows(table.rows(), "kind", "n", "day") == [(None, 1, "d2"), ("a", 2, "d1")]
        more = spark.createDataFrame([(4, "a", "d1"), (5, "b", "d3")], schema).coalesce(1)
        more.write.mode("append").parquet(source)
        run()
        run()  # nothing has arrived
    finally:
        spark.streams.removeListener(listener)
    expected = [(None, 1, "d2"), ("a", 3, "d1"), ("b", 1, "d3")]
    assert rows(table.rows(), "kind", "n", "day") == expected
    # The same batch once more, as after a failure between the change and the note of the stream.
    assert table.change(counted(more), merge, name="batch-1") is False
    assert rows(table.rows(), "kind", "n", "day") == expected
    # The progress of the stream is lost together with its last batch: it is given again and changes nothing.
    import shutil

    shutil.rmtree(f"{progress}/commits")
    run()
    assert rows(table.rows(), "kind", "n", "day") == expected
    assert not listener.failures
