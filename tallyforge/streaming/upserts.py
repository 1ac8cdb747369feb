"""A stream that keeps totals in a partitioned table, each micro-batch exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallyforge.operators.partitions import Merge, PartitionedTable


def into_table(
    stream: DataFrame, table: PartitionedTable, prepare: Callable[[DataFrame], DataFrame], merge: Merge, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Put ``prepare(batch)`` of every micro-batch into the table; ``once`` stops after what is there now.

    The number of the batch is the name of the change. A batch that is given again after a failure is known by it and
    changes nothing, so totals do not count it twice. A checkpoint belongs to one table.
    """

    def put(batch: DataFrame, number: int) -> None:
        table.change(prepare(batch), merge, name=f"batch-{number}")

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(put)
    return (writer.trigger(availableNow=True) if once else writer).start()


class Progress(StreamingQueryListener):
    """``batches``: query name, number and rows of every micro-batch with rows; ``failures``: what ended queries in error."""

    def __init__(self) -> None:
        self.batches: list[tuple[str | None, int, int]] = []
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress
        if found.numInputRows:
            self.batches.append((found.name, found.batchId, found.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)
