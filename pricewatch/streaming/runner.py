"""Starting, draining and watching streaming queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = "2 minutes") -> StreamingQuery:
    """Start with a processing-time trigger, or with ``every=None`` read what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available, commit, return."""
    start(writer, checkpoint, every=None).awaitTermination()


def stop_all(spark: SparkSession) -> None:
    """Finish the data already received, then stop every query."""
    for query in spark.streams.active:
        query.processAllAvailable()
        query.stop()


class ProgressLog(StreamingQueryListener):
    """Keeps the latest statistics of every query: rows, rates and observed metrics."""

    def __init__(self) -> None:
        self.latest: dict[str, dict[str, object]] = {}
        self.total_rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.total_rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        key = str(p.id)
        self.total_rows[key] = self.total_rows.get(key, 0) + p.numInputRows
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.latest[key] = {"batch": p.batchId, "rows": p.numInputRows, "rate": p.processedRowsPerSecond, **observed}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
