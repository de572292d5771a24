"""Observed metrics of a stream as a table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, batch bigint, node string, metric string, value string"


class MetricsListener(StreamingQueryListener):
    """Appends the metrics that nodes observe in each batch to a catalog table.

    A row is (query, batch, node, metric, value); values are text. A batch that is run again
    after a failure reports again: of equal (query, batch, node, metric) any one row holds.
    """

    def __init__(self, spark: SparkSession, table: str, nodes: Collection[str] | None = None):
        self.spark, self.table, self.nodes = spark, table, nodes
        # Observed metrics have the names of nodes; None takes all.
        if not spark.catalog.tableExists(table):
            spark.createDataFrame([], SCHEMA).write.saveAsTable(table)

    def stop(self) -> None:
        """Waits for the reports of the batches so far, then listens no longer."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [
            (progress.name or str(progress.id), progress.batchId, node, metric, None if value is None else str(value))
            for node, observed in progress.observedMetrics.items()
            if self.nodes is None or node in self.nodes
            for metric, value in observed.asDict().items()
        ]
        if rows:
            # As many rows as there are metrics, whatever the batch.
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.insertInto(self.table)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
