"""Counters of running streams, one small file per micro-batch in a folder.

A listener writes them as Spark reports them, so they are there while the stream runs and
after it has ended, and can be read as a table.  Metrics of ``observe`` come along.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from rolehabit.sources.folders import write_text

PROGRESS = (
    "query string, name string, batch_id bigint, input_rows bigint, late_rows bigint, "
    "state_rows bigint, watermark string, observed map<string, string>"
)


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of all queries of a session below ``folder``.

    A repeated micro-batch replaces its file.  ``late_rows`` counts the rows that steps
    dropping repeats found older than the watermark (see ``streaming.late``).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        found = event.progress
        operators = found.stateOperators
        row = {
            "query": str(found.id),
            "name": found.name,
            "batch_id": found.batchId,
            "input_rows": found.numInputRows,
            "late_rows": sum(o.numRowsDroppedByWatermark for o in operators if o.operatorName.startswith("dedupe")),
            "state_rows": sum(o.numRowsTotal for o in operators),
            "watermark": found.eventTime.get("watermark"),
            "observed": {f"{name}.{key}": str(value) for name, metrics in found.observedMetrics.items() for key, value in metrics.asDict().items()},
        }
        write_text(self.spark, f"{self.folder}/{found.id}-{found.batchId:010d}.json", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for a query to end and its last counters to be written."""
        query.awaitTermination()
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} reported")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(self.folder)
