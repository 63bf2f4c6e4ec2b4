"""Progress of streaming queries as a table.

The engine keeps a query's last hundred updates only. ``ProgressLog`` is a
listener that takes every update as it comes and appends them to a Parquet
table, a few at a time, so neither a long run nor a short one loses any.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("run_id string, batch_id bigint, at string, input_rows bigint, input_rows_per_sec double, rows_per_sec double, duration_ms bigint, "
          "state_rows bigint, state_bytes bigint, dropped_rows bigint, watermark string")
FLUSH = 64                       # updates in one file


class ProgressLog(StreamingQueryListener):
    """``with ProgressLog(spark, path) as log: ...``; ``log.read()`` afterwards."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Condition(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
               int(p.durationMs.get("triggerExecution", 0)), sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state),
               sum(s.numRowsDroppedByWatermark for s in state), (p.eventTime or {}).get("watermark"))
        with self.lock:
            self.rows.append(row)
            if len(self.rows) >= FLUSH:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.runId))
            self.lock.notify_all()

    def _flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until all updates of a finished query are here: the listener hears of them after the query's end."""
        with self.lock:
            if not self.lock.wait_for(lambda: run_id in self.ended, seconds):
                raise TimeoutError(f"no end of query run {run_id} after {seconds} s")

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        with self.lock:
            self._flush()

    def read(self) -> DataFrame:
        """A row per update: batch, rows, rates, duration, state, rows dropped as late."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)
