"""Streaming progress as a metric table for the alert and quality operators (input of L1-L3).

``ProgressMetrics`` is a ``StreamingQueryListener``: every progress event (one per micro-batch, driver-side
metadata, not data) becomes a few rows ``(series, seq, ts_ms, value)``:

  batch_duration_ms      trigger execution time of the micro-batch
  checkpoint_ms          time spent writing the offset log and the commit log (the query checkpoint)
  input_rows             rows read by the micro-batch
  input_rows_per_second  processed rows per second
  state_rows             rows in the state store (first stateful operator)
  late_rows_dropped      rows dropped by the watermark (first stateful operator)

``frame(spark)`` returns the rows collected so far as a DataFrame; ``append_to(spark, path)`` appends and
clears them, so a long-running job keeps the driver's list short. The launcher registers the listener, appends about
every two seconds and runs the alert rules (``live_alerts``) on the table as a stream.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, series string, seq long, ts_ms long, value double"


def _ts_ms(text: str) -> int:
    return int(datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc).timestamp() * 1000)


class ProgressMetrics(StreamingQueryListener):
    """``skip``: names of queries whose progress isn't a metric (the one that reads the metrics)."""

    def __init__(self, skip: tuple[str, ...] = ()):
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._skip = skip

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name in self._skip:
            return
        ts, seq, q = _ts_ms(p.timestamp), int(p.batchId), p.name or str(p.id)
        values = {"batch_duration_ms": float(p.durationMs.get("triggerExecution", 0)),
                  "checkpoint_ms": float(p.durationMs.get("walCommit", 0) + p.durationMs.get("commitOffsets", 0)),
                  "input_rows": float(p.numInputRows),
                  "input_rows_per_second": float(p.processedRowsPerSecond or 0.0)}
        if p.stateOperators:
            op = p.stateOperators[0]
            values["state_rows"] = float(op.numRowsTotal)
            values["late_rows_dropped"] = float(op.numRowsDroppedByWatermark)
        with self._lock:
            self._rows.extend((q, name, seq, ts, v) for name, v in values.items())

    def frame(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self._rows)
        return spark.createDataFrame(rows, SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> int:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)
        return len(rows)
