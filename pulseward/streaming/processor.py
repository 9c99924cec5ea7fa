"""Keyed per-patient risk state for Structured Streaming.

One ``StatefulProcessor`` keyed by ``patient_id`` (``transformWithStateInPandas``) keeps the running counts in a
``ValueState`` whose lifetime is 24 h of processing time, renewed on every write (expired state is never returned).
A patient's records of a micro-batch are put in arrival order and counted with numpy (``advance``):
  * event time below the current watermark -> a ``late`` row, state untouched;
  * otherwise a ``result`` row with the statistics after the record, the watermark and the processing time.
``processing_latency_ms`` is the time from the start of the micro-batch, before its records are parsed, until after the
patient's state has been written; the records of a patient in a micro-batch share it.
Risk levels are computed before the operator as column expressions. One patient's rows of a micro-batch are in memory
together; a micro-batch is bounded by the source's ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import STATE_SCHEMA

TTL_MS = 24 * 3600 * 1000

OUTPUT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("patient_id", T.LongType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("high_risk_count", T.LongType()),
    T.StructField("medium_risk_count", T.LongType()),
    T.StructField("low_risk_count", T.LongType()),
    T.StructField("high_risk_ratio", T.DoubleType()),
    T.StructField("last_activity", T.LongType()),
    T.StructField("state_age_seconds", T.DoubleType()),
    T.StructField("processing_timestamp", T.LongType()),
    T.StructField("processing_latency_ms", T.DoubleType()),
    T.StructField("watermark", T.LongType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("bmi", T.DoubleType()),
    T.StructField("medication_count", T.IntegerType()),
    T.StructField("length_of_stay", T.IntegerType()),
])
_NAMES = OUTPUT_SCHEMA.fieldNames()


def advance(frames: Iterator[pd.DataFrame], prev: tuple | None, now: int, watermark: int) -> tuple[dict, int, tuple | None]:
    """Output columns of one patient's rows, their number, and the state (total, high, medium, low, last activity,
    created) after them, None if every row is late. ``prev``: the state before."""
    parts = list(frames)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    cols = {c: pdf[c].to_numpy() for c in pdf.columns}
    order = np.lexsort((cols["seq"], cols["arrival_ms"]))       # arrival order
    cols = {c: v[order] for c, v in cols.items()}
    n = len(order)
    late = cols["event_time_ms"] < watermark
    acc = ~late
    base = prev[:4] if prev is not None else (0, 0, 0, 0)
    created = prev[5] if prev is not None else now
    level = cols["risk_level"]
    # running counts over accepted rows only (late rows get nulls)
    total = base[0] + np.cumsum(acc)
    high = base[1] + np.cumsum(acc & (level == "high"))
    medium = base[2] + np.cumsum(acc & (level == "medium"))
    low = base[3] + np.cumsum(acc & (level != "high") & (level != "medium"))

    def only_acc(values):
        out = values.astype(object)
        out[late] = None
        return out

    out = {c: cols[c] for c in ("seq", "patient_id", "arrival_ms", "age", "bmi", "medication_count", "length_of_stay")}
    out.update(kind=np.where(late, "late", "result"), record_id=cols["id"], risk_level=only_acc(level),
               total_records=only_acc(total), high_risk_count=only_acc(high), medium_risk_count=only_acc(medium),
               low_risk_count=only_acc(low), high_risk_ratio=only_acc(high / np.maximum(total, 1)),
               last_activity=only_acc(cols["timestamp"]),
               state_age_seconds=only_acc(np.full(n, (now - created) / 1000.0)),
               processing_timestamp=cols["event_time_ms"], watermark=np.full(n, watermark, dtype=np.int64))
    state = None
    if acc.any():
        last = np.flatnonzero(acc)[-1]
        state = (int(total[-1]), int(high[-1]), int(medium[-1]), int(low[-1]), int(cols["timestamp"][last]), int(created))
    return out, n, state


def output_frame(out: dict, n: int, started_ms: int) -> pd.DataFrame:
    """Call after the state has been written: the latency ends here."""
    spent = np.full(n, time.time() * 1000.0 - started_ms).astype(object)
    spent[out["kind"] == "late"] = None
    cols = {**out, "processing_latency_ms": spent}
    # absent columns are all-null object columns; present integer columns stay plain int64 (no nullable dtypes)
    return pd.DataFrame({name: cols[name] if name in cols else np.full(n, None, dtype=object) for name in _NAMES})


class PatientRiskProcessor(StatefulProcessor):
    def __init__(self, ttl_ms: int = TTL_MS):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("patient_risk", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        prev = self.state.get()   # None when absent or expired
        out, n, state = advance(rows, prev, now, timerValues.getCurrentWatermarkInMs())
        if state is not None:
            self.state.update(state)
        yield output_frame(out, n, now)

    def close(self) -> None:
        pass
