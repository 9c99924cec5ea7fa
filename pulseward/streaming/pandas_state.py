"""Keyed per-patient risk state with ``applyInPandasWithState``.

Same rows as ``processor.PatientRiskProcessor``, by the same function on a patient's rows of a micro-batch
(``processor.advance``). State travels with the group's Arrow batch.

Lifetime (24 h of processing time, renewed only by writes): the state keeps the processing time of its last
write. A group that receives data after the lifetime has passed starts from zero; a group without data is
removed by the processing-time timeout, which is re-armed with the *remaining* lifetime whenever the group is
called without a write (Spark clears the timeout on every call).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from .processor import TTL_MS, advance, output_frame

PANDAS_STATE_SCHEMA = T.StructType([
    T.StructField("total_records", T.LongType()),
    T.StructField("high_risk_count", T.LongType()),
    T.StructField("medium_risk_count", T.LongType()),
    T.StructField("low_risk_count", T.LongType()),
    T.StructField("last_activity", T.LongType()),
    T.StructField("created_ms", T.LongType()),
    T.StructField("last_write_ms", T.LongType()),
])

def make_state_fn(ttl_ms: int = TTL_MS):
    def update(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        prev = state.get if state.exists else None
        if prev is not None and now - prev[6] >= ttl_ms:
            prev = None                                   # expired: never returned
        out, n, new = advance(frames, prev, now, state.getCurrentWatermarkMs())
        if new is not None:
            state.update((*new, int(now)))
            state.setTimeoutDuration(ttl_ms)
        elif prev is not None:
            state.setTimeoutDuration(max(1, prev[6] + ttl_ms - now))   # keep the original expiry
        elif state.exists:
            state.remove()
        yield output_frame(out, n, now)
    return update
