"""Rolling metrics of a live sample stream (A8, O2, A12-A14): bounded state, the batch operators on top.

A ``StatefulProcessor`` keeps three rings, the last ``n`` samples by ``seq`` of all, of the successful and of the batch
requests, as list states of at most ``n`` rows each, and the totals that A8 needs as a value state. After every
micro-batch it hands on the rings' rows; ``foreachBatch`` then applies the batch operators to these at most ``3 n`` rows,
so the figures after a micro-batch are those of the batch queries over all samples so far.

The rings are one key, since "the last 1,000 of all" is one group: one task per micro-batch reads its samples, in Arrow
batches of which only ``n`` rows are held; the source's limit per trigger bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import metrics
from .manifest import Table

SAMPLES = "seq long, ts_ms long, latency_ms double, ok boolean, is_batch boolean, batch_size long"
_COLUMNS = [x.split()[0] for x in SAMPLES.split(", ")]
RINGS = ("all", "ok", "batch")
OUTPUT = f"ring string, {SAMPLES}, total long, errors long, first_ms long, last_ms long"


def last_rows(held: pd.DataFrame, more: pd.DataFrame, n: int) -> pd.DataFrame:
    both = pd.concat([held, more], ignore_index=True) if len(held) else more
    return both.nlargest(n, "seq", keep="first")


class RingProcessor(StatefulProcessor):
    def __init__(self, n: int = metrics.LAST_N):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rings = {r: handle.getListState(f"ring_{r}", SAMPLES) for r in RINGS}
        self.totals = handle.getValueState("totals", "total long, errors long, first_ms long, last_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {r: pd.DataFrame([tuple(x) for x in self.rings[r].get()], columns=_COLUMNS) for r in RINGS}
        total, errors, first, last = self.totals.get() or (0, 0, None, None)
        for part in rows:
            part = part[_COLUMNS]
            total += len(part)
            errors += int((~part["ok"].astype(bool)).sum())
            low, high = int(part["ts_ms"].min()), int(part["ts_ms"].max())
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
            for r, more in zip(RINGS, (part, part[part["ok"].astype(bool)], part[part["is_batch"].astype(bool)])):
                held[r] = last_rows(held[r], more, self.n)
        self.totals.update((total, errors, first, last))
        for r in RINGS:
            if len(held[r]):
                self.rings[r].put([(int(a), int(b), float(c), bool(d), bool(e), int(f)) for a, b, c, d, e, f
                                   in held[r][_COLUMNS].itertuples(index=False)])
            yield held[r].assign(ring=r, total=total, errors=errors, first_ms=first, last_ms=last)[
                ["ring", *_COLUMNS, "total", "errors", "first_ms", "last_ms"]]

    def close(self) -> None:
        pass


def ring_stream(samples: DataFrame, n: int = metrics.LAST_N) -> DataFrame:
    """The rings' rows after every micro-batch of ``samples`` (the columns of ``SAMPLES``, none null)."""
    one = samples.select(F.lit(0).alias("key"), *_COLUMNS)
    return one.groupBy("key").transformWithStateInPandas(RingProcessor(n), OUTPUT, "Update", "None")


def rolling_tables(rings: DataFrame) -> dict[str, DataFrame]:
    """A8, A12, A13 and A14 from the rings' rows of one micro-batch."""
    ring = {r: rings.where(F.col("ring") == r).select(*_COLUMNS) for r in RINGS}
    totals = rings.where("ring = 'all'").agg(F.max("total").alias("total_requests"), F.max("errors").alias("errors"), (
        (F.max("last_ms") - F.min("first_ms")) / F.lit(1000.0)).alias("duration_s"))
    n = metrics.LAST_N
    return {"rolling_metrics": metrics.rolling_row(ring["all"], totals),
            "latency_index_pct": metrics.index_percentiles(ring["ok"], n),
            "latency_histogram": metrics.latency_histogram(ring["ok"], n),
            "batch_size_histogram": metrics.batch_size_histogram(ring["batch"], n)}


def start_rolling_query(samples: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """A table per figure under ``out_root``; the rows of a ``batch_id`` are the figures after that micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()   # at most 3 n rows
        try:
            batch.write.format("noop").mode("overwrite").save()   # the whole of it, whatever the operators read
            for name, rows in rolling_tables(batch).items():
                Table(batch.sparkSession, out_root, name).write(rows, batch_id)
        finally:
            batch.unpersist()

    from .jobs import configure
    configure(samples.sparkSession)
    return (ring_stream(samples).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
