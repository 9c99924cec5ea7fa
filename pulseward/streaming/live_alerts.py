"""Alert rules on a live metric stream (L1, L2): event-time state with timers.

Points ``(series, seq, ts_ms, value)`` are joined with the rules and keyed by rule. A key's points wait until the
watermark has passed them and are then applied in order of (ts_ms, seq), so the result doesn't depend on their arrival
within the watermark's delay (points beyond it are dropped by Spark and counted in its progress). A value counts until
the next point: a condition that has held for ``for_ms`` fires when the watermark passes that time, by a timer, with
or without a new point.

L2 keeps what a counter rule needs: the last value (a smaller one is a reset, so the increase is the new value) and
the increases of the trailing ``range_ms``, one entry per timestamp; older ones are dropped.

Rows: ``kind`` 'firing' once an island of held points has lasted ``for_ms``, 'resolved' at its end.
``firing_point_ms`` is the first point that came ``for_ms`` or more after the island's start (null if the island ended
before one): the resolved islands that have it are the rows of the batch operator ``alerts.threshold_alerts``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.alerts import COUNTER_RULE, PROGRESS_RULES, THRESHOLD_RULES, ThresholdRule
from .manifest import Table

OUTPUT = ("alert string, series string, severity string, kind string, island_start_ms long, firing_since_ms long, "
          "firing_point_ms long, island_end_ms long, n_points long, max_value double")
_NAMES = [x.split()[0] for x in OUTPUT.split(", ")]
_KEY = ("alert", "series", "severity", "threshold", "for_ms", "range_ms")
POINTS = "series string, seq long, ts_ms long, value double"


@dataclass
class Island:
    """State of a rule. ``start`` is null while the condition doesn't hold."""
    start: int | None = None
    end: int | None = None
    n: int = 0
    top: float = 0.0
    point: int | None = None
    fired: bool = False
    prev: float | None = None


_ISLAND = "start long, end long, n long, top double, point long, fired boolean, prev double"


def advance(island: Island, window: dict[int, float], points: list[tuple], until: int, threshold: float, for_ms: int,
            range_ms: int | None) -> list[tuple]:
    """Applies ``points`` (ts, seq, value; in order, all before ``until``) and the time up to ``until`` to a rule's
    state; (kind, start, firing since, first firing point, end, points, maximum) of what fires and ends."""
    out = []

    def row(kind: str) -> None:
        out.append((kind, island.start, island.start + for_ms, island.point, island.end, island.n, island.top))

    i = 0
    while i < len(points):
        ts = points[i][0]
        same = [v for t, _, v in points[i:i + 1]]
        while i + len(same) < len(points) and points[i + len(same)][0] == ts:
            same.append(points[i + len(same)][2])
        i += len(same)
        if island.start is not None and not island.fired and island.start + for_ms < ts:
            island.fired = True
            row("firing")
        values = same
        if range_ms is not None:
            for v in same:
                if island.prev is not None:
                    window[ts] = window.get(ts, 0.0) + (v - island.prev if v >= island.prev else v)
                island.prev = v
            for old in [t for t in window if t <= ts - range_ms]:
                del window[old]
            values = [sum(window.values()) / (range_ms / 1000.0)] * len(same)
        for v in values:
            if v is not None and v > threshold:
                if island.start is None:
                    island.start, island.n, island.top, island.point, island.fired = ts, 0, v, None, False
                island.end, island.n, island.top = ts, island.n + 1, max(island.top, v)
                if ts >= island.start + for_ms:
                    island.point = ts if island.point is None else island.point
                    if not island.fired:
                        island.fired = True
                        row("firing")
            elif island.start is not None:
                if island.fired:
                    row("resolved")
                island.start = None
    if island.start is not None and not island.fired and island.start + for_ms < until:
        island.fired = True
        row("firing")
    return out


class AlertProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.island = handle.getValueState("island", _ISLAND)
        self.waiting = handle.getListState("waiting", "ts long, seq long, value double")
        self.window = handle.getListState("window", "ts long, increase double")

    def _apply(self, key, fresh: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        alert, series, severity, threshold, for_ms, range_ms = key
        range_ms = int(range_ms) or None
        every = sorted([*(tuple(x) for x in self.waiting.get()), *fresh], key=lambda x: (x[0], x[1]))
        ready = [x for x in every if x[0] < watermark]
        later = every[len(ready):]
        held = self.island.get()
        island = Island(*held) if held is not None else Island()
        window = {int(t): float(v) for t, v in self.window.get()} if range_ms else {}
        out = advance(island, window, ready, watermark, threshold, int(for_ms), range_ms)
        self.island.update((island.start, island.end, island.n, island.top, island.point, island.fired, island.prev))
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(later[0][0] + 1)
        else:
            self.waiting.clear()
        if range_ms:
            if window:
                self.window.put(sorted(window.items()))
            else:
                self.window.clear()
        if island.start is not None and not island.fired:
            self.handle.registerTimer(int(island.start + for_ms + 1))
        if out:
            yield pd.DataFrame([(alert, series, severity, *x) for x in out], columns=_NAMES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [(int(t), int(s), float(v)) for part in rows for t, s, v in zip(part["ts_ms"], part["seq"], part["value"])]
        yield from self._apply(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._apply(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _rules(spark, threshold_rules: list[ThresholdRule], counter_rules: list[tuple]) -> DataFrame:
    rows = [(r.alert, r.series, r.severity, float(r.threshold), int(r.for_ms), 0) for r in threshold_rules]
    rows += [(alert, series, severity, 0.0, for_ms, range_ms) for alert, series, range_ms, for_ms, severity in counter_rules]
    return spark.createDataFrame(rows, "alert string, series string, severity string, threshold double, for_ms long, range_ms long")


def alert_stream(points: DataFrame, threshold_rules: list[ThresholdRule] | None = None,
                 counter_rules: list[tuple] | None = None, delay: str = "10 seconds") -> DataFrame:
    """Rows of ``OUTPUT`` for a stream of ``points``. The rules are a list in the program, so their side is small."""
    threshold_rules = [*THRESHOLD_RULES, *PROGRESS_RULES] if threshold_rules is None else threshold_rules
    counter_rules = [COUNTER_RULE] if counter_rules is None else counter_rules
    timed = points.where("value is not null and ts_ms is not null").withColumn(
        "event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", delay)
    ruled = timed.join(F.broadcast(_rules(points.sparkSession, threshold_rules, counter_rules)), "series")
    return ruled.groupBy(*_KEY).transformWithStateInPandas(AlertProcessor(), OUTPUT, "Append", "EventTime")


def metric_source(spark, path: str) -> DataFrame:
    """The metric table that ``progress.ProgressMetrics`` appends to, as a stream."""
    return spark.readStream.schema("query string, " + POINTS).parquet(path)


def start_alert_query(points: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None,
                      name: str = "alerts", **rules) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        Table(batch.sparkSession, out_root, "alerts").write(batch, batch_id)

    from .jobs import configure
    configure(points.sparkSession)
    return (alert_stream(points, **rules).writeStream.outputMode("append").queryName(name).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
