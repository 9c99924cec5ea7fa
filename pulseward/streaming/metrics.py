"""Per-stage latency reports as a streaming tumbling-window aggregation (A11 in stream form).

A report per (stage, window) is emitted once, when the watermark passes the end of the window (append mode);
its state is then dropped -- the "report and clear" of the batch definition. The state is a mergeable quantile sketch, so a
busy stage doesn't grow it (up to 10,000 samples the p95 is a sample's exact value). Samples later than the
watermark delay are not counted (Spark's late-data rule for windowed aggregations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_WINDOW = "1 hour"
SAMPLE_DELAY = "10 minutes"
ACCURACY = 10_000      # the state of a window is a sketch of this many entries at most; ranks are right to 1/10,000


def stage_report_stream(samples: DataFrame, window: str = REPORT_WINDOW, delay: str = SAMPLE_DELAY) -> DataFrame:
    """(stage, window_start_ms, avg_ms, p95_ms, count) from a stream of (stage, ts_ms, latency_ms)."""
    timed = samples.withColumn("ts", F.timestamp_millis(F.col("ts_ms"))).withWatermark("ts", delay)
    agg = timed.groupBy(F.window("ts", window).alias("w"), "stage").agg(
        F.avg("latency_ms").alias("avg_ms"), F.approx_percentile("latency_ms", 0.95, ACCURACY).alias("p95_ms"),
        F.count(F.lit(1)).alias("count"))
    return agg.select("stage", F.unix_millis(F.col("w.start")).alias("window_start_ms"), "avg_ms", "p95_ms", "count")
