"""Alert rules evaluated over a metrics table ``(series, seq, ts_ms, value)`` (L1, L2).

L1 "condition held for a minimum time": consecutive points of a series where the condition holds form an
island; the alert fires at the first point whose distance to the island's first point is at least ``for``.
Islands are found without a per-series window, in one two-level scan (``island_points``): inside a range of the time
order windows give each point the start of its island, as far as the range shows it; one summary row per (key, range)
tells which island is open at the range's end, and the start of an island that began in an earlier range is joined
back. Every point knows its island's start, and islands are groups of an ordinary aggregation.

L2 "counter rate over 5 m > 0 held for 1 m": per point the increase since the previous point (a drop is a
counter reset, so the increase is the new value), summed over the trailing 300 s and divided by 300. This is
our windowed rate (no extrapolation). The previous point comes from the two-level scan. The rate is the same for all
points of one instant, so the increases are summed per instant first (a burst becomes one row), the trailing sum is a
``RANGE`` frame inside time ranges that hold copies of the 300 s before them, the islands are found on these rows, and
rate and state are joined back to the points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half
from ..staging import stage
from .scan import Running, chunked_running, with_overlap, with_ranges

EXACT = "decimal(28,9)"   # sums of increases are exact to 1e-9, in any order


@dataclass(frozen=True)
class ThresholdRule:
    alert: str
    series: str
    threshold: float
    for_ms: int
    severity: str


# The alert rules (series names are those of the metric fixture).
THRESHOLD_RULES = [
    ThresholdRule("HighMedicalProcessingLatency", "latency_p99_ms", 30.0, 60_000, "critical"),
    ThresholdRule("HighMedicalBackpressure", "backpressured", 0.0, 60_000, "warning"),
    ThresholdRule("HighKafkaLagMedical", "kafka_lag", 1000.0, 180_000, "warning"),
]
# Quality limits that live query progress can check directly (series of streaming.progress).
PROGRESS_RULES = [
    ThresholdRule("SlowCheckpoint", "checkpoint_ms", 30_000.0, 0, "warning"),
    ThresholdRule("SlowMicroBatch", "batch_duration_ms", 30_000.0, 60_000, "warning"),
]
COUNTER_RULE = ("MedicalCheckpointFailures", "failed_checkpoints", 300_000, 60_000, "critical")


def _with_rules(series: DataFrame, rules: list[ThresholdRule]) -> DataFrame:
    """A row per point and rule of its series; the rules are part of the expression, so nothing is joined."""
    each = [F.lit(None).cast("struct<alert:string,threshold:double,for_ms:bigint,severity:string>")] + [F.when(F.col("series") == r.series, F.struct(
        F.lit(r.alert).alias("alert"), F.lit(float(r.threshold)).alias("threshold"),
        F.lit(int(r.for_ms)).cast("long").alias("for_ms"), F.lit(r.severity).alias("severity"))) for r in rules]
    return series.withColumn("_rule", F.explode(F.array_compact(F.array(*each)))).select(*series.columns, "_rule.*")


def island_points(points: DataFrame, cond: F.Column, keys: list[str]) -> DataFrame:
    """All points with ``_hold`` and, for points where ``cond`` holds, ``_island``: (ts_ms, seq) of the first point of
    their island (per ``keys``, ordered by ts_ms, seq). ``points`` may have ranges ``_range`` already. The points are
    shuffled once, on (keys, range); the other exchanges move a row per (key, range)."""
    if "_range" not in points.columns:
        points = with_ranges(points, "ts_ms", "seq")
    part, at = [*keys, "_range"], F.struct("ts_ms", "seq")
    w = Window.partitionBy(*part).orderBy("ts_ms", "seq")
    local = points.withColumn("_hold", F.coalesce(cond, F.lit(False)))
    local = local.withColumns({"_before": F.coalesce(F.lag("_hold").over(w), F.lit(False)), "_first": F.first(at).over(w)})
    local = local.withColumn("_start", F.max(F.when(F.col("_hold") & ~F.col("_before"), at)).over(w))
    # per range: whether all its points hold, its first point, and the start of the island open at its end
    ranges = local.groupBy(*part).agg(F.bool_and("_hold").alias("_all"), F.min("_first").alias("_first"),
                                      F.max_by(F.struct(F.when(F.col("_hold"), F.col("_start")).alias("s")), at).alias("_open"))
    wk = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({
        "_cut": F.last(F.when(~F.col("_all"), F.col("_open")), ignorenulls=True).over(wk),    # of the last range not all held
        "_cuts": F.coalesce(F.count_if(~F.col("_all")).over(wk), F.lit(0))})
    wg = Window.partitionBy(*keys, "_cuts").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    since = F.min(F.when(F.col("_all"), F.col("_first"))).over(wg)                            # all held from there on
    carry = ranges.withColumn("_carry", F.coalesce("_cut.s", since)).select(*part, "_carry")
    mine = F.when(F.col("_start") == F.col("_first"), F.coalesce("_carry", "_start")).otherwise(F.col("_start"))
    return (local.join(carry, part).withColumn("_island", F.when(F.col("_hold"), mine))
            .drop("_before", "_first", "_start", "_carry", "_range"))


def held_islands(points: DataFrame, cond: F.Column, for_ms, keys: list[str]) -> DataFrame:
    """One row per island that fires: start, first firing point, end, size, maximum value."""
    start = F.col("_island.ts_ms")
    need = start + (F.lit(for_ms) if isinstance(for_ms, int) else for_ms)
    out = island_points(points, cond, keys).filter(F.col("_hold")).groupBy(*keys, "_island").agg(
        F.max("ts_ms").alias("island_end_ms"), F.count(F.lit(1)).alias("n_points"), F.max("value").alias("max_value"),
        F.min(F.when(F.col("ts_ms") >= need, F.col("ts_ms"))).alias("firing_since_ms"))
    return out.filter(F.col("firing_since_ms").isNotNull()).withColumn("island_start_ms", start).drop("_island")


def threshold_alerts(series: DataFrame, rules: list[ThresholdRule] = THRESHOLD_RULES) -> DataFrame:
    """L1: one row per firing island per rule."""
    pts = _with_rules(series, rules)
    out = held_islands(pts, F.col("value") > F.col("threshold"), F.col("for_ms"),
                       ["alert", "series", "severity", "for_ms"])
    return out.select("alert", "series", "severity", "island_start_ms", "firing_since_ms", "island_end_ms",
                      "n_points", "max_value")


def trailing_by_time(points: DataFrame, keys: list[str], col: str, range_ms: int) -> DataFrame:
    """(keys, ts_ms, <col>_sum, _range) per instant that a key has points at: the sum of ``col`` over its points with
    ts in (ts - range_ms, ts]. Sums per instant are stored first, so the frame runs over one row per instant."""
    at = stage(points.groupBy(*keys, "ts_ms").agg(F.sum(F.col(col).cast(EXACT)).alias("_s")), "sums_per_instant")
    w = Window.partitionBy(*keys, "_range").orderBy("ts_ms").rangeBetween(-(range_ms - 1), 0)
    total = F.coalesce(F.sum("_s").over(w), F.lit(0)).cast("double")
    return with_overlap(at, "ts_ms", range_ms).withColumn(f"{col}_sum", total).filter("_own").drop("_s", "_own")


def trailing_sum(points: DataFrame, keys: list[str], col: str, range_ms: int) -> DataFrame:
    """Per point, ``<col>_sum`` = sum of ``col`` over points of the same key with ts in (ts - range_ms, ts]; null for
    points without a key or time. The join is on (keys, ts_ms), where AQE splits the points of a burst."""
    return points.join(trailing_by_time(points, keys, col, range_ms).drop("_range"), [*keys, "ts_ms"], "left")


def counter_rate(series: DataFrame, name: str = COUNTER_RULE[1], range_ms: int = COUNTER_RULE[2],
                 for_ms: int = COUNTER_RULE[3]) -> DataFrame:
    """L2: per point of a counter series: increase, rate over the trailing ``range_ms``, alert state. Points without a
    time have none of these and are left out."""
    pts = series.filter((F.col("series") == name) & F.col("ts_ms").isNotNull())
    prev = chunked_running(with_ranges(pts, "ts_ms", "seq"), ["series"], None, ["ts_ms", "seq"],
                           [Running("_prev", "prev", F.col("value"))], chunk_name="_range").drop("_range")
    p = F.col("_prev")
    inc = (F.when(p.isNull(), F.lit(0.0)).when(F.col("value") >= p, F.col("value") - p)
            .otherwise(F.col("value")))
    # stored once: read for the sums per instant and for the result
    points = stage(prev.withColumn("increase", inc).drop("_prev"), "counter_increase")
    rated = trailing_by_time(points, ["series"], "increase", range_ms).withColumn("seq", F.lit(0))
    rated = rated.withColumn("rate", F.col("increase_sum") / F.lit(range_ms / 1000.0))
    marked = island_points(rated, F.col("rate") > 0, ["series"])
    firing = F.col("_hold") & (F.col("ts_ms") >= F.col("_island.ts_ms") + F.lit(for_ms))
    state = marked.select("series", "ts_ms", "rate", F.coalesce(firing, F.lit(False)).alias("firing"))
    return points.join(state, ["series", "ts_ms"]).select(
        "seq", "ts_ms", F.col("value").alias("counter"), "increase", round_half("rate", 9).alias("rate_5m"),
        (F.col("rate") > 0).alias("above"), "firing")
