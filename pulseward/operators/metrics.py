"""Latency and request metrics over a table of samples.

Input: ``metric_samples(seq, stage, ts_ms, latency_ms, ok, batch_size, is_batch)``. Percentiles over all samples, or over
two runs, are selected by histogram refinement (``selected_percentiles``), those per stage and window use
``exact_percentiles``; "last 1,000" metrics first take the top 1,000 by ``seq`` (a per-partition top-k, so at most
partitions x 1,000 rows move) and then aggregate that bounded set. One-row results of two
different aggregations are combined by a union and a second aggregation, not by a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, exact_mean_parts, round_half
from .percentiles import exact_percentiles, selected_percentiles

PCTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
LAST_N = 1000
SLA_P99_MS = 30.0
FAILED_CALL_MS = 1000.0
REPORT_WINDOW_MS = 3_600_000   # tumbling report window; epoch-aligned, time-zone independent
# Histogram bucket bounds (latency in seconds; batch sizes) and their labels.
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0]
BATCH_BUCKETS = [1, 5, 10, 20, 50, 100]


def safe_div(a, b):
    """a / b, null when b is 0 (ANSI mode raises on division by zero)."""
    b = F.col(b) if isinstance(b, str) else b
    a = F.col(a) if isinstance(a, str) else a
    return F.when(b != 0, a / b)


def _one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row (union + max, no join)."""
    cols = [c for f in frames for c in f.columns]
    aligned = [f.select(*[F.col(c) if c in f.columns else F.lit(None).alias(c) for c in cols]) for f in frames]
    unioned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), aligned)
    return unioned.agg(*[F.max(c).alias(c) for c in cols])


def last_n(samples: DataFrame, n: int = LAST_N) -> DataFrame:
    """O2: the ``n`` most recent samples by ``seq`` (top-k plan)."""
    return samples.orderBy(F.col("seq").desc()).limit(n)


def _duration_s(samples: DataFrame):
    return (F.max("ts_ms") - F.min("ts_ms")) / F.lit(1000.0)


def latency_summary(samples: DataFrame) -> DataFrame:
    """p50/p95/p99 (linear), max, min, mean, population std and the p99 < 30 ms check."""
    pct = selected_percentiles(samples, "latency_ms", PCTS)
    stats = samples.agg(F.count(F.lit(1)).alias("sample_count"), F.max("latency_ms").alias("max"),
                        F.min("latency_ms").alias("min"), *exact_mean_parts("latency_ms", "mean"),
                        round_half(F.stddev_pop("latency_ms"), 6).alias("std"))
    stats = stats.select("sample_count", "max", "min", exact_mean("mean").alias("mean"), "std")
    row = _one_row(pct, stats)
    return row.withColumn("sla_ok", F.col("p99") < F.lit(SLA_P99_MS))


def rolling_row(recent: DataFrame, totals: DataFrame) -> DataFrame:
    """A8 from the last samples and the one-row ``totals`` (total_requests, errors, duration_s) over all."""
    pct = recent.agg(*[round_half(F.percentile("latency_ms", q), 6).alias(k) for k, q in PCTS.items()])
    row = _one_row(pct, totals)
    return row.select("p50", "p95", "p99", "total_requests", "errors",
                      round_half(safe_div("total_requests", "duration_s"), 6).alias("throughput_rps"),
                      round_half(safe_div("errors", "total_requests"), 9).alias("error_rate"))


def rolling_metrics(samples: DataFrame, n: int = LAST_N) -> DataFrame:
    """Percentiles over the last ``n`` samples; throughput and error rate over all samples."""
    return rolling_row(last_n(samples, n), samples.agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(~F.col("ok")).alias("errors"),
        _duration_s(samples).alias("duration_s")))


def client_metrics(samples: DataFrame) -> DataFrame:
    """Request counters, success rate, percentiles over successful requests, throughput.

    One error is counted per failed request (deviation: a failing "not loaded" call is not counted twice).
    """
    pct = selected_percentiles(samples.filter("ok"), "latency_ms", PCTS)
    batch = F.col("is_batch")
    totals = samples.agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(~F.col("ok")).alias("failed_requests"),
        F.count_if(~batch).alias("single_requests"), F.count_if(batch).alias("batch_requests"),
        F.count_if(batch & ~F.col("ok")).alias("batch_errors"), _duration_s(samples).alias("duration_s"))
    row = _one_row(pct, totals)
    return row.select(
        "total_requests", "failed_requests",
        round_half(safe_div(F.col("total_requests") - F.col("failed_requests"), "total_requests"), 9).alias("success_rate"),
        "p50", "p95", "p99", "single_requests", "batch_requests", "batch_errors",
        round_half(safe_div("total_requests", "duration_s"), 6).alias("throughput_rps"))


def penalised_metrics(samples: DataFrame) -> DataFrame:
    """A10: a failed call counts as 1000 ms; throughput = n / (sum of latencies in seconds)."""
    pen = samples.select(F.when(F.col("ok"), F.col("latency_ms")).otherwise(F.lit(FAILED_CALL_MS)).alias("lat"),
                         "ok")
    pct = selected_percentiles(pen, "lat", PCTS)
    totals = pen.agg(F.count(F.lit(1)).alias("n"), F.sum("lat").alias("lat_sum"),
                     F.count_if(~F.col("ok")).alias("errors"))
    row = _one_row(pct, totals)
    return row.select("p50", "p95", "p99", F.col("n").alias("sample_count"),
                      round_half(safe_div("n", F.col("lat_sum") / F.lit(1000.0)), 6).alias("throughput_rps"),
                      round_half(safe_div("errors", "n"), 9).alias("error_rate"))


def stage_metrics(samples: DataFrame, window_ms: int = REPORT_WINDOW_MS) -> DataFrame:
    """Avg, p95 and count per stage per report window (the reset is the tumbling window)."""
    win_ms = F.floor(F.col("ts_ms") / F.lit(window_ms)) * F.lit(window_ms)
    keyed = samples.select("stage", win_ms.alias("window_start_ms"), "latency_ms")
    pct = exact_percentiles(keyed, "latency_ms", {"p95_ms": 0.95}, keys=["stage", "window_start_ms"])
    stats = keyed.groupBy("stage", "window_start_ms").agg(*exact_mean_parts("latency_ms", "avg"),
                                                          F.count(F.lit(1)).alias("count"))
    stats = stats.select("stage", "window_start_ms", exact_mean("avg").alias("avg_ms"), "count")
    return stats.join(pct, ["stage", "window_start_ms"], "inner")


def index_percentiles(samples: DataFrame, n: int = LAST_N) -> DataFrame:
    """Nearest-index percentiles sorted[int(n*q)] over the last ``n`` successful latencies in seconds."""
    recent = last_n(samples.filter("ok"), n).select((F.col("latency_ms") / F.lit(1000.0)).alias("s"))
    agg = recent.agg(F.array_sort(F.collect_list("s")).alias("v"), F.count(F.lit(1)).alias("n"))
    pick = lambda q: F.element_at("v", (F.floor(F.col("n").cast("double") * F.lit(q)) + 1).cast("int"))
    return agg.select(F.col("n").alias("sample_count"),
                      *[pick(q).alias(f"{k}_seconds") for k, q in PCTS.items()])


def _histogram(values: DataFrame, col: str, bounds: list, labels: list[str]) -> DataFrame:
    v = F.col(col)
    agg = values.agg(*[F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)],
                     F.count(F.lit(1)).alias("total_count"), F.sum(v).alias("total_sum"))
    pairs = ", ".join(f"'{lab}', b{i}" for i, lab in enumerate(labels)) + ", '+Inf', total_count"
    tall = agg.select(F.expr(f"stack({len(labels) + 1}, {pairs})").alias("le", "cumulative_count"),
                      "total_count", "total_sum")
    return tall


def latency_histogram(samples: DataFrame, n: int = LAST_N) -> DataFrame:
    """Cumulative latency histogram (seconds) over the last ``n`` successful samples, with sum and count."""
    recent = last_n(samples.filter("ok"), n).select((F.col("latency_ms") / F.lit(1000.0)).alias("s"))
    out = _histogram(recent, "s", LATENCY_BUCKETS, [str(b) for b in LATENCY_BUCKETS])
    return out.withColumn("total_sum", round_half("total_sum", 6))


def batch_size_histogram(samples: DataFrame, n: int = LAST_N) -> DataFrame:
    """Cumulative batch-size histogram over the last ``n`` batch requests, with sum and count."""
    recent = last_n(samples.filter("is_batch"), n).select("batch_size")
    return _histogram(recent, "batch_size", BATCH_BUCKETS, [str(b) for b in BATCH_BUCKETS])


def compare_runs(samples: DataFrame, run_of) -> DataFrame:
    """p50/p95/p99/mean of the runs ``before`` and ``after`` (``run_of``), with the improvement in percent. No
    rows unless both runs have a latency. Both runs are columns of one row throughout, so nothing is joined."""
    runs = ("before", "after")
    at = samples.select(run_of.alias("run"), "latency_ms")
    pct = selected_percentiles(at, "latency_ms", {f"_{k}": q for k, q in PCTS.items()}, F.col("run"), runs)
    wide = at.select(*[F.when(F.col("run") == r, F.col("latency_ms")).alias(r) for r in runs])
    means = wide.agg(*[part for r in runs for part in exact_mean_parts(r, r)])
    row = _one_row(pct, means.select(*[exact_mean(r).alias(f"{r}_mean") for r in runs]))
    tall = row.select(F.expr("stack(4, " + ", ".join(f"'{m}', before_{m}, after_{m}" for m in (*PCTS, "mean")) + ")")
                      .alias("metric", "before", "after")).filter("before is not null and after is not null")
    imp = safe_div(F.col("before") - F.col("after"), "before") * 100
    return tall.select("metric", "before", "after", round_half(imp, 6).alias("improvement_pct"))
