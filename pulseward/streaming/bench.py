"""Streaming throughput: replay the derived feed through the stateful query in fixed micro-batches.

The feed is written as ``batches`` parquet files in arrival order (one file per micro-batch via
``maxFilesPerTrigger=1``); the query runs with a zero-interval processing-time trigger until every input row
is processed or the deadline passes. Returns rows/s and per-batch durations from the query progress.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.feed import feed
from . import jobs, sources


def stream_throughput(spark: SparkSession, sf_dir: str, batches: int = 10, deadline_s: float = 600.0,
                      engine: str = "tws") -> dict:
    # under the shared checkpoint folder (a scratch folder only for local sessions without the setting)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streambench-{uuid.uuid4().hex[:12]}"
    inp = os.path.join(root, "in")
    fd = feed(spark, sf_dir)
    n = fd.count()
    bounds = fd.select(F.min("arrival_ms").alias("lo"), F.max("arrival_ms").alias("hi")).first()
    step = (bounds.hi - bounds.lo) // batches + 1
    for b in range(batches):  # one file per batch, written in arrival order
        part = fd.filter((F.col("arrival_ms") >= bounds.lo + b * step) & (F.col("arrival_ms") < bounds.lo + (b + 1) * step))
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(inp, f"b{b:04d}"))
        time.sleep(0.01)
    src = sources.file_source(spark, os.path.join(inp, "*"), fmt="parquet", max_files_per_trigger=1)
    started = time.perf_counter()
    q = jobs.start_risk_query(src, os.path.join(root, "out"), os.path.join(root, "ck"),
                                  trigger={"processingTime": "0 seconds"}, engine=engine)
    done_rows, durations, phases = 0, [], []
    seen = set()
    try:
        while time.perf_counter() - started < deadline_s:
            for p in q.recentProgress:
                if p["batchId"] not in seen and p["numInputRows"] > 0:
                    seen.add(p["batchId"])
                    done_rows += p["numInputRows"]
                    durations.append(p["durationMs"].get("triggerExecution", 0))
                    phases.append(p["durationMs"])
            if done_rows >= n:
                break
            time.sleep(0.2)
        elapsed = time.perf_counter() - started
    finally:
        q.stop()
    durations.sort()
    try:  # from the start of a record's micro-batch until its state is written
        res = spark.read.parquet(os.path.join(root, "out", "results"))
        p99 = res.select(F.percentile("processing_latency_ms", 0.99)).first()[0]
    except Exception:
        p99 = None
    extra = {"stream_record_latency_ms_p99": round(p99, 4) if p99 is not None else None}
    return {**extra,"stream_engine": engine, "stream_rows": done_rows, "stream_seconds": round(elapsed, 3),
            "stream_rows_per_sec": round(done_rows / elapsed, 1) if elapsed else None,
            "stream_batches": len(durations),
            "stream_batch_ms_p50": durations[len(durations) // 2] if durations else None,
            "stream_batch_ms_max": durations[-1] if durations else None,
            "stream_phase_ms_median": {k: sorted(p.get(k, 0) for p in phases)[len(phases) // 2]
                                       for k in ("addBatch", "queryPlanning", "walCommit", "commitOffsets",
                                                 "latestOffset", "getBatch")} if phases else None}
