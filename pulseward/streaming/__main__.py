"""Run the live path: ``python -m pulseward.streaming --source files --path IN --out OUT --checkpoint CK``.

Starts the stateful risk query (results, late rows, feature updates), the dead-letter query on the same source, and the
alert rules on the metrics of their progress. A query that fails is started again from its checkpoint, up to
``--tolerated-failures`` times in a row (``supervise``). The tables are compacted every ``--compact-minutes``.
``--once`` processes what is available in one micro-batch per query and exits.
"""

from __future__ import annotations

import argparse
import os
import time

from ..session import get_spark
from . import jobs, live_alerts, sinks, sources
from .progress import SCHEMA, ProgressMetrics
from .supervise import TOLERATED, Supervisor


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m pulseward.streaming")
    ap.add_argument("--source", choices=["kafka", "files"], default="files")
    ap.add_argument("--path", help="folder of feed files (seq, arrival_ms, value) for --source files")
    ap.add_argument("--format", default="json", help="file format for --source files")
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers for --source kafka")
    ap.add_argument("--topic", default=sources.RECORDS_TOPIC)
    ap.add_argument("--results-topic", default=sources.RESULTS_TOPIC)
    ap.add_argument("--out", required=True, help="root folder of the result / late / dlq / feature tables")
    ap.add_argument("--checkpoint", required=True, help="checkpoint root (one sub-folder per query)")
    ap.add_argument("--engine", choices=["tws", "pandas"], default="tws")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=100_000,
                    help="records per micro-batch for --source kafka; bounds what one task sorts per patient")
    ap.add_argument("--max-files-per-trigger", type=int, default=1, help="files per micro-batch for --source files")
    ap.add_argument("--trigger-seconds", type=float, default=2.0)
    ap.add_argument("--tolerated-failures", type=int, default=TOLERATED, help="failures of a query in a row before the job ends")
    ap.add_argument("--compact-minutes", type=float, default=60.0, help="0: never")
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--master", default=None, help="master URL when not launched by spark-submit")
    args = ap.parse_args(argv)

    spark = get_spark(master=args.master)
    if args.source == "kafka":
        options = {"kind": "kafka", "bootstrap": args.bootstrap, "topic": args.topic,
                   "max_offsets_per_trigger": args.max_offsets_per_trigger}
    else:
        options = {"kind": "files", "path": args.path, "fmt": args.format,
                   "max_files_per_trigger": args.max_files_per_trigger}
    make = lambda: sources.pick_source(spark, **options)
    trigger = {"once": True} if args.once else {"processingTime": f"{args.trigger_seconds} seconds"}
    kafka = args.bootstrap if args.source == "kafka" else None
    starts = [lambda: jobs.start_risk_query(make(), args.out, os.path.join(args.checkpoint, "risk"), trigger=trigger,
                                            engine=args.engine, kafka_bootstrap=kafka),
              lambda: jobs.start_dlq_query(make(), args.out, os.path.join(args.checkpoint, "dlq"), trigger=trigger,
                                           kafka_bootstrap=kafka)]
    metrics_path = f"{args.out.rstrip('/')}/metrics"
    metrics = ProgressMetrics(skip=("alerts",))
    spark.streams.addListener(metrics)
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(metrics_path)   # the folder, for the alert query
    if not args.once:
        starts.append(lambda: live_alerts.start_alert_query(
            live_alerts.metric_source(spark, metrics_path), args.out, os.path.join(args.checkpoint, "alerts")))
    last = {"flush": time.monotonic(), "compact": time.monotonic()}

    def tick() -> None:
        now = time.monotonic()
        if now - last["flush"] >= 2:
            metrics.append_to(spark, metrics_path)
            last["flush"] = now
        if args.compact_minutes and now - last["compact"] >= 60 * args.compact_minutes:
            sinks.compact(spark, args.out)
            last["compact"] = now

    try:
        Supervisor(starts, tolerated=args.tolerated_failures, tick=tick).run()
    finally:
        metrics.append_to(spark, metrics_path)
        spark.streams.removeListener(metrics)
    return 0


def wait_for_all(spark, queries) -> None:
    """Returns when all queries have ended; if one fails, the others are stopped and its error is raised."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for q in queries:
            if q.exception():
                raise q.exception()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


if __name__ == "__main__":
    raise SystemExit(main())
