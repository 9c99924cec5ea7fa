"""Structured Streaming: late routing, keyed state across micro-batches and restarts, TTL, DLQ, idempotent sinks.

Each micro-batch is one input file processed by a trigger-once run that restarts from the checkpoint, so
batches are fixed and every run ends by itself (no unbounded waits).
"""

import json
import os
import tempfile
import time

import pytest

from pulseward.streaming import jobs, sinks, sources


def _rec(seq, pid, ts, arrival, age=70, **kw):
    d = {"id": f"r{seq}", "patient_id": pid, "age": age, "bmi": 32.0, "medication_count": 6, "length_of_stay": 8,
         "diabetes": 1, "hypertension": 1, "cholesterol": 250, "timestamp": ts}
    d.update(kw)
    return {"seq": seq, "arrival_ms": arrival, "value": json.dumps(d)}


class Harness:
    def __init__(self, spark, ttl_ms=jobs.TTL_MS, engine="tws"):
        self.spark, self.ttl_ms, self.engine = spark, ttl_ms, engine
        self.root = tempfile.mkdtemp(prefix="pulseward-stream-", dir="/tmp")
        self.inp = os.path.join(self.root, "in")
        self.out = os.path.join(self.root, "out")
        os.makedirs(self.inp)
        self.n = 0

    def add(self, rows):
        with open(os.path.join(self.inp, f"b{self.n:04d}.json"), "w") as f:
            for r in rows:
                f.write((json.dumps(r) if isinstance(r, dict) else r) + "\n")
        self.n += 1

    def run(self):
        q = jobs.start_risk_query(sources.file_source(self.spark, self.inp), self.out,
                                      os.path.join(self.root, "ck"), ttl_ms=self.ttl_ms, trigger={"once": True},
                                      engine=self.engine)
        assert q.awaitTermination(180)
        d = jobs.start_dlq_query(sources.file_source(self.spark, self.inp), self.out,
                                     os.path.join(self.root, "ckd"), trigger={"once": True})
        assert d.awaitTermination(180)

    def table(self, name):
        return {r.seq: r for r in sinks.read_table(self.spark, self.out, name).collect()}


@pytest.fixture(scope="module", params=["pandas", "tws"])
def two_batches(spark, request):
    h = Harness(spark, engine=request.param)
    h.add([_rec(1, 1, 100_000, 100_000), _rec(2, 2, 100_000, 100_001), {"seq": 3, "arrival_ms": 100_002,
                                                                        "value": "{bad"}])
    h.run()
    h.add([_rec(4, 1, 90_000, 100_100), _rec(5, 1, 100_500, 100_200), _rec(6, 2, 101_000, 100_300, age=200),
           _rec(7, 2, 0, 100_400, age=30)])
    h.run()
    return h


def test_results_carry_state_across_batches_and_restarts(two_batches):
    res = two_batches.table("results")
    assert sorted(res) == [1, 2, 5, 7]
    assert res[5].patient_stats.total_records == 2 and res[5].patient_stats.high_risk_count == 2
    assert res[7].patient_stats.total_records == 2 and res[7].risk_level == "high"  # 6 of 7 factors
    assert res[5].watermark == 95_002          # max event time of earlier batches (the malformed row 3) minus 5 s
    assert res[7].processing_timestamp == 100_400  # timestamp 0 -> arrival time


def test_results_carry_the_features_stored_by_earlier_batches(two_batches):
    res = two_batches.table("results")
    assert not res[1].patient_features.known_patient and res[1].patient_features.avg_risk_score == 0.5
    f = res[5].patient_features   # patient 1 was unknown in the first micro-batch
    assert (f.known_patient, f.record_count, f.last_activity) == (True, 1, 100_000)


def test_late_rows_are_routed_and_do_not_touch_state(two_batches):
    late = two_batches.table("late")
    assert list(late) == [4]
    assert late[4].processing_timestamp == 90_000 and late[4].watermark == 95_002


def test_dead_letters(two_batches):
    dlq = two_batches.table("dlq")
    assert {s: r.error for s, r in dlq.items()} == {3: "malformed_json", 6: "invalid_age"}
    assert dlq[6].key == 2 and dlq[6].topic == "dlq-medical"


def test_feature_updates_fold_to_counts(two_batches):
    f = {r.patient_id: r for r in sinks.read_features(two_batches.spark, two_batches.out).collect()}
    assert (f[1].record_count, f[1].last_activity) == (2, 100_500)
    assert (f[2].record_count, f[2].last_activity) == (2, 0)


def test_rerun_without_new_data_adds_nothing(two_batches):
    before = {t: len(two_batches.table(t)) for t in ("results", "late", "dlq")}
    two_batches.run()
    assert {t: len(two_batches.table(t)) for t in ("results", "late", "dlq")} == before


@pytest.mark.parametrize("engine", ["pandas", "tws"])
def test_state_expires_after_ttl(spark, engine):
    h = Harness(spark, ttl_ms=2_000, engine=engine)
    h.add([_rec(1, 9, 1_000, 1_000)])
    h.run()
    time.sleep(5)
    h.add([_rec(2, 9, 2_000, 2_000)])
    h.run()
    res = h.table("results")
    assert res[2].patient_stats.total_records == 1


@pytest.mark.parametrize("engine", ["pandas", "tws"])
def test_state_kept_within_ttl_and_late_only_batch_keeps_expiry(spark, engine):
    h = Harness(spark, ttl_ms=600_000, engine=engine)
    h.add([_rec(1, 9, 100_000, 100_000)])
    h.run()
    h.add([_rec(2, 9, 50_000, 100_100)])            # late only: no write
    h.run()
    h.add([_rec(3, 9, 100_200, 100_200)])
    h.run()
    res = h.table("results")
    assert sorted(res) == [1, 3] and res[3].patient_stats.total_records == 2
    assert list(h.table("late")) == [2]


def test_watermark_counts_invalid_rows(spark):
    from pulseward.streaming.jobs import risk_stream
    df = risk_stream(sources.file_source(spark, tempfile.mkdtemp(prefix="pulseward-empty-", dir="/tmp")))
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # no filter below the watermark node: bad rows must still advance the watermark; and none parses again
    above, below = optimized.split("EventTimeWatermark", 1)
    assert "Filter" in above and "Filter" not in below
    assert not any("from_json" in line for line in optimized.splitlines() if "Filter" in line)


@pytest.mark.parametrize("engine", ["pandas", "tws"])
def test_invalid_rows_move_the_watermark(spark, engine):
    h = Harness(spark, engine=engine)
    h.add([_rec(1, 1, 100_000, 100_000), _rec(2, 1, 200_000, 200_000, age=-1)])
    h.run()
    h.add([_rec(3, 1, 150_000, 200_100)])
    h.run()
    late = h.table("late")
    assert sorted(h.table("results")) == [1] and list(late) == [3] and late[3].watermark == 195_000


def test_rate_replay_source_maps_ticks_to_rows(spark):
    records = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "row_index long, value string")
    src = sources.rate_replay_source(spark, records, n_rows=3, rows_per_batch=7, t0_ms=1000, step_ms=100)
    name = "replay_probe"
    q = src.writeStream.format("memory").queryName(name).trigger(once=True).start()
    assert q.awaitTermination(120)
    rows = {r.seq: r for r in spark.sql(f"SELECT * FROM {name}").collect()}
    assert sorted(rows) == list(range(7))
    assert [rows[i].value for i in range(7)] == ["a", "b", "c", "a", "b", "c", "a"]
    assert rows[4].arrival_ms == 1000 + 100 * 5


def test_stream_replay_of_the_derived_feed_agrees_with_batch(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from pulseward.plans.catalog import QUERIES
    from pulseward.sources.feed import feed

    h = Harness(spark)
    fd = feed(spark, SF_SMALL)
    b = fd.select(F.min("arrival_ms").alias("lo"), F.max("arrival_ms").alias("hi")).first()
    step = (b.hi - b.lo) // 5 + 1
    for i in range(5):   # five micro-batches in arrival order
        part = fd.filter((F.col("arrival_ms") >= b.lo + i * step) & (F.col("arrival_ms") < b.lo + (i + 1) * step))
        part.orderBy("arrival_ms", "seq").coalesce(1).write.mode("overwrite").json(os.path.join(h.inp, f"b{i}"))
        h.n += 1
    src_path = os.path.join(h.inp, "*")
    for _ in range(5):
        q = jobs.start_risk_query(sources.file_source(spark, src_path), h.out, os.path.join(h.root, "ck"),
                                      trigger={"once": True})
        assert q.awaitTermination(180)
    d = jobs.start_dlq_query(sources.file_source(spark, src_path, max_files_per_trigger=5), h.out,
                                 os.path.join(h.root, "ckd"), trigger={"once": True})
    assert d.awaitTermination(180)

    dlq = h.table("dlq")
    batch_dlq = {r.seq: r.error for r in QUERIES["dlq_rows"](spark, SF_SMALL).collect()}
    assert {s: r.error for s, r in dlq.items()} == batch_dlq
    results, late = h.table("results"), h.table("late")
    valid = {r.seq for r in QUERIES["validate_records"](spark, SF_SMALL).select("seq").collect()}
    assert set(results) | set(late) == valid and not set(results) & set(late)
    # per patient the totals are exactly 1..n: every accepted record counted once (no expiry in this test)
    by_patient = {}
    for r in results.values():
        by_patient.setdefault(r.patient_id, []).append(r.patient_stats.total_records)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_patient.values())


def test_stage_reports_are_emitted_once_per_window(spark):
    from pulseward.streaming.metrics import stage_report_stream
    root = tempfile.mkdtemp(prefix="pulseward-stage-", dir="/tmp")
    inp = os.path.join(root, "in")
    os.makedirs(inp)
    hour = 3_600_000
    batches = [[("view", 10, 1.0), ("view", 20, 3.0), ("click", 30, 5.0)],          # window 0
               [("view", hour + 5, 7.0)],                                             # window 1
               [("view", 3 * hour, 9.0)]]                                             # moves the watermark on
    for i, rows in enumerate(batches):
        with open(os.path.join(inp, f"b{i}.json"), "w") as f:
            for st, ts, lat in rows:
                f.write(json.dumps({"stage": st, "ts_ms": ts, "latency_ms": lat}) + "\n")
    src = (spark.readStream.schema("stage string, ts_ms long, latency_ms double")
           .option("maxFilesPerTrigger", "1").json(inp))
    name = "stage_reports_probe"
    q = (stage_report_stream(src).writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    assert q.awaitTermination(180)
    got = {(r.stage, r.window_start_ms): r for r in spark.sql(f"SELECT * FROM {name}").collect()}
    assert set(got) == {("view", 0), ("click", 0), ("view", hour)}
    assert got[("view", 0)]["count"] == 2 and got[("view", 0)].avg_ms == 2.0
    assert got[("view", 0)].p95_ms == 3.0          # a sample, from the bounded sketch


def test_progress_events_become_metric_rows(spark):
    from pulseward.operators.alerts import ThresholdRule, threshold_alerts
    from pulseward.streaming.progress import ProgressMetrics
    listener = ProgressMetrics()
    spark.streams.addListener(listener)
    try:
        h = Harness(spark)
        h.add([_rec(1, 1, 100_000, 100_000), _rec(2, 2, 100_000, 100_001)])
        h.run()
        h.add([_rec(3, 1, 100_500, 100_200)])
        h.run()
        deadline = time.time() + 30
        while time.time() < deadline and listener.frame(spark).filter("series = 'state_rows'").count() < 2:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    m = listener.frame(spark)
    series = {r.series for r in m.select("series").distinct().collect()}
    assert {"batch_duration_ms", "checkpoint_ms", "input_rows", "state_rows"} <= series
    assert m.filter("series = 'input_rows'").agg({"value": "sum"}).first()[0] >= 3
    # the alert operators run on these rows unchanged
    rule = ThresholdRule("SlowBatches", "batch_duration_ms", -1.0, 0, "warning")
    assert threshold_alerts(m.drop("query"), [rule]).count() >= 1
    from pulseward.operators.alerts import PROGRESS_RULES
    assert threshold_alerts(m.drop("query"), PROGRESS_RULES).count() == 0   # a healthy local run


@pytest.mark.parametrize("engine", ["tws", "pandas"])
def test_command_line_launcher_runs_once(engine):
    import subprocess
    import sys
    root = tempfile.mkdtemp(prefix="pulseward-cli-", dir="/tmp")
    inp = os.path.join(root, "in")
    os.makedirs(inp)
    with open(os.path.join(inp, "b0.json"), "w") as f:
        for r in (_rec(1, 1, 100_000, 100_000), {"seq": 2, "arrival_ms": 100_001, "value": "{bad"}):
            f.write(json.dumps(r) + "\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run([sys.executable, "-m", "pulseward.streaming", "--path", inp, "--out",
                           os.path.join(root, "out"), "--checkpoint", os.path.join(root, "ck"), "--once",
                           "--engine", engine, "--master", "local[2]"], cwd=repo, capture_output=True, text=True,
                          timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert os.path.isdir(os.path.join(root, "out", "results", "batch_id=0"))
    assert os.path.isdir(os.path.join(root, "out", "dlq", "batch_id=0"))


def test_feature_snapshot_compaction(spark):
    h = Harness(spark)
    h.add([_rec(1, 1, 100_000, 100_000), _rec(2, 2, 100_000, 100_001)])
    h.run()
    h.add([_rec(3, 1, 100_500, 100_200)])
    h.run()
    assert sinks.compact_features(spark, h.out) == 1
    h.add([_rec(4, 1, 100_900, 100_900), _rec(5, 3, 101_000, 101_000)])
    h.run()
    f = {r.patient_id: (r.record_count, r.last_activity) for r in sinks.read_features(spark, h.out).collect()}
    assert f == {1: (3, 100_900), 2: (1, 100_000), 3: (1, 101_000)}
    assert sinks.compact_features(spark, h.out) == 2
    g = {r.patient_id: (r.record_count, r.last_activity) for r in sinks.read_features(spark, h.out).collect()}
    assert g == f


def test_crash_after_sink_write_is_replayed_exactly_once(spark):
    h = Harness(spark)
    marker = os.path.join(h.root, "crashed")

    def crash_once_after_write(batch, batch_id):
        sinks.risk_batch_writer(h.out)(batch, batch_id)
        if batch_id == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("simulated executor loss after the sink write, before the batch commit")

    def run():
        jobs.configure(spark)
        q = (jobs.risk_stream(sources.file_source(spark, h.inp)).writeStream.outputMode("append")
             .foreachBatch(crash_once_after_write).option("checkpointLocation", os.path.join(h.root, "ck"))
             .trigger(once=True).start())
        try:
            q.awaitTermination(180)
        except Exception:
            return False
        return True

    h.add([_rec(1, 1, 100_000, 100_000)])
    assert run()
    h.add([_rec(2, 1, 100_100, 100_100), _rec(3, 1, 90_000, 100_200)])
    assert not run()                # batch 1 wrote its folders, then failed before commit
    assert run()                    # restart: batch 1 is replayed from the checkpoint
    res, late = h.table("results"), h.table("late")
    assert sorted(res) == [1, 2] and list(late) == [3]
    assert res[2].patient_stats.total_records == 2   # state of the failed attempt was not kept
    f = {r.patient_id: r.record_count for r in sinks.read_features(spark, h.out).collect()}
    assert f == {1: 2}


def test_late_ratio_per_micro_batch(two_batches):
    rows = {r.batch_id: r for r in sinks.late_ratio_by_batch(two_batches.spark, two_batches.out).collect()}
    assert (rows[0].accepted, rows[0].late, rows[0].late_alarm) == (2, 0, False)
    assert (rows[1].accepted, rows[1].late) == (2, 1) and rows[1].late_ratio == 1 / 3 and rows[1].late_alarm


def test_drift_between_micro_batch_ranges(two_batches):
    r = sinks.drift_since(two_batches.spark, two_batches.out, 0).first()
    assert (r.reference_records, r.current_records) == (2, 2)
    assert r.psi == 0.0 and r.drift is False      # all results are 'high' in both ranges


def test_drift_of_counts_equals_drift_of_records(spark):
    from pyspark.sql import functions as F

    from pulseward.operators.quality import level_counts, psi_between, psi_of_counts
    levels = ["high", "medium", None, "low", "other"]
    rows = spark.createDataFrame([(b, levels[(b * i) % 5]) for b in range(6) for i in range(50 + b)], "batch_id int, risk_level string")
    counts = rows.groupBy("batch_id").agg(*level_counts(F.lit(True)))
    for upto in (-1, 0, 2, 5):
        ref = F.col("batch_id") <= upto
        assert psi_of_counts(counts, ref).collect() == psi_between(rows, ref).collect()
