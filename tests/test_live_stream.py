"""Live alerts with timers, rolling metrics, versioned sink tables, supervised restarts, shuffled replay."""

import json
import os
import random
import tempfile
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseward.operators import metrics
from pulseward.operators.alerts import ThresholdRule, counter_rate, threshold_alerts
from pulseward.streaming import live_alerts, rolling, shuffled, sinks
from pulseward.streaming.manifest import Table
from pulseward.streaming.supervise import Supervisor

S = 1000
HIGH = ThresholdRule("High", "lat", 30.0, 60 * S, "critical")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="pulseward-live-", dir="/tmp")


def in_steps(points, rule_for, range_ms, cuts, threshold):
    """The rows of ``advance``, with the points given in several steps."""
    island, window, out = live_alerts.Island(), {}, []
    for lo, hi in zip([-1, *cuts], [*cuts, 10**12]):
        out += live_alerts.advance(island, window, [p for p in points if lo <= p[0] < hi], hi, threshold, rule_for, range_ms)
    return out


def test_islands_equal_the_batch_operator(spark):
    rng = random.Random(1)
    series, steps = [], {}
    for k in range(12):
        ts = sorted(rng.randrange(0, 2000) * S for _ in range(60))
        level, points = 50.0, []
        for i, t in enumerate(ts):
            level = rng.choice([10.0, 50.0, 60.0]) if rng.random() < 0.3 else level
            points.append((t, i, level))
        points.append((2001 * S, 60, 0.0))
        series += [(f"s{k}", i, t, v) for t, i, v in points]
        steps[f"s{k}"] = in_steps(points, 60 * S, None, sorted(rng.sample(range(0, 2000 * S), 4)), 30.0)
    frame = spark.createDataFrame(series, "series string, seq long, ts_ms long, value double")
    rules = [ThresholdRule("High", f"s{k}", 30.0, 60 * S, "critical") for k in range(12)]
    want = sorted((r.series, r.island_start_ms, r.firing_since_ms, r.island_end_ms, r.n_points, r.max_value)
                  for r in threshold_alerts(frame, rules).collect())
    got = sorted((name, r[1], r[3], r[4], r[5], r[6]) for name, rows in steps.items() for r in rows
                 if r[0] == "resolved" and r[3] is not None)
    assert got == want and len(got) > 20


def test_counter_state_equals_the_batch_operator(spark):
    rng = random.Random(2)
    value, points = 0.0, []
    for i in range(300):
        value = 0.0 if rng.random() < 0.05 else value + rng.choice([0, 0, 0, 0, 0, 0, 0, 2])
        points.append((i * 40 * S + rng.choice([0, 0, 40 * S]), i, value))
    points.sort()
    frame = spark.createDataFrame([("failed_checkpoints", i, t, v) for t, i, v in points],
                                  "series string, seq long, ts_ms long, value double")
    first = {}
    held = None
    for r in sorted(counter_rate(frame).collect(), key=lambda r: (r.ts_ms, r.seq)):
        held = (held if held is not None else r.ts_ms) if r.above else None
        if r.firing:
            first.setdefault(held, r.ts_ms)
    rows = in_steps(points, 60 * S, 300 * S, [1000 * S, 5000 * S], 0.0)
    assert {r[1]: r[3] for r in rows if r[0] == "resolved" and r[3] is not None}.items() <= first.items()
    assert len([r for r in rows if r[0] == "firing"]) >= len(first) > 2


def test_alert_fires_on_the_timer_and_not_before(spark, root):
    def at(t):
        return (1000 + t) * S

    def step(n, rows):
        folder = os.path.join(root, "in")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{n}.json"), "w") as f:
            for i, (series, t, v) in enumerate(rows):
                f.write(json.dumps({"series": series, "seq": 100 * n + i, "ts_ms": at(t), "value": v}) + "\n")
        points = spark.readStream.schema(live_alerts.POINTS).json(folder)
        q = live_alerts.start_alert_query(points, root, os.path.join(root, "ck"), {"once": True}, threshold_rules=[
            HIGH, ThresholdRule("Regular", "lat2", 30.0, 60 * S, "warning"), ThresholdRule("Clock", "clock", 1e9, 0, "-")],
            counter_rules=[], delay="0 seconds")
        assert q.awaitTermination(120)
        return [(r.alert, r.kind, r.island_start_ms, r.firing_since_ms, r.firing_point_ms) for r in
                Table(spark, root, "alerts").read().collect()]

    regular = [("lat2", t, 50.0 + t) for t in range(0, 130, 20)] + [("lat2", 130, 1.0)]
    assert step(0, [("lat", 30, 50.0), ("lat", 0, 50.0), ("clock", 40, 0.0), *regular[:2]]) == []
    assert step(1, [("clock", 50, 0.0)]) == []
    assert step(2, [("clock", 140, 0.0), *regular[3:]]) == []     # the watermark is at 50 s
    third = step(3, [("clock", 400, 0.0)])                        # no new point of lat, but its timer
    assert ("High", "firing", at(0), at(60), None) in third
    step(4, [("lat", 410, 10.0), ("clock", 600, 0.0)])
    last = step(5, [("clock", 700, 0.0)])
    assert [x for x in last if x[:2] == ("High", "resolved")] == [("High", "resolved", at(0), at(60), None)]
    frame = spark.createDataFrame([("lat2", i, at(t), v) for i, (_, t, v) in enumerate([*regular[:2], *regular[3:]])],
                                  "series string, seq long, ts_ms long, value double")
    want = [(r.island_start_ms, r.firing_since_ms) for r in threshold_alerts(frame, [
        ThresholdRule("Regular", "lat2", 30.0, 60 * S, "warning")]).collect()]
    assert [(x[2], x[4]) for x in last if x[:2] == ("Regular", "resolved")] == want == [(at(0), at(60))]


def test_rolling_metrics_equal_the_batch_queries_on_every_prefix(spark, root):
    rng = random.Random(3)
    rows = [(i, i * 37, rng.random() * 900, rng.random() < 0.8, rng.random() < 0.5, rng.choice([1, 4, 30])) for i in range(2300)]
    rng.shuffle(rows)
    names = [x.split()[0] for x in rolling.SAMPLES.split(", ")]
    os.makedirs(os.path.join(root, "in"))
    for n, upto in enumerate((600, 1700, 2300)):
        with open(os.path.join(root, "in", f"{n}.json"), "w") as f:
            f.writelines(json.dumps(dict(zip(names, r))) + "\n" for r in rows[:upto][(0, 600, 1700)[n]:])
        samples = spark.readStream.schema(rolling.SAMPLES).json(os.path.join(root, "in"))
        q = rolling.start_rolling_query(samples, root, os.path.join(root, "ck"), {"once": True})
        assert q.awaitTermination(120)
        prefix = spark.createDataFrame(rows[:upto], rolling.SAMPLES).cache()
        batch = {"rolling_metrics": metrics.rolling_metrics(prefix), "latency_index_pct": metrics.index_percentiles(prefix),
                 "latency_histogram": metrics.latency_histogram(prefix), "batch_size_histogram": metrics.batch_size_histogram(prefix)}
        for name, want in batch.items():
            got = Table(spark, root, name).read().where(F.col("batch_id") == n).drop("batch_id")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())), (name, n)


def test_rings_stay_bounded():
    import pandas as pd
    held = pd.DataFrame([], columns=["seq"])
    for lo in range(0, 5000, 700):
        held = rolling.last_rows(held, pd.DataFrame({"seq": np.random.permutation(np.arange(lo, lo + 700))}), 1000)
        assert len(held) <= 1000
    assert set(held["seq"]) == set(range(lo + 700 - 1000, lo + 700))


def test_committed_batches_only_and_one_winner_per_version(spark, root):
    t = Table(spark, root, "x")
    assert t.read() is None and t.compact() is None
    for b in range(3):
        assert t.write(spark.range(b * 10, b * 10 + 10), b)
    spark.range(100, 105).write.parquet(f"{root}/x/batch_id=3")      # its writer died before the commit
    assert t.read().count() == 30 and t.read(1).count() == 20
    assert not t.write(spark.range(1000), 1)                          # replayed, committed before
    version, state = t.state()
    assert t._put(version + 1, state) and not t._put(version + 1, state)
    assert t.write(spark.range(30, 40), 3)                            # the replay of the batch that wasn't committed
    assert t.compact(1) == 1 and t.compact() == 3 and t.compact() is None
    assert t.vacuum(keep_versions=2) >= 4
    assert not t.write(spark.range(1000), 0)                          # replayed, folded before
    assert sorted(r.id for r in t.read().collect()) == list(range(40))
    assert {r.batch_id: r["count"] for r in t.read().groupBy("batch_id").count().collect()} == {b: 10 for b in range(4)}
    assert not [x for x in os.listdir(f"{root}/x") if x.startswith("batch_id=")]


def test_compaction_beside_a_writer_loses_and_doubles_nothing(spark, root):
    done = threading.Event()

    def writer():
        t = Table(spark, root, "y")
        for b in range(10):
            t.write(spark.range(b * 5, b * 5 + 5), b)
        done.set()

    thread = threading.Thread(target=writer)
    thread.start()
    other, folded = Table(spark, root, "y"), 0
    while not done.is_set():
        folded += other.compact() is not None
    thread.join()
    assert folded and sorted(r.id for r in other.read().collect()) == list(range(50))


class FakeQuery:
    def __init__(self, error, progress=None):
        self._error, self.lastProgress, self.isActive = error, progress, False

    def exception(self):
        return self._error

    def stop(self):
        pass


@pytest.mark.parametrize("outcomes,raises,starts", [
    ("ff.", False, 3), ("fff.", False, 4), ("ffff", True, 4), ("fffpffpf.", False, 9), ("fffpffff", True, 7)])
def test_failures_in_a_row(outcomes, raises, starts):
    """f: failed before a micro-batch, p: failed after one, '.': ended."""
    made = []

    def start():
        o = outcomes[len(made)]
        made.append(o)
        return FakeQuery(None if o == "." else RuntimeError(o), {"batchId": 1} if o == "p" else None)

    run = Supervisor([start], pause_s=0, poll_s=0).run
    if raises:
        with pytest.raises(RuntimeError):
            run()
    else:
        run()
    assert len(made) == starts


def test_failures_in_a_window():
    made = []

    def start():
        made.append(1)
        return FakeQuery(RuntimeError("again"), {"batchId": 1})   # always after some progress

    with pytest.raises(RuntimeError):
        Supervisor([start], pause_s=0, poll_s=0, per_window=7).run()
    assert len(made) == 8


def test_a_query_that_fails_twice_goes_on_from_its_checkpoint(spark, root):
    os.makedirs(os.path.join(root, "in"))
    for n in range(3):
        with open(os.path.join(root, "in", f"{n}.json"), "w") as f:
            f.writelines(json.dumps({"a": 10 * n + i}) + "\n" for i in range(10))
    failures = []

    def write(batch, batch_id):
        Table(spark, root, "out").write(batch, batch_id)
        if len(failures) < 2 and batch_id == 1:
            failures.append(batch_id)
            raise RuntimeError("lost after the write, before the commit of the checkpoint")

    def start():
        rows = spark.readStream.schema("a long").option("maxFilesPerTrigger", 1).json(os.path.join(root, "in"))
        return (rows.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "ck"))
                .trigger(processingTime="0 seconds").start())

    def all_there():
        rows = Table(spark, root, "out").read()
        return time.time() > deadline or (rows is not None and rows.count() >= 30)

    deadline = time.time() + 90
    Supervisor([start], pause_s=0.1).run(until=all_there)
    assert failures == [1, 1]
    assert sorted(r.a for r in Table(spark, root, "out").read().collect()) == list(range(30))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 12_345])
def test_every_epoch_is_a_permutation(n):
    i = np.arange(n)
    rows = [shuffled.permutation(i, n, np.full(n, e), 42) for e in range(3)]
    assert all(sorted(r) == list(i) for r in rows)
    if n >= 100:
        assert not (rows[0] == rows[1]).all() and abs(np.corrcoef(i, rows[0])[0, 1]) < 0.3
        assert (shuffled.permutation(i[50:60], n, np.zeros(10, int), 42) == rows[0][50:60]).all()   # from any offset


def test_shuffled_replay_restarts_at_its_offset(spark, root):
    records = spark.range(20).select(F.col("id").alias("row_index"), F.col("id").cast("string").alias("value"))
    table = Table(spark, root, "replay")

    def run(rows):
        src = shuffled.shuffled_replay_source(spark, records, 20, 15, t0_ms=1000, rps=50, seed=7)
        q = (src.writeStream.foreachBatch(lambda b, n: table.write(b, n) and None)
             .option("checkpointLocation", os.path.join(root, "ck")).trigger(processingTime="0 seconds").start())
        deadline = time.time() + 90
        while time.time() < deadline and (table.read() is None or table.read().count() < rows):
            time.sleep(0.2)
        q.stop()

    run(15)
    run(60)
    got = {r.seq: r for r in table.read().collect()}
    assert sorted(got) == list(range(len(got))) and len(got) >= 60
    for e in range(3):
        assert sorted(int(got[20 * e + i].value) for i in range(20)) == list(range(20))
    assert got[10].arrival_ms == 1000 + 200
