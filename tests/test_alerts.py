"""Alert rules on hand-worked series: threshold held for a minimum time (L1), counter rate with a reset (L2)."""

import re

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pulseward.operators import scan
from pulseward.plans.catalog import QUERIES

from pulseward.operators.alerts import ThresholdRule, counter_rate, threshold_alerts


def test_threshold_held_for_a_minute(spark):
    s = 1000
    pts = [(0, 50.0), (30 * s, 50.0), (60 * s, 10.0), (90 * s, 50.0), (120 * s, 50.0), (180 * s, 60.0)]
    series = spark.createDataFrame([("lat", i, t, v) for i, (t, v) in enumerate(pts)],
                                   "series string, seq long, ts_ms long, value double")
    out = threshold_alerts(series, [ThresholdRule("High", "lat", 30.0, 60 * s, "critical")]).collect()
    assert len(out) == 1          # the first island lasts only 30 s
    r = out[0]
    assert (r.island_start_ms, r.firing_since_ms, r.island_end_ms, r.n_points, r.max_value) == \
        (90 * s, 180 * s, 180 * s, 3, 60.0)


def test_counter_rate_with_reset(spark):
    s = 1000
    values = [(0, 0.0), (100 * s, 5.0), (200 * s, 10.0), (300 * s, 2.0), (400 * s, 4.0)]
    series = spark.createDataFrame([("failed_checkpoints", i, t, v) for i, (t, v) in enumerate(values)],
                                   "series string, seq long, ts_ms long, value double")
    out = {r.ts_ms // s: r for r in counter_rate(series).collect()}
    assert [out[t].increase for t in (0, 100, 200, 300, 400)] == [0.0, 5.0, 5.0, 2.0, 2.0]   # reset -> new value
    assert out[100].rate_5m == pytest.approx(5 / 300, abs=1e-9)
    assert out[300].rate_5m == pytest.approx(12 / 300, abs=1e-9)     # (0 s, 300 s]: 5 + 5 + 2
    assert out[400].rate_5m == pytest.approx(9 / 300, abs=1e-9)      # (100 s, 400 s]: 5 + 2 + 2
    assert [out[t].firing for t in (0, 100, 200, 300, 400)] == [False, False, True, True, True]


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(scan, "ROWS_PER_RANGE", 6)
    monkeypatch.setattr(scan, "SEQ_BLOCK", 4)


def test_islands_across_ranges_equal_a_plain_scan(spark, small_ranges):
    """Long islands cover whole ranges, a burst of one instant is cut into blocks."""
    from pulseward.operators.alerts import island_points
    rng = np.random.default_rng(3)
    rows = []
    for key, p in (("mostly", 0.95), ("half", 0.5), ("always", 1.0), ("never", 0.0)):
        ts = np.sort(rng.integers(0, 400, 60)) * 1000
        ts[20:40] = ts[20]
        rows += [(key, int(t), i, bool(rng.random() < p)) for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "k string, ts_ms long, seq long, h boolean")
    got = {(r.k, r.seq): r._island and tuple(r._island) for r in island_points(df, F.col("h"), ["k"]).collect()}
    assert len(got) == len(rows)
    for key, sub in pd.DataFrame(rows, columns=["k", "ts", "seq", "h"]).groupby("k"):
        start = None
        for r in sub.sort_values(["ts", "seq"]).itertuples():
            start = ((r.ts, r.seq) if start is None else start) if r.h else None
            assert got[key, r.seq] == start, (key, r)


def _series(spark, n=900, burst=200):
    rng = np.random.default_rng(4)
    ts = np.sort(rng.integers(0, 100_000, n)) * 1000       # 28 hours: over 300 spans of 300 s
    ts[300:300 + burst] = ts[300]
    step = np.where(rng.random(n) < 0.3, rng.integers(0, 3, n), 0)
    value = np.concatenate([np.cumsum(step[:n // 2]), np.cumsum(step[n // 2:])]).astype(float)
    rows = [("failed_checkpoints", i, int(t), float(v)) for i, (t, v) in enumerate(zip(ts, value))]
    return rows, spark.createDataFrame(rows, "series string, seq long, ts_ms long, value double")


def test_counter_rate_over_many_ranges_equals_a_plain_scan(spark, small_ranges):
    rows, df = _series(spark)
    got = {r.seq: r for r in counter_rate(df).collect()}
    inc = [0.0] + [b[3] - a[3] if b[3] >= a[3] else b[3] for a, b in zip(rows, rows[1:])]
    ts = np.array([r[2] for r in rows])
    start = None
    for i, (_, seq, t, _) in enumerate(rows):
        rate = sum(np.array(inc)[(ts > t - 300_000) & (ts <= t)]) / 300
        start = (t if start is None else start) if rate > 0 else None
        assert got[seq].increase == inc[i] and got[seq].rate_5m == pytest.approx(rate, abs=1e-9)
        assert got[seq].firing == (start is not None and t >= start + 60_000), rows[i]


def test_overlap_copies_few_rows(spark, small_ranges):
    _, df = _series(spark)
    at = df.select("ts_ms").distinct()
    n = at.count()
    out = scan.with_overlap(at, "ts_ms", 300_000)
    own, copies, ranges = out.filter("_own").count(), out.filter("not _own").count(), out.select("_range").distinct().count()
    assert own == n and ranges > 10 and 0 < copies <= n / scan.SPANS_PER_RANGE * 1.5


def _exchanges(df):
    return len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_plans_of_the_alert_queries(spark, monkeypatch):
    monkeypatch.setattr(scan, "ROWS_PER_RANGE", 100)
    alerts, rate = QUERIES["threshold_alerts"](spark, SF_SMALL), QUERIES["counter_rate"](spark, SF_SMALL)
    assert _exchanges(alerts) <= 5
    assert _exchanges(rate) <= 6      # and four in the two tables that it stores


def test_no_rules_no_alerts(spark):
    series = spark.createDataFrame([("lat", 1, 0, 50.0)], "series string, seq long, ts_ms long, value double")
    assert threshold_alerts(series, []).collect() == []
