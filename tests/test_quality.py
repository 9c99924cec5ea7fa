"""Hourly quality limits on a hand-worked scenario (live states with the 24 h lifetime, growth, late ratio)."""

from pulseward.operators.quality import hourly_quality

H = 3_600_000


def test_live_states_and_growth(spark):
    # patient 1 writes at hour 0 and again at hour 30 (a new lifetime); patient 2 writes at hour 1
    wm = spark.createDataFrame(
        [(0, 1, 0, 0, None, False), (1, 1, 30 * H, 30 * H, None, False), (2, 2, H, H, None, False),
         (3, 2, H + 5, H - 10_000, None, True)],
        "seq long, patient_id long, arrival_ms long, event_time_ms long, error string, late boolean")
    scored = spark.createDataFrame([(0, "high"), (30 * H, "low"), (H, "high")], "arrival_ms long, risk_level string")
    segments = spark.createDataFrame([(1, 1, 0), (1, 2, 30 * H), (2, 1, H)],
                                     "patient_id long, segment long, arrival_ms long")
    samples = spark.createDataFrame([(0, 10.0), (H, 40.0)], "ts_ms long, latency_ms double")
    p99 = spark.createDataFrame([(0, 10.0), (H, 40.0)], "hour_ms long, p99_ms double")
    rows = {r.hour_ms // H: r for r in hourly_quality(wm, scored, segments, samples, p99, 24 * H).collect()}
    assert sorted(rows) == [0, 1, 30]
    assert rows[0].live_states == 1 and rows[0].state_growth is None
    assert rows[1].live_states == 2 and rows[1].state_growth == 1.0 and rows[1].growth_flag   # 1 -> 2 in an hour
    assert rows[30].live_states == 1           # patient 1 expired at hour 24, patient 2 at hour 25, 1 is back
    assert rows[1].late_records == 1 and rows[1].late_ratio == 0.5 and rows[1].late_flag
    assert rows[1].lag_records == 1            # the row that arrived 10 s after its event time
    assert rows[1].p99_flag and not rows[0].p99_flag
    assert rows[1].psi_prev_hour == 0.0        # both hours are all 'high'
