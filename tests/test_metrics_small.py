"""Metric operators on a hand-worked sample table (ten samples, latencies 10..100 ms, two failures)."""

import numpy as np
import pytest

from pulseward.operators import metrics


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(i, "view", 1000 * i, float(10 * (i + 1)), i not in (3, 7), 1 + i, i > 0) for i in range(10)]
    return spark.createDataFrame(rows, "seq long, stage string, ts_ms long, latency_ms double, ok boolean, "
                                       "batch_size long, is_batch boolean")


def test_linear_and_nearest_index_percentiles_differ(samples):
    lat = np.arange(10, 101, 10, dtype=float)
    s = metrics.latency_summary(samples).first()
    assert (s.p50, s.p95, s.p99) == tuple(round(float(np.percentile(lat, q)), 6) for q in (50, 95, 99))
    assert (s.min, s.max, s.mean, s.sample_count) == (10.0, 100.0, 55.0, 10)
    assert s.std == round(float(np.std(lat)), 6) and s.sla_ok is False
    idx = metrics.index_percentiles(samples).first()          # sorted[int(n * q)] of the 8 successful, in seconds
    assert (idx.p50_seconds, idx.p95_seconds, idx.p99_seconds) == (0.06, 0.1, 0.1)


def test_penalised_and_client_metrics(samples):
    pen = metrics.penalised_metrics(samples).first()
    lat = [1000.0 if i in (3, 7) else 10.0 * (i + 1) for i in range(10)]
    assert pen.throughput_rps == round(10 / (sum(lat) / 1000.0), 6) and pen.error_rate == 0.2
    cm = metrics.client_metrics(samples).first()
    assert (cm.total_requests, cm.failed_requests, cm.success_rate) == (10, 2, 0.8)
    assert (cm.single_requests, cm.batch_requests, cm.batch_errors) == (1, 9, 2)
    assert cm.throughput_rps == round(10 / 9.0, 6)              # 10 samples over 9 s


def test_histograms(samples):
    lat = {r.le: r.cumulative_count for r in metrics.latency_histogram(samples).collect()}
    assert (lat["0.01"], lat["0.05"], lat["0.1"], lat["+Inf"]) == (1, 4, 8, 8)   # successful requests
    bs = {r.le: r.cumulative_count for r in metrics.batch_size_histogram(samples).collect()}
    assert (bs["1"], bs["5"], bs["10"], bs["+Inf"]) == (0, 4, 9, 9)   # batch requests
