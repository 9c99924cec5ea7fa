"""Two-level running computations equal the plain single-window definitions (property tests)."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseward.operators.running import TTL_MS, patient_risk_running, ttl_segments
from pulseward.operators.scan import Running, chunked_running

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 5 * 86_400_000), st.integers(-50, 50)),
    min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, chunk=st.sampled_from([1000, 3_600_000, 86_400_000]))
def test_chunked_running_matches_pandas(spark, rows, chunk):
    pdf = pd.DataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(rows)], columns=["k", "t", "v", "seq"])
    df = spark.createDataFrame(pdf)
    out = chunked_running(df, ["k"], F.floor(F.col("t") / F.lit(chunk)), ["t", "seq"],
                          [Running("s", "sum", F.col("v")), Running("sx", "sum", F.col("v"), inclusive=False),
                           Running("m", "max", F.col("v")), Running("mx", "max", F.col("v"), inclusive=False),
                           Running("p", "prev", F.col("v"))]).toPandas().set_index("seq").sort_index()
    exp = pdf.sort_values(["k", "t", "seq"])
    g = exp.groupby("k")["v"]
    exp = exp.assign(s=g.cumsum(), m=g.cummax(), p=g.shift(1))
    exp["sx"] = exp["s"] - exp["v"]
    exp["mx"] = exp.groupby("k")["m"].shift(1)
    exp = exp.set_index("seq").sort_index()
    assert (out["s"].values == exp["s"].values).all()
    assert (out["sx"].values == exp["sx"].values).all()
    assert (out["m"].values == exp["m"].values).all()
    np.testing.assert_array_equal(out["mx"].astype(float).values, exp["mx"].astype(float).values)
    np.testing.assert_array_equal(out["p"].astype(float).values, exp["p"].astype(float).values)


def _reference_running(pdf):
    out = []
    for pid, g in pdf.sort_values(["arrival_ms", "seq"]).groupby("patient_id", sort=False):
        prev, counts, start = None, None, None
        for r in g.itertuples():
            if prev is None or r.arrival_ms - prev >= TTL_MS:
                counts, start = {"high": 0, "medium": 0, "low": 0}, r.arrival_ms
            counts[r.risk_level] += 1
            out.append((r.seq, sum(counts.values()), counts["high"], counts["medium"], counts["low"],
                        (r.arrival_ms - start) / 1000.0))
            prev = r.arrival_ms
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 6 * 86_400_000), st.integers(0, 7)),
                     min_size=1, max_size=50))
def test_patient_running_matches_sequential_state(spark, rows):
    _check_patient_running(spark, rows)


def _check_patient_running(spark, rows, rows_per_range=None):
    recs = []
    for i, (pid, arrival, hits) in enumerate(rows):
        age = 70 if hits >= 1 else 30
        flags = [1 if hits >= k else 0 for k in range(2, 8)]
        recs.append(dict(seq=i, id=f"r{i}", patient_id=pid, arrival_ms=arrival, event_time_ms=arrival,
                         watermark_ms=None, timestamp=arrival, age=age, bmi=31.0 if flags[0] else 20.0,
                         medication_count=6 if flags[1] else 1, length_of_stay=8 if flags[2] else 1,
                         diabetes=flags[3], hypertension=flags[4], cholesterol=241 if flags[5] else 100))
    pdf = pd.DataFrame(recs)
    df = spark.createDataFrame(pdf, "seq long, id string, patient_id long, arrival_ms long, event_time_ms long, "
                                    "watermark_ms long, timestamp long, age int, bmi double, medication_count int, "
                                    "length_of_stay int, diabetes int, hypertension int, cholesterol int")
    out = patient_risk_running(df, rows_per_range=rows_per_range).select("seq", "risk_level", "total_records", "high_risk_count",
                                          "medium_risk_count", "low_risk_count", "state_age_seconds").toPandas()
    levels = out.set_index("seq")["risk_level"]
    pdf["risk_level"] = pdf["seq"].map(levels)
    got = sorted((int(r.seq), int(r.total_records), int(r.high_risk_count), int(r.medium_risk_count),
                  int(r.low_risk_count), float(r.state_age_seconds)) for r in out.itertuples())
    assert got == _reference_running(pdf)


def test_ttl_gap_of_exactly_24h_expires(spark):
    day = TTL_MS
    rows = [(0, 1, 0), (1, 1, day - 1), (2, 1, 2 * day - 1), (3, 1, 3 * day - 1 + 1)]
    df = spark.createDataFrame(rows, "seq long, patient_id long, arrival_ms long")
    out = {r.seq: r for r in ttl_segments(df).collect()}
    assert [out[i].ttl_reset for i in range(4)] == [False, False, True, True]
    assert [out[i].segment for i in range(4)] == [1, 1, 2, 3]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 2_000_000), st.integers(0, 9)), min_size=1,
                    max_size=60))
def test_trailing_sum_matches_naive_range_sum(spark, pts):
    from pulseward.operators.alerts import trailing_sum
    pdf = pd.DataFrame([(k, t, float(v), i) for i, (k, t, v) in enumerate(pts)], columns=["k", "ts_ms", "x", "seq"])
    out = trailing_sum(spark.createDataFrame(pdf), ["k"], "x", 300_000).toPandas().set_index("seq").sort_index()
    for r in pdf.itertuples():
        sel = pdf[(pdf.k == r.k) & (pdf.ts_ms > r.ts_ms - 300_000) & (pdf.ts_ms <= r.ts_ms)]
        assert out.loc[r.seq, "x_sum"] == sel.x.sum()


def test_percentiles_of_crowded_values(spark, monkeypatch):
    """Many distinct values close together, and negative ones: ranges split them by count."""
    from pulseward.operators import scan
    from pulseward.operators.percentiles import exact_percentiles
    monkeypatch.setattr(scan, "ROWS_PER_RANGE", 50)
    rng = np.random.default_rng(0)
    vals = np.concatenate([30 + rng.random(900) / 1000, -rng.random(50) * 1e6, rng.random(50) * 1e6]).round(9)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(vals)], "k int, v double")
    got = exact_percentiles(df, "v", {"p50": 0.5, "p99": 0.99}).first()
    assert (got.p50, got.p99) == tuple(pytest.approx(np.percentile(vals, q), abs=2e-6) for q in (50, 99))
    for r in exact_percentiles(df, "v", {"p95": 0.95}, keys=["k"]).collect():
        assert r.p95 == pytest.approx(np.percentile(vals[r.k::3], 95), abs=2e-6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([0, 5, 5, 5, 60_000, 60_001, 130_000]), st.integers(-50, 50)),
                     min_size=1, max_size=60))
def test_recursive_struct_chunks_match_pandas(spark, rows):
    # many rows share one timestamp (a burst); chunks are (timestamp, block of 4 sequence numbers)
    pdf = pd.DataFrame([(t, v, i) for i, (t, v) in enumerate(rows)], columns=["t", "v", "seq"])
    chunk = F.struct(F.col("t").alias("a"), F.floor(F.col("seq") / F.lit(4)).alias("b"))
    out = chunked_running(spark.createDataFrame(pdf), [], chunk, ["t", "seq"],
                          [Running("mx", "max", F.col("v"), inclusive=False), Running("s", "sum", F.col("v")),
                           Running("p", "prev", F.col("v"))],
                          summary_chunk=lambda c: F.floor(c.getField("a") / F.lit(60_000)))
    got = out.toPandas().set_index("seq").sort_index()
    exp = pdf.sort_values(["t", "seq"])
    exp = exp.assign(s=exp["v"].cumsum(), p=exp["v"].shift(1), mx=exp["v"].cummax().shift(1)).set_index("seq").sort_index()
    assert (got["s"].values == exp["s"].values).all()
    np.testing.assert_array_equal(got["mx"].astype(float).values, exp["mx"].astype(float).values)
    np.testing.assert_array_equal(got["p"].astype(float).values, exp["p"].astype(float).values)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(1, 2), st.sampled_from([0, 7, 7, 7, 3_599_999, 3_600_000,
                                                                     90_000_000, 90_000_000]),
                               st.integers(0, 7)), min_size=1, max_size=40))
def test_patient_running_with_tiny_ranges(spark, rows):
    import pulseward.operators.scan as scan
    old = scan.SEQ_BLOCK
    scan.SEQ_BLOCK = 2          # bursts of one timestamp span several ranges
    try:
        _check_patient_running(spark, rows, rows_per_range=4)
    finally:
        scan.SEQ_BLOCK = old


def test_ranges_split_bursts_and_follow_the_order(spark):
    import pulseward.operators.scan as scan
    old, scan.SEQ_BLOCK = scan.SEQ_BLOCK, 10
    try:
        df = spark.createDataFrame([(5 if i < 80 else i, i) for i in range(100)], "ts long, seq long")
        got = [(r["_range"], r.ts, r.seq) for r in scan.with_ranges(df, "ts", "seq", rows=10).collect()]
    finally:
        scan.SEQ_BLOCK = old
    assert [x[1:] for x in sorted(got)] == sorted(x[1:] for x in got)
    sizes = {}
    for r, _, _ in got:
        sizes[r] = sizes.get(r, 0) + 1
    assert max(sizes.values()) <= 20 and len(sizes) >= 8
