"""Exact percentiles, PSI properties, histograms and replay invariants."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pulseward.operators.percentiles import exact_percentiles
from pulseward.operators.quality import psi_between


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e3, 1e3, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=80),
       groups=st.integers(1, 3))
def test_exact_percentiles_match_numpy_linear(spark, values, groups):
    pdf = pd.DataFrame({"g": [i % groups for i in range(len(values))], "v": values})
    out = exact_percentiles(spark.createDataFrame(pdf), "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, keys=["g"],
                            digits=9).toPandas().set_index("g")
    for g, sub in pdf.groupby("g"):
        for name, q in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert abs(out.loc[g, name] - np.percentile(sub["v"].values, q)) < 1e-6


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(levels=st.lists(st.sampled_from(["high", "medium", "low"]), min_size=1, max_size=40))
def test_psi_of_identical_distributions_is_zero_and_symmetric(spark, levels):
    rows = [(lv, True) for lv in levels] + [(lv, False) for lv in levels]
    df = spark.createDataFrame(rows, "risk_level string, ref boolean")
    r = psi_between(df, F.col("ref")).collect()[0]
    assert r.psi == 0.0 and r.drift is False
    shifted = [(lv, True) for lv in levels] + [("high", False)] * len(levels)
    df2 = spark.createDataFrame(shifted, "risk_level string, ref boolean")
    a = psi_between(df2, F.col("ref")).collect()[0].psi
    b = psi_between(df2, ~F.col("ref")).collect()[0].psi
    assert a == b


def test_psi_empty_side_gives_no_drift(spark):
    df = spark.createDataFrame([("high", True)], "risk_level string, ref boolean")
    r = psi_between(df, F.col("ref")).collect()[0]
    assert r.psi is None and r.drift is False


def test_histograms_are_cumulative_and_end_at_count(spark):
    from pulseward.plans.catalog import QUERIES
    for name in ("latency_histogram", "batch_size_histogram"):
        rows = QUERIES[name](spark, SF_SMALL).collect()
        counts = [r.cumulative_count for r in rows]
        assert counts == sorted(counts)
        assert rows[-1].le == "+Inf" and counts[-1] == rows[-1].total_count


def test_shuffled_replay_epochs_are_permutations(spark):
    from pulseward.plans import catalog
    from pulseward.sources import loading
    rows = catalog._cleansed(spark, SF_SMALL)
    n = rows.count()
    rep = loading.replay_shuffled(rows, total=3 * n + 7, n_rows=n, rps=50, seed=42)
    per = rep.groupBy("epoch").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("seq").alias("d"),
                                   F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("epoch").collect()
    assert [(r.c, r.d) for r in per] == [(n, n), (n, n), (n, n), (7, 7)]
    assert all(r.lo == r.epoch * n and r.hi == r.epoch * n + r.c - 1 for r in per)
    # the order differs between epochs
    first = rep.filter(F.col("epoch") == 0).orderBy("i").select("seq").limit(20).collect()
    second = rep.filter(F.col("epoch") == 1).orderBy("i").select("seq").limit(20).collect()
    assert first != second


def test_shuffled_replay_record_ids(spark):
    from pulseward.plans import catalog
    from pulseward.sources import loading
    rows = catalog._cleansed(spark, SF_SMALL)
    r = loading.replay_shuffled(rows, total=5, n_rows=rows.count(), rps=50, seed=42).orderBy("i").first()
    assert r.i == 0 and r.timestamp == loading.T0_MS and r.id == f"medical_record_{r.patient_id}_{loading.T0_MS}"
