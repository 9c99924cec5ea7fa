"""Selection of percentiles by histogram refinement: order of the codes, rounds, groups, plan shape."""

import math
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pulseward.operators import percentiles
from pulseward.operators.percentiles import selected_percentiles, with_ordered_code
from pulseward.plans.catalog import QUERIES

QS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.fixture
def many_rounds(monkeypatch):
    monkeypatch.setattr(percentiles, "BITS", 7)    # 10 rounds
    monkeypatch.setattr(percentiles, "SMALL", 1)


def test_codes_order_like_doubles_around_every_power_of_two(spark):
    powers = np.ldexp(1.0, np.arange(-1074, 1024))
    near = np.concatenate([powers, np.nextafter(powers, np.inf), np.nextafter(powers, 0)])
    values = np.unique(np.concatenate([near, -near, [0.0, np.inf, -np.inf, 0.1, 1 / 3, 1e308]]))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)] + [(len(values), math.nan)], "i int, v double")
    codes = [r.c for r in with_ordered_code(df, "v", "c").orderBy("i").select("c").collect()]
    assert all(a < b for a, b in zip(codes, codes[1:]))
    # the code of a positive double is its bit pattern
    finite = (values > 0) & np.isfinite(values)
    assert np.array_equal(np.array(codes[:-1])[finite], values[finite].view(np.int64))
    zeros = with_ordered_code(spark.createDataFrame([(0.0,), (-0.0,)], "v double"), "v", "c").collect()
    assert {r.c for r in zeros} == {0}


@pytest.mark.parametrize("kind", ["uniform", "heavy tail", "few values", "one value", "one row", "tiny and huge"])
def test_selection_equals_numpy(spark, many_rounds, kind):
    r = np.random.default_rng(5)
    values = {"uniform": r.uniform(-5, 5, 400), "heavy tail": r.standard_cauchy(400) * 1e6,
              "few values": r.integers(0, 4, 400).astype(float), "one value": np.full(50, 7.25),
              "one row": np.array([3.5]),
              "tiny and huge": np.concatenate([r.uniform(0, 1e-300, 100), r.uniform(0, 1e200, 100)])}[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = selected_percentiles(df, "v", QS, digits=12).first()
    for name, q in QS.items():
        assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-11), (kind, name)


def test_groups_are_selected_in_the_same_rounds(spark, many_rounds):
    r = np.random.default_rng(6)
    rows = [("a", float(v)) for v in r.normal(size=300)] + [("b", float(v)) for v in r.normal(50, 9, 77)]
    rows += [("other", 1e9), (None, 5.0), ("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = selected_percentiles(df, "v", {"_p50": 0.5, "_p99": 0.99}, F.col("g"), ("a", "b", "empty"), digits=9).first()
    for g in "ab":
        mine = [v for k, v in rows if k == g and v is not None]
        assert got[f"{g}_p50"] == pytest.approx(np.quantile(mine, 0.5), abs=1e-8)
        assert got[f"{g}_p99"] == pytest.approx(np.quantile(mine, 0.99), abs=1e-8)
    assert got["empty_p50"] is None and got["empty_p99"] is None


def test_no_rows(spark):
    assert selected_percentiles(spark.createDataFrame([], "v double"), "v", {"p50": 0.5}).collect() == [(None,)]


def test_compare_runs_plan(spark):
    """At most five exchanges and three scans, no join; no exchange is on the run or moves whole rows."""
    plan = QUERIES["compare_runs"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) <= 5, plan
    assert plan.count("FileScan") <= 3 and "Join" not in plan


def test_compare_runs_needs_both_runs(spark):
    from pulseward.operators.metrics import compare_runs
    df = spark.createDataFrame([(i, float(i)) for i in range(9)], "seq long, latency_ms double")
    assert compare_runs(df, F.lit("before")).collect() == []
    out = {r.metric: r for r in compare_runs(df, F.when(F.col("seq") < 5, "before").otherwise("after")).collect()}
    assert (out["p50"].before, out["p50"].after, out["mean"].improvement_pct) == (2.0, 6.5, -225.0)
