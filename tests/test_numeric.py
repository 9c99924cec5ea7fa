"""Engine-independent rounding and exact means."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pulseward.functions.numeric import exact_mean, exact_mean_parts, round_half


def test_round_half_formula(spark):
    df = spark.createDataFrame([(0.5,), (1.25,), (-1.25,), (2.675,), (43.4728125,)], "x double")
    got = [r.r for r in df.select(round_half("x", 1).alias("r")).collect()]
    assert got == [0.5, 1.3, -1.2, 2.7, 43.5]  # half goes up (towards +inf); plain IEEE steps


def test_exact_mean_is_order_independent_and_half_up(spark):
    rng = random.Random(11)
    vals = [round(rng.uniform(0, 500), 2) for _ in range(997)]
    expected = (sum(Decimal(str(v)) for v in vals) / len(vals)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    for order in (vals, list(reversed(vals))):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(7)
        got = df.agg(*exact_mean_parts("v", "m")).select(exact_mean("m", 6).alias("m")).first().m
        assert Decimal(str(got)) == expected


def test_exact_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(*exact_mean_parts("v", "m")).select(exact_mean("m").alias("m")).first().m is None


def test_round_half_of_large_values(spark):
    from pulseward.functions.numeric import round_half
    vals = [9.3e9, 1e300, -4e18, 123456789.5, 0.1234567895]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(round_half("v", 9)).collect()][:4] == vals[:4]
