"""Golden micro-cases for the scores (worked out by hand from the definitions)."""

import math

import pytest
from pyspark.sql import functions as F

from pulseward.functions import scoring


def _score(spark, rows):
    schema = ("age int, bmi double, medication_count int, length_of_stay int, diabetes int, hypertension int, "
              "cholesterol int")
    df = spark.createDataFrame(rows, schema)
    s = scoring.seven_factor_score()
    w = scoring.weighted_score()
    return df.select(scoring.hit_count().alias("hits"), s.alias("score"), scoring.risk_level(s).alias("level"),
                     w.alias("w"), scoring.weighted_level(w).alias("wl"), scoring.linear_score().alias("lin")).collect()


def test_demo_rows(spark):
    # demo row 1: only diabetes fires; row 2: age and hypertension (cholesterol 240, meds 5, stay 7 are not hits)
    out = _score(spark, [(65, 25.5, 3, 5, 1, 0, 200), (72, 28.1, 5, 7, 0, 1, 240)])
    assert [r.hits for r in out] == [1, 2]
    assert [r.level for r in out] == ["low", "low"]
    assert out[0].score == pytest.approx(1 / 7)


def test_levels_by_hits(spark):
    base = [66, 31.0, 6, 8, 1, 1, 241]           # all seven factors fire
    rows = []
    for hits in range(8):
        r = list(base)
        off = [(0, 65), (1, 30.0), (2, 5), (3, 7), (4, 0), (5, 0), (6, 240)]
        for k in range(7 - hits):
            i, v = off[k]
            r[i] = v
        rows.append(tuple(r))
    out = _score(spark, rows)
    assert [r.hits for r in out] == list(range(8))
    assert [r.level for r in out] == ["low", "low", "low", "medium", "medium", "high", "high", "high"]


def test_weighted_score_table(spark):
    # the five scoring dicts: fired weights averaged, 0.5 when nothing fires; high cannot occur
    rows = [(70, 32.0, 6, 8, 1, 1, 0), (45, 25.0, 2, 3, 0, 0, 0), (80, 28.0, 8, 10, 1, 1, 0),
            (35, 22.0, 1, 2, 0, 0, 0), (60, 35.0, 4, 6, 1, 0, 0)]
    out = _score(spark, rows)
    assert [round(r.w, 6) for r in out] == [round(1.0 / 6, 6), 0.5, 0.17, 0.5, 0.15]
    assert [r.wl for r in out] == ["low", "medium", "low", "medium", "low"]


def test_linear_score(spark):
    out = _score(spark, [(70, 32.0, 6, 8, 1, 1, 0)])
    assert out[0].lin == pytest.approx((0.7 + 0.8 + 0.6) / 3)


def test_softmax_argmax(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 3.0],), ([1000.0, -1000.0],)], "x array<double>")
    p = scoring.softmax(F.col("x"))
    out = df.select(p.alias("p"), scoring.argmax(p).alias("c")).collect()
    e = math.exp(1.0)
    assert out[0].p[1] == pytest.approx(e / (1 + e)) and out[0].c == 1
    assert out[1].c == 0 and out[1].p[0] == pytest.approx(0.5)      # tie -> first class
    assert out[2].p[0] == pytest.approx(1.0) and out[2].c == 0       # stable for large logits


def test_weighted_score_null_feature_is_medium(spark):
    df = spark.createDataFrame([(None, 32.0, 6, 8, 1, 1, 0), (70, 32.0, 6, 8, None, None, 0)],
                               "age int, bmi double, medication_count int, length_of_stay int, diabetes int, "
                               "hypertension int, cholesterol int")
    w = scoring.weighted_score()
    out = df.select(w.alias("w"), scoring.weighted_level(w).alias("l")).collect()
    assert out[0].w is None and out[0].l == "medium"
    assert round(out[1].w, 6) == round(0.7 / 4, 6) and out[1].l == "low"
