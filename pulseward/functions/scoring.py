"""Risk scores as column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the seven-factor score (all comparisons strict) and level cut-offs.
AGE_LIMIT = 65
BMI_LIMIT = 30
MEDICATION_LIMIT = 5
STAY_LIMIT = 7
CHOLESTEROL_LIMIT = 240
HIGH_CUT = 0.7
MEDIUM_CUT = 0.4

# Weights of the weighted score, in the order they are added.
WEIGHTS = [("age", 0.2), ("bmi", 0.15), ("medication_count", 0.15), ("length_of_stay", 0.2),
           ("diabetes", 0.15), ("hypertension", 0.15)]


def _hit(c: Column) -> Column:
    # a null comparison is "no hit" (diabetes/hypertension are compared with ==; other nulls never get here)
    return F.coalesce(c, F.lit(False)).cast("int")


def factor_hits() -> list[Column]:
    return [
        _hit(F.col("age") > AGE_LIMIT),
        _hit(F.col("bmi") > BMI_LIMIT),
        _hit(F.col("medication_count") > MEDICATION_LIMIT),
        _hit(F.col("length_of_stay") > STAY_LIMIT),
        _hit(F.col("diabetes") == 1),
        _hit(F.col("hypertension") == 1),
        _hit(F.col("cholesterol") > CHOLESTEROL_LIMIT),
    ]


def hit_count() -> Column:
    hits = factor_hits()
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def seven_factor_score() -> Column:
    """Number of factors that fire, divided by 7."""
    return hit_count().cast("double") / F.lit(7.0)


def risk_level(score: Column) -> Column:
    """R2: > 0.7 high, > 0.4 medium, else low."""
    return (F.when(score > HIGH_CUT, F.lit("high"))
             .when(score > MEDIUM_CUT, F.lit("medium"))
             .otherwise(F.lit("low")))


def weighted_score() -> Column:
    """Mean of the weights that fired; 0.5 when none fired.

    A null in a feature compared with ``>`` (age, bmi, medication_count, length_of_stay) makes the
    evaluation fail: the score is null and R4 turns it into 'medium'. Null diabetes / hypertension
    (compared with ``==``) simply do not fire."""
    conds = {
        "age": F.col("age") > AGE_LIMIT,
        "bmi": F.col("bmi") > BMI_LIMIT,
        "medication_count": F.col("medication_count") > MEDICATION_LIMIT,
        "length_of_stay": F.col("length_of_stay") > STAY_LIMIT,
        "diabetes": F.col("diabetes") == 1,
        "hypertension": F.col("hypertension") == 1,
    }
    total, fired = F.lit(0.0), F.lit(0)
    for name, weight in WEIGHTS:
        on = F.coalesce(conds[name], F.lit(False))
        total = total + F.when(on, F.lit(weight)).otherwise(F.lit(0.0))
        fired = fired + on.cast("int")
    failed = (F.col("age").isNull() | F.col("bmi").isNull() | F.col("medication_count").isNull()
              | F.col("length_of_stay").isNull())
    return F.when(failed, F.lit(None).cast("double")).when(fired > 0, total / fired).otherwise(F.lit(0.5))


def weighted_level(score: Column) -> Column:
    """R2 thresholds on R3; a null score (failed evaluation) is medium."""
    return F.when(score.isNull(), F.lit("medium")).otherwise(risk_level(score))


def linear_score() -> Column:
    """(age/100 + bmi/40 + medication_count/10) / 3."""
    return (F.col("age") / F.lit(100.0) + F.col("bmi") / F.lit(40.0)
            + F.col("medication_count") / F.lit(10.0)) / F.lit(3.0)


def softmax(logits: Column) -> Column:
    """Numerically stable softmax over an ARRAY<DOUBLE>."""
    exps = _bound(F.array_max(logits), lambda m: F.transform(logits, lambda x: F.exp(x - m)))
    return _bound(exps, lambda e: _bound(F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
                                         lambda total: F.transform(e, lambda x: x / total)))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, not in every step of a lambda."""
    return F.transform(F.array(value), use)[0]


def argmax(values: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(values, F.array_max(values)) - 1
