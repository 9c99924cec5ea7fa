"""Rounding and means that give the same double in every engine.

``round()`` is implemented differently across engines (Spark rounds the shortest decimal string of the
double, others scale and round), and floating sums depend on the summation order, so a value on a rounding
half can come out differently. The helpers below avoid both:

  round_half(x, d)  floor(x * 10^d + 0.5) / 10^d -- plain IEEE operations, identical wherever they run;
  exact mean        values scaled to integers (10 decimals) and summed as DECIMAL(38,0) -- exact and
                    order-independent -- then an integer half-up division to ``d`` decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_SCALE = 10   # decimals kept from each value before the exact sum


def round_half(x: Column | str, digits: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    p = float(10 ** digits)
    # from 2^53 on, a double has no fraction to round (and FLOOR's long would overflow)
    return F.when(F.abs(x * F.lit(p)) < F.lit(2.0 ** 53), F.floor(x * F.lit(p) + F.lit(0.5)) / F.lit(p)).otherwise(x)


def exact_mean_parts(col: str, name: str) -> list[Column]:
    """Aggregate columns for ``exact_mean``: the exact scaled sum and the count of non-null values."""
    scaled = (F.col(col) * F.lit(float(10 ** MEAN_SCALE))).cast("decimal(38,0)")
    return [F.sum(scaled).alias(f"_{name}_s"), F.count(F.col(col)).alias(f"_{name}_n")]


def exact_mean(name: str, digits: int = 6) -> Column:
    """The mean from ``exact_mean_parts`` rounded half-up to ``digits`` decimals (null for no values)."""
    d = 10 ** (MEAN_SCALE - digits)
    s, n = f"_{name}_s", f"_{name}_n"
    return F.expr(f"CASE WHEN {n} > 0 THEN ((2 * {s} + {n} * {d}) div (2 * {n} * {d})) / 1e{digits} END")
