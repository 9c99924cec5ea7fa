"""Risk distribution, PSI drift and quality limits.

Distribution: shares of high / medium / low; a missing level counts as medium; other levels only enter the
total. PSI: sum over the three levels of (a - e) * ln(a / e), skipping a level whose share is zero on either
side, then the absolute value; drift when PSI > 0.2 (strict); an empty side gives no PSI and no drift.
Everything is one pass of conditional counts (no join of the two periods).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half

LEVELS = ("high", "medium", "low")
# The limits of the quality rules.
PSI_LIMIT = 0.2
LATE_RATIO_LIMIT = 0.05
STATE_GROWTH_LIMIT = 0.10       # per hour
CHECKPOINT_LIMIT_MS = 30_000
LAG_LIMIT = 1000
P99_LIMIT_MS = 30.0


def level_of(col: str = "risk_level") -> Column:
    return F.coalesce(F.col(col), F.lit("medium"))


def distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    lvl = level_of()
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                *[F.count_if(lvl == l).alias(f"n_{l}") for l in LEVELS])
    return agg.select(*keys, "n", *[(F.col(f"n_{l}") / F.col("n")).alias(f"{l}_share") for l in LEVELS])


def psi_terms(expected: list[Column], actual: list[Column]) -> Column:
    total = F.lit(0.0)
    for e, a in zip(expected, actual):
        total = total + F.when((e > 0) & (a > 0), (a - e) * F.ln(a / e)).otherwise(F.lit(0.0))
    return F.abs(total)


def _psi_row(sides: DataFrame) -> DataFrame:
    """From one row of reference_records, r_<level>, current_records, c_<level>."""
    e = [F.col(f"r_{l}") / F.col("reference_records") for l in LEVELS]
    a = [F.col(f"c_{l}") / F.col("current_records") for l in LEVELS]
    both = (F.col("reference_records") > 0) & (F.col("current_records") > 0)
    psi = F.when(both, psi_terms(e, a))
    return sides.select("reference_records", "current_records", round_half(psi, 9).alias("psi"),
                        F.coalesce(psi > PSI_LIMIT, F.lit(False)).alias("drift"))


def psi_between(df: DataFrame, is_reference: Column) -> DataFrame:
    """One row: record counts of both sides, PSI (rounded to 9 digits) and the drift verdict."""
    lvl = level_of()
    ref, cur = is_reference, ~is_reference
    return _psi_row(df.agg(F.count_if(ref).alias("reference_records"), F.count_if(cur).alias("current_records"),
                           *[F.count_if(ref & (lvl == l)).alias(f"r_{l}") for l in LEVELS],
                           *[F.count_if(cur & (lvl == l)).alias(f"c_{l}") for l in LEVELS]))


def level_counts(where: Column) -> list[Column]:
    """Aggregates that count the rows ``where`` holds for, in all (``accepted``) and by level (``n_<level>``)."""
    return [F.count_if(where).alias("accepted"), *[F.count_if(where & (level_of() == l)).alias(f"n_{l}") for l in LEVELS]]


def psi_of_counts(counts: DataFrame, is_reference: Column) -> DataFrame:
    """``psi_between`` from mergeable counts per period (``level_counts``) instead of the records."""
    def total(col: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(col))), F.lit(0)).cast("long")

    return _psi_row(counts.agg(total("accepted", is_reference).alias("reference_records"),
                               total("accepted", ~is_reference).alias("current_records"),
                               *[total(f"n_{l}", is_reference).alias(f"r_{l}") for l in LEVELS],
                               *[total(f"n_{l}", ~is_reference).alias(f"c_{l}") for l in LEVELS]))


HOUR_MS = 3_600_000


def _hour(col: str) -> Column:
    return (F.floor(F.col(col) / F.lit(HOUR_MS)) * F.lit(HOUR_MS)).cast("long")


def hourly_quality(watermarked: DataFrame, scored_accepted: DataFrame, segments: DataFrame,
                   samples: DataFrame, p99_by_hour: DataFrame, ttl_ms: int) -> DataFrame:
    """One row per hour in which any row arrived (valid or not) or any metric sample was taken, with the six
    quality limits as boolean columns.

      late_ratio        late / valid records arriving in the hour                  > 0.05
      psi_prev_hour     PSI of the hour's level shares against the previous hour with accepted records  > 0.2
      state_growth      live patient states at the end of the hour vs one hour before, minus 1  > 0.10
      checkpoint_ms     slowest metric sample of the hour (duration proxy)         > 30000
      lag_records       records of the hour that arrived more than 5 s after their event time  > 1000
      p99_ms            exact p99 latency of the hour's metric samples             > 30

    Live states come from TTL segments: a segment is live from its first write until 24 h after its last
    write, so +1 / -1 events bucketed by hour and a running sum give the count per hour. All partial tables
    are keyed by hour and combined by union + aggregation; the only windows run over the hour table.
    """
    rows = watermarked.groupBy(_hour("arrival_ms").alias("hour_ms")).agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(F.col("error").isNull()).alias("valid_records"),
        F.count_if(F.col("late")).alias("late_records"),
        F.count_if(F.col("arrival_ms") - F.col("event_time_ms") > F.lit(5000)).alias("lag_records"))
    lvl = level_of()
    levels = scored_accepted.groupBy(_hour("arrival_ms").alias("hour_ms")).agg(
        F.count(F.lit(1)).alias("n_acc"), *[F.count_if(lvl == l).alias(f"n_{l}") for l in LEVELS])
    seg = segments.groupBy("patient_id", "segment").agg(F.min("arrival_ms").alias("s"),
                                                         F.max("arrival_ms").alias("e"))
    deltas = (seg.select(_hour("s").alias("hour_ms"), F.lit(1).alias("live_delta"))
              .unionByName(seg.select(_hour_expr(F.col("e") + F.lit(ttl_ms)).alias("hour_ms"),
                                      F.lit(-1).alias("live_delta")))
              .groupBy("hour_ms").agg(F.sum("live_delta").alias("live_delta")))
    smp = samples.groupBy(_hour("ts_ms").alias("hour_ms")).agg(
        F.count(F.lit(1)).alias("n_input"), F.max("latency_ms").alias("checkpoint_ms"))
    parts = [rows, levels, deltas, smp, p99_by_hour]
    cols = ["n_input", "valid_records", "late_records", "lag_records", "n_acc", *[f"n_{l}" for l in LEVELS], "live_delta",
            "checkpoint_ms", "p99_ms"]
    aligned = [p.select("hour_ms", *[F.col(c) if c in p.columns else F.lit(None).alias(c) for c in cols])
               for p in parts]
    union = aligned[0]
    for p in aligned[1:]:
        union = union.unionByName(p)
    hours = union.groupBy("hour_ms").agg(*[F.max(c).alias(c) for c in cols if c != "live_delta"],
                                         F.coalesce(F.sum("live_delta"), F.lit(0)).alias("live_delta"))
    w = Window.orderBy("hour_ms")   # over the hour table only (one row per hour of the time span)
    live = F.sum("live_delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    with_live = hours.withColumn("live_states", live).withColumn("prev_live", F.lag("live_states").over(w))
    # level shares of the last earlier hour with accepted records; in the same window, so the hour table is read once
    shares = [F.col(f"n_{l}") / F.col("n_acc") for l in LEVELS]
    prev = F.last(F.when(F.col("n_acc").isNotNull(), F.struct(*[s.alias(l) for s, l in zip(shares, LEVELS)])),
                  ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = with_live.withColumn("_prev", prev)
    psi = F.when(F.col("n_acc").isNotNull() & F.col("_prev").isNotNull(),
                 psi_terms([F.col(f"_prev.{l}") for l in LEVELS], shares))
    out = out.withColumn("psi_prev_hour", round_half(psi, 9)).filter(F.col("n_input") > 0)
    out = out.na.fill(0, ["valid_records", "late_records", "lag_records"])
    ratio = F.when(F.col("valid_records") > 0, F.col("late_records") / F.col("valid_records"))
    growth = F.when(F.col("prev_live") > 0, F.col("live_states") / F.col("prev_live") - 1)
    return out.select(
        "hour_ms", "valid_records", "late_records", round_half(ratio, 9).alias("late_ratio"),
        F.coalesce(ratio > LATE_RATIO_LIMIT, F.lit(False)).alias("late_flag"),
        "psi_prev_hour", F.coalesce(F.col("psi_prev_hour") > PSI_LIMIT, F.lit(False)).alias("drift_flag"),
        F.col("live_states").cast("long").alias("live_states"), round_half(growth, 9).alias("state_growth"),
        F.coalesce(growth > STATE_GROWTH_LIMIT, F.lit(False)).alias("growth_flag"),
        "checkpoint_ms", F.coalesce(F.col("checkpoint_ms") > CHECKPOINT_LIMIT_MS, F.lit(False)).alias("checkpoint_flag"),
        "lag_records", (F.col("lag_records") > LAG_LIMIT).alias("lag_flag"),
        "p99_ms", F.coalesce(F.col("p99_ms") > P99_LIMIT_MS, F.lit(False)).alias("p99_flag"))


def _hour_expr(c: Column) -> Column:
    return (F.floor(c / F.lit(HOUR_MS)) * F.lit(HOUR_MS)).cast("long")
