"""Running per-patient risk counters with a 24 h state lifetime, in batch.

Semantics of the live keyed state, restated over a finished table of accepted records ordered per patient by
arrival (arrival_ms, seq):
  * the state expires when it has not been written for 24 h or more (the gap is measured in arrival time
    between accepted records; late and invalid rows never write it); a new segment then starts from zero;
  * after each record: total / high / medium / low counts of the segment, high ratio, ``last_activity`` (the
    record's own timestamp field -- the last processed record, not the maximum) and the state age (arrival
    time since the segment started, in seconds; arrival replaces wall clock).

Plan (no single-task window even for a patient -- or one patient in one millisecond -- with a third of all rows): the
rows are cut into ranges of the arrival order of about equal row counts (``scan.with_ranges``) and shuffled once, on
(patient, range). A window in each (patient, range) finds the gaps, the segments that start inside and the counts in
them. One carry row per (patient, range) -- first and last arrival, starts inside, counts after the last start -- is
enough to tell, by a window over the ranges of a patient, what the segment that is open at the range's start holds; it
is joined back on (patient, range), by which the rows are partitioned already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import risk_level, seven_factor_score
from .scan import with_ranges

TTL_MS = 24 * 3600 * 1000
LEVELS = ("high", "medium", "low")


def scored(accepted_df: DataFrame) -> DataFrame:
    return accepted_df.withColumn("risk_level", risk_level(seven_factor_score()))


def _segmented(df: DataFrame, ttl_ms: int, with_levels: bool, rows_per_range: int | None) -> DataFrame:
    keys = ["patient_id", "_range"]
    counted = ["total", *LEVELS] if with_levels else ["total"]
    is_level = {"total": F.lit(1), **{l: (F.col("risk_level") == l).cast("int") for l in LEVELS}}

    # inside a range: gaps, segments that start there, counts since the range's start
    w = Window.partitionBy(*keys).orderBy("arrival_ms", "seq")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = with_ranges(df, "arrival_ms", "seq", rows=rows_per_range)
    rows = rows.withColumn("_prev", F.lag("arrival_ms").over(w))
    rows = rows.withColumn("_starts", F.coalesce(F.col("arrival_ms") - F.col("_prev") >= F.lit(ttl_ms), F.lit(False)))
    rows = rows.select("*", F.sum(F.col("_starts").cast("long")).over(upto).alias("_local"),
                       *[F.sum(is_level[c]).over(upto).alias(f"_n_{c}") for c in counted])
    before = lambda c: F.col(f"_n_{c}") - is_level[c]  # noqa: E731  count before the row
    rows = rows.select("*", F.max(F.when(F.col("_starts"), F.col("arrival_ms"))).over(upto).alias("_start_ms"),
                       *[F.max(F.when(F.col("_starts"), before(c))).over(upto).alias(f"_b_{c}") for c in counted])

    # the carry rows of a patient, in range order
    carry = rows.groupBy(*keys).agg(
        F.min("arrival_ms").alias("_first"), F.max("arrival_ms").alias("_last"), F.max("_local").alias("_inside"),
        F.max("_start_ms").alias("_inside_ms"),
        *[(F.max(f"_n_{c}") - F.coalesce(F.max(f"_b_{c}"), F.lit(0))).alias(f"_t_{c}") for c in counted])
    wr = Window.partitionBy("patient_id").orderBy("_range")
    earlier = wr.rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.withColumn("_before", F.lag("_last").over(wr))
    carry = carry.withColumn("_new", F.col("_before").isNull() | (F.col("_first") - F.col("_before") >= F.lit(ttl_ms)))
    opened = F.coalesce(F.col("_inside_ms"), F.when(F.col("_new"), F.col("_first")))   # start of the segment left open
    carry = carry.select("*", opened.alias("_opened"),
                         *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_sum_{c}") for c in counted])
    carried = [F.when(F.col("_new"), F.lit(0)).otherwise(
        F.col(f"_sum_{c}") - F.max(F.when(F.col("_opened").isNotNull(), F.col(f"_sum_{c}"))).over(earlier))
        .alias(f"_c_{c}") for c in counted]
    segments = F.coalesce(F.sum(F.col("_inside") + F.col("_new").cast("long")).over(earlier), F.lit(0))
    carry = carry.select(
        *keys, "_before", *carried, (segments + F.col("_new").cast("long")).alias("_segments"),
        F.when(F.col("_new"), F.col("_first")).otherwise(F.max("_opened").over(earlier)).alias("_open_ms"))

    out = rows.join(carry, keys)
    prev = F.coalesce("_prev", "_before")
    first_segment = F.col("_local") == 0
    return out.select(
        *df.columns, prev.alias("prev_arrival_ms"), (F.col("arrival_ms") - prev).alias("gap_ms"),
        F.coalesce(F.col("arrival_ms") - prev >= F.lit(ttl_ms), F.lit(False)).alias("ttl_reset"),
        (F.col("_segments") + F.col("_local")).alias("segment"),
        F.when(first_segment, F.col("_open_ms")).otherwise(F.col("_start_ms")).alias("_seg_start_ms"),
        *[(F.col(f"_n_{c}") + F.when(first_segment, F.col(f"_c_{c}")).otherwise(-F.col(f"_b_{c}"))).cast("long")
          .alias(f"_seg_{c}") for c in counted])


def ttl_segments(accepted_df: DataFrame, ttl_ms: int = TTL_MS, rows_per_range: int | None = None) -> DataFrame:
    """Per accepted record the previous arrival of the patient, the gap, the reset flag and segment number."""
    out = _segmented(accepted_df, ttl_ms, False, rows_per_range)
    return out.select(*accepted_df.columns, "prev_arrival_ms", "gap_ms", "ttl_reset", "segment")


def patient_risk_running(accepted_df: DataFrame, ttl_ms: int = TTL_MS,
                         rows_per_range: int | None = None) -> DataFrame:
    """A1-A3 over accepted records; one output row per record (flat columns, see module docstring)."""
    out = _segmented(scored(accepted_df), ttl_ms, True, rows_per_range)
    total, high = F.col("_seg_total"), F.col("_seg_high")
    return out.select(
        "seq", "id", "patient_id", "risk_level", "arrival_ms", "event_time_ms", "watermark_ms", "segment",
        total.alias("total_records"),
        high.alias("high_risk_count"),
        F.col("_seg_medium").alias("medium_risk_count"),
        F.col("_seg_low").alias("low_risk_count"),
        F.when(total > 0, high / total).otherwise(F.lit(0.0)).alias("high_risk_ratio"),
        F.col("timestamp").alias("last_activity"),
        ((F.col("arrival_ms") - F.col("_seg_start_ms")) / F.lit(1000.0)).alias("state_age_seconds"),
        "age", "bmi", "medication_count", "length_of_stay")


def as_result_rows(running: DataFrame) -> DataFrame:
    """Nested result rows as the live path emits them (wall-clock latency excluded in batch)."""
    return running.select(
        F.col("id").alias("record_id"), "patient_id", "risk_level",
        F.struct("total_records", "high_risk_count", "medium_risk_count", "low_risk_count", "high_risk_ratio",
                 "last_activity", "state_age_seconds").alias("patient_stats"),
        F.col("event_time_ms").alias("processing_timestamp"),
        F.lit(None).cast("double").alias("processing_latency_ms"),
        F.col("watermark_ms").alias("watermark"),
        F.struct("age", "bmi", "medication_count", "length_of_stay").alias("features"))
