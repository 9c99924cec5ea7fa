"""Watermark and late-record routing in batch.

Batch definition of the watermark seen by a record: the maximum event time over all rows that arrived
strictly earlier in arrival order (arrival_ms, seq) -- all rows, including malformed and invalid ones,
because the watermark is assigned before filtering -- minus the 5 s bound and 1 ms. A record is late when its
event time is below that watermark. The first arrival has no watermark (null) and is never late.

The running maximum is global (no key), so it is computed with ``chunked_running`` instead of an unpartitioned window:
the rows are shuffled once, to ranges of the arrival order of about equal row counts, and the maxima of the ranges (a
few thousand rows at most, besides bursts) give each range what came before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half
from ..functions.records import LATE_DELAY_MS, parse_records, with_checks
from .scan import Running, chunked_running, with_ranges

LATE_ALARM_RATIO = 0.05


def checked(feed_df: DataFrame) -> DataFrame:
    """Parse the feed once and add ``event_time_ms`` and ``error``."""
    return with_checks(parse_records(feed_df))


def with_watermark(checked_df: DataFrame, delay_ms: int = LATE_DELAY_MS,
                   rows_per_range: int | None = None) -> DataFrame:
    """Add ``watermark_ms`` and ``late`` (valid records only can be late)."""
    out = chunked_running(
        with_ranges(checked_df, "arrival_ms", "seq", rows=rows_per_range), keys=[], chunk=None, chunk_name="_range",
        order=["arrival_ms", "seq"],
        specs=[Running("_max_before", "max", F.col("event_time_ms"), inclusive=False)])
    wm = F.col("_max_before") - F.lit(delay_ms + 1)
    return (out.withColumn("watermark_ms", wm)
               .withColumn("late", F.col("error").isNull() & F.coalesce(F.col("event_time_ms") < wm, F.lit(False)))
               .drop("_max_before", "_range"))


def accepted(watermarked: DataFrame) -> DataFrame:
    """Valid, on-time records: the ones that update per-patient state."""
    return watermarked.filter(F.col("error").isNull() & ~F.col("late"))


def late_ratio(watermarked: DataFrame) -> DataFrame:
    """Late valid records over all valid records, with the > 5 % alarm."""
    valid = watermarked.filter(F.col("error").isNull())
    agg = valid.agg(F.count(F.lit(1)).alias("valid_records"),
                    F.count_if(F.col("late")).alias("late_records"))
    ratio = F.when(F.col("valid_records") > 0, F.col("late_records") / F.col("valid_records")).otherwise(F.lit(0.0))
    return agg.select("valid_records", "late_records", round_half(ratio, 9).alias("late_ratio"),
                      (ratio > LATE_ALARM_RATIO).alias("late_alarm"))
