"""Patient feature table: upsert (S13) and lookup with defaults.

Upsert semantics per call ``update(patient, score, ts)``: ``record_count`` + 1 and ``last_activity`` = the ts of
the call written last. In batch this is one aggregation per patient (partial aggregation map-side, so a hot
patient is combined before the shuffle); ``max_by`` over (arrival_ms, seq) picks the last write.

Lookup: a left join; an unknown patient gets the whole default row (record_count 0, avg_risk_score 0.5,
last_activity 0, risk_trend 0). The table stores only record_count and last_activity, so avg_risk_score and
risk_trend always come from the defaults. The feature table grows with the number of patients, so it is not
broadcast by hint; AQE broadcasts it only after measuring it, and splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of a feature row.
DEFAULT_RECORD_COUNT = 0
DEFAULT_AVG_RISK = 0.5
DEFAULT_LAST_ACTIVITY = 0
DEFAULT_RISK_TREND = 0.0


def upsert_features(writes: DataFrame, ts: str = "timestamp") -> DataFrame:
    """(patient_id, record_count, last_activity) after applying ``writes`` in (arrival_ms, seq) order."""
    return writes.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max_by(F.col(ts), F.struct("arrival_ms", "seq")).alias("last_activity"))


def merge_features(current: DataFrame, batch_update: DataFrame) -> DataFrame:
    """Apply one micro-batch of upserts to a stored table: counts add up, last_activity is replaced."""
    joined = current.alias("c").join(batch_update.alias("u"), "patient_id", "full_outer")
    return joined.select(
        "patient_id",
        (F.coalesce(F.col("c.record_count"), F.lit(0)) + F.coalesce(F.col("u.record_count"), F.lit(0)))
        .alias("record_count"),
        F.coalesce(F.col("u.last_activity"), F.col("c.last_activity")).alias("last_activity"))


def lookup_features(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Left-join requests (must have ``patient_id``) with the feature table and fill defaults."""
    f = features.select("patient_id", "record_count", "last_activity", F.lit(True).alias("_known"))
    j = requests.join(f, "patient_id", "left")
    known = F.coalesce(F.col("_known"), F.lit(False))
    return j.select(
        *[c for c in requests.columns],
        F.when(known, F.col("record_count")).otherwise(F.lit(DEFAULT_RECORD_COUNT).cast("long")).alias("record_count"),
        F.lit(DEFAULT_AVG_RISK).alias("avg_risk_score"),
        F.when(known, F.col("last_activity")).otherwise(F.lit(DEFAULT_LAST_ACTIVITY).cast("long")).alias("last_activity"),
        F.lit(DEFAULT_RISK_TREND).alias("risk_trend"),
        known.alias("known_patient"))
