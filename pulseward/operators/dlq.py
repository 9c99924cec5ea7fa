"""Dead-letter rows (S11, T5): the envelope written for every record that fails parsing or validation.

Deviation from a job that fails on a bad record: invalid and failing rows are routed here and the job goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import raw_error_code
from ..schemas import RAW_COLUMNS

# Fixed value: the dead-letter topic.
DLQ_TOPIC = "dlq-medical"


def raw_dead_letters(raw: DataFrame, topic: str = DLQ_TOPIC) -> DataFrame:
    """The same envelope for raw rows that can't be reshaped (see ``raw_error_code``); they have no event time."""
    line = F.coalesce(F.col("corrupt"), F.to_json(F.struct(*RAW_COLUMNS)))
    return raw.withColumn("error", raw_error_code()).filter(F.col("error").isNotNull()).select(
        "seq", line.alias("original_data"), "error", F.lit(None).cast("long").alias("timestamp"),
        F.col("patient_id").cast("long").alias("key"), F.lit(topic).alias("topic"))


def dlq_envelope(checked: DataFrame, topic: str = DLQ_TOPIC) -> DataFrame:
    """(seq, original_data, error, timestamp, key, topic) for rows with a non-null ``error``."""
    return checked.filter(F.col("error").isNotNull()).select(
        "seq",
        F.col("value").alias("original_data"),
        "error",
        F.col("event_time_ms").alias("timestamp"),
        F.col("patient_id").alias("key"),
        F.lit(topic).alias("topic"))
