"""Inputs derived from the supplied tables for the metric, alert, loading and text operators.

  metric_samples  (seq, stage, ts_ms, latency_ms, ok, batch_size, is_batch) from ``events``:
                  event_id, event_type, epoch ms of ts, value, event_type <> 'error', 1 + event_id % 120; a
                  request for one record is a single request, the others are batch requests
  metric_series   (series, seq, ts_ms, value) from ``events``; see ``metric_series``
  raw_rows        raw CSV-shaped rows (schema of a discharge file) from the record feed; see ``raw_rows``
  logits          (vec_id, logits ARRAY<DOUBLE>): ``embeddings.embedding``, a logit per class
  texts           (doc_id, text, quality) from ``documents`` left-joined with ``labels``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import epoch_ms
from ..tables import read_table
from .feed import feed_fields

# Metric series names carried by each event type, and the counter's reset period.
SERIES_BY_EVENT = {"view": "latency_p99_ms", "click": "backpressured", "purchase": "kafka_lag"}
COUNTER_SERIES = "failed_checkpoints"
COUNTER_EVENT = "error"
COUNTER_RESET_EVERY = 500
DUPLICATE_SEQ_OFFSET = 1_000_000_000_000


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("stage"),
        epoch_ms(ev, "ts").alias("ts_ms"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") != F.lit("error")).alias("ok"),
        (1 + F.col("event_id") % 120).alias("batch_size"),
        (F.col("event_id") % 120 != 0).alias("is_batch"))


def counter_value(event_id) -> F.Column:
    """Running sum of ``event_id % 5`` since the last reset (resets where event_id % 500 = 0), in closed form."""
    d = event_id % COUNTER_RESET_EVERY
    r = (d + 1) % 5
    return (F.floor((d + 1) / 5) * 10 + r * (r - 1) / 2).cast("long")


def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge series: view -> latency_p99_ms (value), click -> backpressured (value > 250 -> 1, else 0),
    purchase -> kafka_lag (value * 4); counter series failed_checkpoints sampled at error events."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    et, v = F.col("event_type"), F.col("value")
    series = (F.when(et == "view", F.lit(SERIES_BY_EVENT["view"]))
               .when(et == "click", F.lit(SERIES_BY_EVENT["click"]))
               .when(et == "purchase", F.lit(SERIES_BY_EVENT["purchase"]))
               .when(et == COUNTER_EVENT, F.lit(COUNTER_SERIES)))
    value = (F.when(et == "view", v)
              .when(et == "click", F.when(v > 250, F.lit(1.0)).otherwise(F.lit(0.0)))
              .when(et == "purchase", v * 4)
              .when(et == COUNTER_EVENT, counter_value(F.col("event_id")).cast("double")))
    return ev.select(series.alias("series"), F.col("event_id").alias("seq"), epoch_ms(ev, "ts").alias("ts_ms"),
                     value.alias("value")).filter(F.col("series").isNotNull())


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw discharge rows with a file position ``seq``: Yes/No text, ``blood_pressure`` as 'sys/dia', a null
    gender where event_id % 59 = 0 and a repeated copy of every row with event_id % 71 = 0 at the end."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    f = feed_fields(ev)
    yn = lambda c: F.when(c == 1, F.lit("Yes")).otherwise(F.lit("No"))
    base = f.select(
        "seq",
        F.col("patient_id").cast("int").alias("patient_id"),
        "age",
        F.when(F.col("seq") % 59 == 0, F.lit(None).cast("string")).otherwise(F.col("gender")).alias("gender"),
        F.concat(F.col("systolic_bp").cast("string"), F.lit("/"), F.col("diastolic_bp").cast("string"))
         .alias("blood_pressure"),
        "cholesterol", "bmi",
        yn(F.col("diabetes")).alias("diabetes"),
        yn(F.col("hypertension")).alias("hypertension"),
        "medication_count", "length_of_stay", "discharge_destination",
        F.when(F.col("readmission_risk_raw") == 1.0, F.lit("Yes")).otherwise(F.lit("No")).alias("readmitted_30_days"))
    dups = base.filter(F.col("seq") % 71 == 0).withColumn("seq", F.col("seq") + F.lit(DUPLICATE_SEQ_OFFSET))
    return base.unionByName(dups)


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("logits"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return docs.join(labels, "doc_id", "left")
