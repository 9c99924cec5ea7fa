"""The live path as Structured Streaming queries.

``risk_stream``: parse -> event time -> watermark of 5 s assigned to *all* parsed rows (bad rows move it
too) -> keep valid rows -> risk level (column expressions) -> ``groupBy(patient_id)`` and a stateful
operator: ``transformWithStateInPandas`` (TTL ValueState, default) or ``applyInPandasWithState``.
Catalyst pushes every conjunct that leaves the event time alone below the watermark node, where bad rows would no
longer move it; validity is therefore one expression over the event time (its value on valid rows, null on others).
``dlq_stream``: the same parse, rows with an error, as dead-letter envelopes.

Both run with the RocksDB state store (required by ``transformWithState``), a checkpoint folder per query
and idempotent ``foreachBatch`` sinks (``sinks``); restart from the checkpoint resumes without losses or
duplicates. ``spark.sql.shuffle.partitions`` is fixed by the checkpoint of a stateful query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scoring import risk_level, seven_factor_score
from ..operators.dlq import dlq_envelope
from ..operators.lateness import checked
from .pandas_state import PANDAS_STATE_SCHEMA, make_state_fn
from .processor import OUTPUT_SCHEMA, TTL_MS, PatientRiskProcessor
from .sinks import dlq_batch_writer, risk_batch_writer

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK_DELAY = "5 seconds"


def configure(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def risk_stream(feed_stream: DataFrame, ttl_ms: int = TTL_MS, delay: str = WATERMARK_DELAY,
                engine: str = "tws") -> DataFrame:
    """Stateful per-patient stream. ``engine``: 'tws' (``transformWithStateInPandas`` with a TTL ValueState, default)
    or 'pandas' (``applyInPandasWithState``, state in the Arrow batch). Both count with the same numpy function per
    key and micro-batch and emit the same rows."""
    parsed = checked(feed_stream).withColumn("event_time", F.timestamp_millis(F.col("event_time_ms")))
    watermarked = parsed.withWatermark("event_time", delay)
    valid = watermarked.filter(F.when(F.col("error").isNull(), F.col("event_time")).isNotNull())
    # ``event_time`` carries the watermark metadata; the stateful operator must see it to read the watermark
    scored = valid.withColumn("risk_level", risk_level(seven_factor_score())).select(
        "patient_id", "seq", "id", "arrival_ms", "event_time", "event_time_ms", "timestamp", "risk_level", "age",
        "bmi", "medication_count", "length_of_stay")
    grouped = scored.groupBy("patient_id")
    if engine == "tws":
        return grouped.transformWithStateInPandas(PatientRiskProcessor(ttl_ms), OUTPUT_SCHEMA, "Append",
                                                  "ProcessingTime")
    if engine == "pandas":
        return grouped.applyInPandasWithState(make_state_fn(ttl_ms), OUTPUT_SCHEMA, PANDAS_STATE_SCHEMA, "append",
                                              "ProcessingTimeTimeout")
    raise ValueError(f"unknown engine {engine!r}")


def dlq_stream(feed_stream: DataFrame) -> DataFrame:
    return dlq_envelope(checked(feed_stream))


def start_risk_query(feed_stream: DataFrame, out_root: str, checkpoint: str, ttl_ms: int = TTL_MS,
                     trigger: dict | None = None, name: str | None = None, engine: str = "tws",
                     kafka_bootstrap: str | None = None) -> StreamingQuery:
    configure(feed_stream.sparkSession)
    w = (risk_stream(feed_stream, ttl_ms, engine=engine).writeStream.outputMode("append")
         .foreachBatch(risk_batch_writer(out_root, kafka_bootstrap=kafka_bootstrap))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def start_dlq_query(feed_stream: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None,
                    kafka_bootstrap: str | None = None) -> StreamingQuery:
    w = (dlq_stream(feed_stream).writeStream.outputMode("append")
         .foreachBatch(dlq_batch_writer(out_root, kafka_bootstrap)).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()
