"""Idempotent micro-batch sinks (S6, S11, T5, T8, stream side of S13) and the feature lookup of the live path.

Every sink is a versioned table (``manifest``): one folder per micro-batch, listed by a version file that is put in
place atomically. A batch that is replayed after a failure is written once: if its commit is there it is skipped, if
not its folder is overwritten. ``compact`` folds the folders of a table next to a running query. Readers get a
``batch_id`` column.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import lookup_features, merge_features, upsert_features
from ..operators.quality import level_counts, psi_of_counts
from .manifest import Table

TABLES = ("results", "late", "dlq", "feature_updates", "batch_counts", "alerts")


def _write(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    Table(df.sparkSession, root, table).write(df, batch_id)


def compact(spark: SparkSession, root: str, tables: tuple[str, ...] = TABLES) -> dict[str, int]:
    """Compacts and cleans the stream's tables; {table: last batch folded}. Safe next to the running queries."""
    done = {}
    for name in tables:
        table = Table(spark, root, name)
        last = table.compact()
        if last is not None:
            table.vacuum()
            done[name] = last
    return done


def result_rows(out: DataFrame, *more: str) -> DataFrame:
    """The nested result rows of the live path, and the columns ``more``."""
    return out.select(
        "seq", "record_id", "patient_id", "risk_level",
        F.struct("total_records", "high_risk_count", "medium_risk_count", "low_risk_count", "high_risk_ratio",
                 "last_activity", "state_age_seconds").alias("patient_stats"),
        "processing_timestamp", "processing_latency_ms", "watermark",
        F.struct("age", "bmi", "medication_count", "length_of_stay").alias("features"), *more)


def with_patient_features(results: DataFrame, root: str, batch_id: int) -> DataFrame:
    """S12/J1 in the live path: the rows with ``patient_features``, the stored features of their patients as of the
    micro-batches before ``batch_id``, defaults for unknown patients. The feature table is looked up anew in every
    micro-batch, so a replayed batch sees what it saw before. A left join: shuffled by patient beyond AQE's
    broadcast size."""
    spark = results.sparkSession
    stored = read_features(spark, root, batch_id)
    if stored is None:
        stored = spark.createDataFrame([], "patient_id long, record_count long, last_activity long")
    kept = results.columns
    names = ("record_count", "avg_risk_score", "last_activity", "risk_trend", "known_patient")
    renamed = results.withColumnRenamed("last_activity", "_last") if "last_activity" in kept else results
    j = lookup_features(renamed, stored).withColumn("patient_features", F.struct(*names)).drop(*names)
    return j.withColumnRenamed("_last", "last_activity").select(*kept, "patient_features")


def risk_batch_writer(root: str, with_features: bool = True, kafka_bootstrap: str | None = None,
                      results_topic: str = "medical-risk-results"):
    """foreachBatch function for the stateful query: results, late rows and feature updates.

    With ``kafka_bootstrap`` the results are also sent to ``results_topic`` as JSON (S6). That copy is
    at-least-once: a micro-batch replayed after a failure is sent again (the parquet tables are overwritten
    per batch and stay exactly-once).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            results = batch.filter(F.col("kind") == "result")
            if with_features:
                enriched = with_patient_features(results, root, batch_id)
                _write(result_rows(enriched, "patient_features"), root, "results", batch_id)
            else:
                _write(result_rows(results), root, "results", batch_id)
            if kafka_bootstrap:
                (kafka_sink_frame(results).write.format("kafka")
                 .option("kafka.bootstrap.servers", kafka_bootstrap).option("topic", results_topic).save())
            _write(batch.filter(F.col("kind") == "late").select(
                "seq", "record_id", "patient_id", "processing_timestamp", "watermark", "arrival_ms"),
                root, "late", batch_id)
            # One row of mergeable counts per micro-batch
            _write(batch.agg(*level_counts(F.col("kind") == "result"), F.count_if(F.col("kind") == "late").alias("late")),
                   root, "batch_counts", batch_id)
            if with_features:
                updates = upsert_features(results.select(
                    "patient_id", "seq", "arrival_ms", F.col("last_activity").alias("timestamp")))
                _write(updates, root, "feature_updates", batch_id)
        finally:
            batch.unpersist()
    return write


def dlq_batch_writer(root: str, kafka_bootstrap: str | None = None):
    """foreachBatch function for dead letters: the table, and with ``kafka_bootstrap`` their topic too (at least once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _write(batch, root, "dlq", batch_id)
        if kafka_bootstrap:
            rows = read_table(batch.sparkSession, root, "dlq").where(F.col("batch_id") == batch_id)
            (kafka_dlq_frame(rows).write.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap).save())
    return write


def kafka_dlq_frame(dlq: DataFrame) -> DataFrame:
    """topic/key/value frame of dead letters (value = JSON of the envelope)."""
    envelope = F.struct("original_data", "error", "timestamp", "key")
    return dlq.select("topic", F.col("key").cast("string").alias("key"), F.to_json(envelope).alias("value"))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The committed rows of a table, with their ``batch_id``."""
    rows = Table(spark, root, table).read()
    if rows is None:
        raise FileNotFoundError(f"{root}: no micro-batch of {table} has been committed")
    return rows


def _fold(updates: DataFrame) -> DataFrame:
    return updates.groupBy("patient_id").agg(
        F.sum("record_count").alias("record_count"),
        F.max_by("last_activity", F.col("batch_id")).alias("last_activity"))


def _snapshot(spark: SparkSession, root: str, before: int | None):
    """(the latest snapshot of batches before ``before``, its last batch), or (None, None)."""
    try:
        snaps = spark.read.parquet(f"{root.rstrip('/')}/feature_snapshot")
    except AnalysisException:   # no snapshot written yet
        return None, None
    snaps = snaps if before is None else snaps.where(F.col("upto") < before)
    upto = snaps.agg(F.max("upto")).first()[0]
    return (snaps.filter(F.col("upto") == upto).select("patient_id", "record_count", "last_activity"), upto) \
        if upto is not None else (None, None)


def read_features(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """S12 source: the feature table = latest snapshot (if any) merged with the per-batch updates written
    after it (counts add; the last write wins). ``before``: as of the micro-batches before this one. None if there
    are none."""
    snap, upto = _snapshot(spark, root, before)
    upd = Table(spark, root, "feature_updates").read(None if before is None else before - 1)
    if upd is None:
        return snap
    if snap is None:
        return _fold(upd)
    return merge_features(snap, _fold(upd.filter(F.col("batch_id") > F.lit(upto))))


def compact_features(spark: SparkSession, root: str, upto_batch: int | None = None) -> int | None:
    """Fold the feature updates up to ``upto_batch`` (default: the newest committed one) into
    ``feature_snapshot/upto=<batch>``; later reads start from it. Safe to repeat, and next to a running stream."""
    upd = Table(spark, root, "feature_updates").read(upto_batch)
    if upd is None:
        return None
    last = upto_batch if upto_batch is not None else upd.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    _, upto = _snapshot(spark, root, None)
    if upto is not None and upto >= last:
        return upto
    snap, upto = _snapshot(spark, root, last + 1)
    table = _fold(upd) if snap is None else merge_features(snap, _fold(upd.filter(F.col("batch_id") > F.lit(upto))))
    table.write.mode("overwrite").parquet(f"{root.rstrip('/')}/feature_snapshot/upto={last}")
    return last


def kafka_sink_frame(results: DataFrame) -> DataFrame:
    """key/value frame for a Kafka sink (value = JSON of the nested result row)."""
    nested = result_rows(results)
    return nested.select(F.col("patient_id").cast("string").alias("key"),
                         F.to_json(F.struct(*[c for c in nested.columns if c != "seq"])).alias("value"))


def late_ratio_by_batch(spark: SparkSession, root: str, alarm: float = 0.05) -> DataFrame:
    """T7 on the stream: per micro-batch, late rows over valid rows (late + results) and the > 5 % alarm, from the
    counts that each micro-batch stored."""
    valid = F.col("accepted") + F.col("late")
    ratio = F.when(valid > 0, F.col("late") / valid).otherwise(F.lit(0.0))
    return read_table(spark, root, "batch_counts").select(
        "batch_id", "accepted", "late", ratio.alias("late_ratio"), (ratio > alarm).alias("late_alarm"))


def drift_since(spark: SparkSession, root: str, reference_upto_batch: int) -> DataFrame:
    """A5/A6 on the stream: PSI of the risk levels of results in batches after ``reference_upto_batch`` against those up
    to it (one row: counts, PSI, drift verdict), from the counts that each micro-batch stored."""
    return psi_of_counts(read_table(spark, root, "batch_counts"), F.col("batch_id") <= F.lit(reference_upto_batch))
